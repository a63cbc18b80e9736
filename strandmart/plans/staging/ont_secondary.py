"""Newest ONT analysis per sample with QC and corrections."""

from pyspark.sql import functions as F

from strandmart.functions.text import is_trial
from strandmart.operators.joins import left_on
from strandmart.operators.ranking import latest_by
from strandmart.plans.staging.corrections import run_fixes

QC = {
    "total_seqs": "total_seqs", "total_depth": "median_coverage", "contaminated": "contamination",
    "at_least_10x": "at_least_10x", "at_least_20x": "at_least_20x", "ploidy_estimation": "ploidy_estimation",
    "indel": "indel", "ts_tv": "ts_tv", "yield": "yield",
}


def _none(name):
    return F.lit(None).cast("string").alias(name)


def run(tables):
    # Trial runs are dropped after the choice of the newest analysis, as in the reports in use.
    newest = latest_by(tables["wfhv_analysis"].drop("created_at", "updated_at"), ["id_repository"], ["date_start"])
    own = newest.filter(~(is_trial("id_repository") | is_trial("run_name")))
    out = left_on(own, tables["wfhv_qc"], {"run_name": "run_name"}, QC)
    out = left_on(
        out, run_fixes(tables, "ONT"), {"run_name": "run_name"},
        {"new_repository": "_fix_id", **{f"new_{c}": f"_fix_{c}" for c in ("cram", "cram_size", "vcf", "vcf_size")}},
    )
    return out.select(
        "date_start", F.coalesce("_fix_id", "id_repository").alias("id_repository"), _none("id_batch"),
        "pipeline_name", "run_name",
        *[F.coalesce(f"_fix_{c}", c).alias(c) for c in ("cram", "cram_size", "vcf", "vcf_size")],
        _none("tag_user_tags"), _none("percent_dups"), _none("percent_q30_bases"),
        "total_seqs", "median_coverage", "contamination", "at_least_10x", "at_least_20x", "ploidy_estimation",
        _none("snp"), "indel", "ts_tv", "yield",
    )
