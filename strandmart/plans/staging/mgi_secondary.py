"""Newest MGI analysis per sample over both MGI sources."""

from pyspark.sql import functions as F

from strandmart.functions.rules import karyotype_from_word
from strandmart.functions.text import is_trial
from strandmart.operators.joins import left_on
from strandmart.operators.ranking import best_by, latest_by
from strandmart.operators.shape import union_padded
from strandmart.plans.staging.corrections import RUN_FIXES, run_fixes, sample_fixes

SCHEMA = {
    "date_start": "timestamp", "id_repository": "string", "id_batch": "string", "pipeline_name": "string",
    "run_name": "string", "cram": "string", "cram_size": "bigint", "vcf": "string", "vcf_size": "bigint",
    "tag_user_tags": "string", "percent_dups": "double", "percent_q30_bases": "double", "total_seqs": "double",
    "median_coverage": "double", "contamination": "double", "at_least_10x": "double", "at_least_20x": "double",
    "ploidy_estimation": "string", "snp": "double", "indel": "double", "ts_tv": "double", "depth": "double",
}
METRICS = "percent_dups at_least_10x at_least_20x ploidy_estimation snp indel ts_tv depth".split()
FIX_COLUMNS = {c: f"_fix_{c}" for columns in RUN_FIXES.values() for c in columns}


def _with_fixes(df, tables):
    df = left_on(df, sample_fixes(tables, "MGI"), {"id_repository": "id_repository"}, {"new_repository": "_sample_fix"})
    return left_on(df, run_fixes(tables, "MGI"), {"run_name": "run_name"}, FIX_COLUMNS)


def _identity():
    return F.coalesce("_fix_new_repository", "_sample_fix", "id_repository").alias("id_repository")


def _first_source(tables):
    analyses = tables["mgi_analysis"].filter((F.col("run_status") == "SUCCEEDED") & ~is_trial("id_repository"))
    newest = latest_by(
        analyses.select(
            "id_repository", "date_start", F.col("id_flowcell").alias("id_batch"), "pipeline_name", "run_name",
            "cram", "cram_size", "vcf", "vcf_size",
        ),
        ["id_repository"], ["date_start"],
    )
    measured = [*METRICS, "total_seqs", "median_coverage"]
    qc = tables["mgi_qc"].filter(~is_trial("id_repository")).select("id_repository", "at_least_50x", *measured)
    out = left_on(newest, best_by(qc, ["id_repository"], "at_least_50x"), {"id_repository": "id_repository"}, measured)
    out = _with_fixes(out, tables)
    files = [F.coalesce(f"_fix_new_{c}", c).alias(c) for c in ("cram", "cram_size", "vcf", "vcf_size")]
    return out.select("date_start", _identity(), "id_batch", "pipeline_name", "run_name", *files, *measured)


def _second_source(tables):
    analyses = tables["ztronpro_analysis"].select(
        "id_repository", F.col("date_secondary").alias("date_start"), "run_name", "cram", "cram_size", "vcf", "vcf_size"
    )
    newest = latest_by(analyses, ["id_repository"], ["date_start"])
    out = left_on(
        newest, tables["ztronpro_qc"], {"id_repository": "id_repository", "run_name": "run_name"}, METRICS
    )
    out = _with_fixes(out, tables)
    # As in the reports in use, this source takes the size, but not the path, of a corrected alignment file.
    files = [
        F.coalesce("_fix_cram", "cram").alias("cram"),
        F.coalesce("_fix_new_cram_size", "cram_size").alias("cram_size"),
        F.coalesce("_fix_vcf", "vcf").alias("vcf"),
        F.coalesce("_fix_vcf_size", "vcf_size").alias("vcf_size"),
    ]
    return out.select(
        "date_start", _identity(), F.lit("ZTRONPRO-MEGABOLT").alias("pipeline_name"), "run_name", *files,
        *METRICS, F.col("depth").alias("median_coverage"),
    )


def run(tables):
    both = union_padded([_first_source(tables), _second_source(tables)], SCHEMA)
    both = both.withColumn("ploidy_estimation", karyotype_from_word("ploidy_estimation"))
    return latest_by(both, ["id_repository"], ["date_start"])
