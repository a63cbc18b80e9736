"""Newest succeeded Illumina analysis per sample and run, with QC and corrections."""

from pyspark.sql import functions as F

from strandmart.functions.text import batch_from_user_tags, clean_sample_id, is_trial
from strandmart.operators.joins import left_on
from strandmart.operators.ranking import best_by, latest_by
from strandmart.plans.staging.corrections import run_fixes, sample_fixes

QC = {
    c: c
    for c in (
        "percent_dups percent_q30_bases total_seqs median_coverage contam at_least_10x at_least_20x "
        "ploidy_estimation snp indel ts_tv"
    ).split()
} | {"contam": "contamination"}


def _own(df):
    """Without trial samples, with the clean id."""
    return df.filter(~is_trial("id_repository")).withColumn("clean_id", clean_sample_id("id_repository"))


def run(tables):
    analyses = _own(tables["ica_analysis"].filter(F.col("run_status") == "SUCCEEDED")).select(
        "id", "id_repository", "clean_id", "run_name", "date_start", "date_end", "pipeline_name",
        "cram", "cram_size", "vcf", "vcf_size", "tag_user_tags",
    )
    newest = latest_by(analyses, ["clean_id", "run_name"], ["date_end"])

    qc = _own(tables["illumina_qc"]).select("clean_id", "run_name", *QC)
    best_qc = best_by(qc, ["clean_id", "run_name"], "percent_q30_bases")

    lanes = tables["illumina_qs"].filter(~is_trial("id_repository"))
    yields = lanes.groupBy("id_repository").agg(F.sum("yield").alias("yield"), F.sum("yield_q30").alias("yield_q30"))

    by_id = {"id_repository": "id_repository"}
    out = left_on(newest, best_qc, {"run_name": "run_name"}, QC)
    # joins of one key stand together, so that the wide rows are shuffled once for each key
    out = left_on(
        out, run_fixes(tables, "Illumina"), {"run_name": "run_name"},
        {"new_repository": "_run_fix", "new_cram": "_cram", "new_cram_size": "_cram_size",
         "new_vcf": "_vcf", "new_vcf_size": "_vcf_size"},
    )
    out = left_on(out, yields, by_id, ["yield", "yield_q30"])
    out = left_on(out, sample_fixes(tables, "Illumina"), by_id, {"new_repository": "_sample_fix"})
    out = left_on(
        out, tables["staging_fix_ski_id_repo"], {"id_repository": "new_origin_code_repository"},
        {"code_repository": "_alias"},
    )
    return out.select(
        "date_start",
        F.coalesce("_alias", "_sample_fix", "_run_fix", "clean_id").alias("id_repository"),
        batch_from_user_tags("tag_user_tags").alias("id_batch"),
        "pipeline_name", "run_name",
        *[F.coalesce(f"_{c}", c).alias(c) for c in ("cram", "cram_size", "vcf", "vcf_size")],
        "tag_user_tags", *QC.values(), "yield", "yield_q30",
    )
