"""Secondary and tertiary analysis flags per sample."""

from pyspark.sql import functions as F

from strandmart.operators.joins import left_on


def run(tables):
    samples = tables["gold_qc"].select("id_repository", "sequencer", "date_secondary", "qc_strict_diagnosis")
    out = left_on(
        samples, tables["gold_pgx_report"], {"id_repository": "id_repository"},
        {"eng_report_creation_date": "_eng", "ind_report_creation_date": "_ind"},
    )
    return out.select(
        "id_repository", "sequencer", F.col("date_secondary").isNotNull().alias("is_secondary_analysed"),
        F.col("qc_strict_diagnosis").alias("qc_category"),
        (F.col("_eng").isNotNull() | F.col("_ind").isNotNull()).alias("is_tertiary_pgx_analysed"),
    )
