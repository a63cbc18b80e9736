"""Sequenced samples with run, lane quality and demultiplex totals."""

from pyspark.sql import functions as F

from strandmart.functions.text import number_or_null
from strandmart.operators.joins import left_on

RUN_COLUMNS = (
    "id_library session_id session_name date_created date_modified execution_status workflow_reference run_id "
    "run_name percent_gt_q30 flowcell_barcode status run_date_created total_flowcell_yield_Gbps"
).split()
LIBRARY = ["id_repository", "id_library"]


def _sums(df, names):
    """Sums per sample and library; the columns are text in the source tables."""
    return df.groupBy(*LIBRARY).agg(*[F.sum(number_or_null(old)).alias(new) for old, new in names.items()])


def run(tables):
    samples = tables["illumina_bssh_biosamples"].select(
        "id_repository", F.col("session_id").alias("_session"), F.col("id_library").alias("_library")
    )
    out = left_on(samples, tables["illumina_bssh_runs"], {"_session": "session_id"}, RUN_COLUMNS)
    on = {"id_repository": "id_repository", "_library": "id_library"}
    demux = _sums(tables["illumina_demux"], {"reads": "total_reads", "percent_reads": "percent_reads"})
    quality = _sums(tables["illumina_qs"], {"yield": "yield", "yield_q30": "yield_q30"})
    out = left_on(out, demux, on, ["total_reads", "percent_reads"])
    out = left_on(out, quality, on, ["yield", "yield_q30"])
    return out.drop("_session", "_library")
