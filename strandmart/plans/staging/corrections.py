"""Newest corrections, shared by the platform models."""

from pyspark.sql import functions as F

from strandmart.operators.aggregates import pivot_latest
from strandmart.operators.ranking import latest_by

# Columns carried by each kind of run-level correction.
RUN_FIXES = {
    "id_repository": ["new_repository"],
    "cram": ["cram", "new_cram", "cram_size", "new_cram_size"],
    "vcf": ["vcf", "new_vcf", "vcf_size", "new_vcf_size"],
}


def run_fixes(tables, sequencer):
    """Newest correction per run and kind, one row per run."""
    fixes = tables["dynamodb_fix_analysis"].filter(
        (F.col("sequencer") == sequencer) & ~F.col("id_requestor").rlike("(?i)test")
    )
    return pivot_latest(fixes, ["run_name"], "fix_type", RUN_FIXES, ["time_requested"])


def sample_fixes(tables, sequencer):
    """Newest replaced sample id, one row per sample."""
    fixes = tables["dynamodb_fix_samples"].filter(
        (F.col("sequencer") == sequencer)
        & (F.col("fix_type") == "id_repository")
        & F.col("new_repository").isNotNull()
    )
    slim = fixes.select("id_repository", "new_repository", "time_requested")
    return latest_by(slim, ["id_repository"], ["time_requested"]).drop("time_requested")
