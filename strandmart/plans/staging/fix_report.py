"""Daily count of samples without registry sex."""

from pyspark.sql import functions as F

from strandmart.operators.ranking import latest_by


def count_today(tables, run_ts):
    missing = tables["staging_simbiox_biosamples_patients"].filter(F.col("registry_sex").isNull())
    return missing.agg(F.count(F.lit(1)).alias("ct")).select(F.lit(run_ts).cast("date").alias("date_time"), "ct")


def run(tables, run_ts):
    """The metric table with today's row, unless the day has one already."""
    known = tables["staging_report_fix_simbiox"].withColumn("_new", F.lit(0))
    both = known.unionByName(count_today(tables, run_ts).withColumn("_new", F.lit(1)))
    return latest_by(both, ["date_time"], [F.asc("_new")]).drop("_new")
