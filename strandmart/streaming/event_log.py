"""Append-only event log, one partition per run.

A run overwrites its own partition only, so a repeated run never doubles rows,
and late rows or those of another hospital never delete a day's others.  The file-stream form loads landed files once each and
ends when none is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmart.sources.bronze import text_schema

# Columns of the log.
LOG_COLUMNS = ["ehr_id", "logged_at", "template_id", "hospital", "crud_type", "composition"]


def shape_log(df: DataFrame) -> DataFrame:
    logged = F.col("logged_at").try_cast("timestamp")
    others = [c for c in LOG_COLUMNS if c != "logged_at"]
    return df.select(*others, logged.alias("logged_at"), F.to_date(logged).alias("log_date"))


def append_log(df: DataFrame, path: str, run: str) -> None:
    """Write the rows of one run (its date or any other name of it), leaving all other runs alone."""
    (
        shape_log(df).withColumn("run", F.lit(run)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run").parquet(path)
    )


def load_landed(spark: SparkSession, landing: str, path: str, checkpoint: str, name: str = "landed") -> None:
    """All files not loaded yet, then stop.

    Each batch is a run of the log, named by its number: the stream and ``append_log`` share one layout, and a batch that is tried again
    after a failure replaces itself.
    """
    landed = (
        spark.readStream.schema(text_schema(LOG_COLUMNS)).option("header", True)
        .option("multiLine", True).option("escape", '"').csv(landing)
    )
    query = (
        landed.writeStream.foreachBatch(lambda batch, number: append_log(batch, path, f"{name}-{number}"))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
