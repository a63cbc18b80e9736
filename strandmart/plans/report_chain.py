"""From the report status to the table of report details: new reports are fetched, opened and merged, each version of a report once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmart.functions.text import clean_null
from strandmart.operators.joins import anti_on
from strandmart.plans.upserts import SPECS, match_rules
from strandmart.settings import Buckets
from strandmart.sources.indexed import IndexedTable
from strandmart.sources.reports import explode_reports

#: Reports that are read at once; their paths are listed on the driver.
FETCHED_AT_ONCE = 10_000
STATE_KEYS = ["path"]


def detail_table(spark: SparkSession, root: str, buckets: int = 64) -> IndexedTable:
    return IndexedTable(spark, root, list(SPECS["U01"].keys), buckets)


def state_table(spark: SparkSession, root: str, buckets: int = 64) -> IndexedTable:
    """``path`` and ``fetched_version``, the creation date of the report that was fetched last."""
    return IndexedTable(spark, root, STATE_KEYS, buckets)


def report_files(spark: SparkSession, root: str) -> Callable[[DataFrame], DataFrame]:
    """Reader of report files under a folder: ``path`` → ``path`` and ``content``.  Absent files are left out."""

    def read(paths: DataFrame) -> DataFrame:
        waiting, frames = [], []
        for row in paths.select("path").toLocalIterator():
            waiting.append(f"{root}/{row.path}")
            if len(waiting) == FETCHED_AT_ONCE:
                frames.append(waiting)
                waiting = []
        found = None
        for block in [*frames, waiting]:
            if block:
                rows = spark.read.option("ignoreMissingFiles", True).text(_present(spark, block), wholetext=True).select(
                    F.substring_index(F.col("_metadata.file_path"), f"{root.rstrip('/')}/", -1).alias("path"), F.col("value").alias("content")
                )
                found = rows if found is None else found.unionAll(rows)
        return found if found is not None else spark.createDataFrame([], "path string, content string")

    return read


def _present(spark: SparkSession, paths: list[str]) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(paths[0]).getFileSystem(spark._jsc.hadoopConfiguration())
    return [p for p in paths if files.exists(path(p))]


def due_reports(status: DataFrame, ds, state: DataFrame | None, buckets: Buckets = Buckets()) -> DataFrame:
    """``path`` and ``fetched_version`` of reports that are newer than the date and not fetched in that version yet."""
    found = clean_null("report_path_ind")
    due = status.filter((F.col("ind_report_creation_date") > F.lit(ds)) & found.isNotNull()).groupBy(
        F.replace(found, F.lit(f"s3://{buckets.pgx_output}/"), F.lit("")).alias("path")
    ).agg(F.max("ind_report_creation_date").cast("timestamp").alias("fetched_version"))
    if state is None:
        return due
    version = lambda: F.concat_ws("|", "path", F.col("fetched_version").cast("string"))
    return anti_on(due.withColumn("_v", version()), state.select(version().alias("_v")), "_v", "_v").drop("_v")


def run_chain(
    status: DataFrame, ds, read: Callable[[DataFrame], DataFrame], details: IndexedTable, state: IndexedTable, run: str, buckets: Buckets = Buckets()
) -> bool:
    """Bring new reports into the table of details; False where there is none.

    The details are merged first and the state after them.  A run that breaks off in between fetches the same reports again, and
    merging them again changes nothing.  ``run`` names the version and must be new for every try.
    """
    due = due_reports(status, ds, state.read() if state.exists() else None, buckets)
    # the list of this run is fixed before anything is fetched
    folder = f"{state.root}/due/{run}"
    due.write.mode("overwrite").parquet(folder)
    due = status.sparkSession.read.parquet(folder)
    if due.isEmpty():
        return False
    opened = explode_reports(read(due), ("path",))
    spec = SPECS["U01"]
    keep, stamp = match_rules(spec, opened.columns, F.lit(None))
    details.upsert(opened.withColumnRenamed("path", "_path"), run, spec.keys, keep, ("_path",), stamp)
    state.upsert(due, run, STATE_KEYS, (), ("fetched_version",))
    return True
