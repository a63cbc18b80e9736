"""Table writes: full refresh, build-aside-and-swap, insert-ignore, exports, samples."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmart.operators.merge import insert_absent, upsert
from strandmart.operators.ranking import latest_by


def full_refresh(df: DataFrame, path: str) -> None:
    """Replace the whole table.  The input must not be the table itself."""
    df.write.mode("overwrite").parquet(path)


def replace_table(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)


class SwappedTable:
    """Versions side by side under one root; ``CURRENT`` names the readable one.

    A new version is written aside and becomes visible when the pointer file is
    renamed over the old one, so readers see the old or the new table, never a
    part.  Old versions are left to the operator's retention job.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        path = spark._jvm.org.apache.hadoop.fs.Path
        self._path = lambda name: path(f"{root}/{name}")
        self._fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def current(self) -> str | None:
        pointer = self._path("CURRENT")
        if not self._fs.exists(pointer):
            return None
        return self.spark.read.text(f"{self.root}/CURRENT").first()[0]

    def exists(self) -> bool:
        return self.current() is not None

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{self.current()}")

    def write(self, df: DataFrame, version: str, partition_by: Sequence[str] = ()) -> None:
        if version == self.current():
            raise ValueError(f"version {version} is the current one")
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.root}/{version}")
        self._point_to(version)

    def _point_to(self, version: str) -> None:
        self._put("CURRENT", version)

    def _put(self, name: str, text: str) -> None:
        """A small file, written aside and renamed over the old one."""
        aside = self._path(f"_next.{name}")
        stream = self._fs.create(aside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._path("").toUri(), self.spark._jsc.hadoopConfiguration()
        )
        option = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self.spark.sparkContext._gateway.new_array(
            self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1
        )
        options[0] = option
        context.rename(aside, self._path(name), options)

    def upsert(self, source: DataFrame, version: str, keys, keep, order, stamp=None) -> None:
        """Merge a batch into the current version and swap."""
        if self.exists():
            merged = upsert(self.read(), source, keys, keep, order, stamp)
        else:
            spare = [c for c in order if c.startswith("_")]
            merged = latest_by(source, keys, list(order)).drop(*spare)
        self.write(merged, version)


def swap_table(df: DataFrame, root: str, version: str) -> None:
    SwappedTable(df.sparkSession, root).write(df, version)


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus the source rows whose key it lacks."""
    return target.unionByName(insert_absent(target, source, keys))


def export_status(gold_qc: DataFrame) -> DataFrame:
    """Keyed status records, one per sample, as text."""
    first = latest_by(
        gold_qc.select("id_repository", "date_secondary", "qc_strict_status"),
        ["id_repository"], ["date_secondary"],
    )
    return first.select(
        F.col("id_repository").alias("id_subject"),
        F.when(F.col("date_secondary").isNotNull(), "SUCCEEDED").otherwise("FAILED").alias("analysis_secondary"),
        F.when(F.col("qc_strict_status") == "Pass", "1").otherwise("0").alias("qc_pass"),
    )


# Fixed value: names of scratch tables, which are not copied.
SCRATCH_TABLES = "(?i)(temp|tmp|test|tst)"


def sample_table(df: DataFrame, rows: int, order: Sequence[str] = ()) -> DataFrame:
    """Capped copy of a table; with ``order`` the copy is the same on every run."""
    return (df.orderBy(*order) if order else df).limit(rows)


def sample_catalog(spark: SparkSession, source: str, target: str, rows: int, exclude: str = SCRATCH_TABLES) -> list[str]:
    """Capped copies of all base tables of a schema, by name filter."""
    listed = spark.catalog.listTables(source)
    kept = [t.name for t in listed if not t.isTemporary and t.tableType != "VIEW" and not re.search(exclude, t.name)]
    for name in kept:
        replace_table(sample_table(spark.table(f"`{source}`.`{name}`"), rows), f"`{target}`.`{name}`")
    return kept
