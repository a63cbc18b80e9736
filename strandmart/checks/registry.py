"""Query registry and the small helpers all queries share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmart.session import bound_tasks, tune

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Inputs:
    """The test tables of one folder, read lazily, and SQL over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = bound_tasks(tune(spark)), folder
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._frames[name]

    def size(self, name: str) -> int:
        """Bytes of the table's files."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}.parquet")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()

    def sql(self, text: str) -> DataFrame:
        """SQL that both engines read the same way; used to derive inputs."""
        for name in set(re.findall(r"(?:FROM|JOIN)\s+(\w+)", text)) & set(TABLES):
            self[name].createOrReplaceTempView(name)
        return self.spark.sql(text)


def check(name: str, oracle: str | None = None):
    """Register ``build(inputs) -> DataFrame`` under a name, with its oracle."""

    def add(build: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = lambda spark, folder: build(Inputs(spark, folder))
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return build

    return add


def stamp(c: str | Column) -> Column:
    """Timestamp as text, the same in both engines."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def day(c: str | Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def cents(c: str | Column) -> Column:
    return F.round(c, 2)


def flag(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("int")
