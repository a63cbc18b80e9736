"""Intermediate results of a model that several of its parts read.

A step is written once, with the columns that its readers need, under the run's version, and read back: what it stands on is evaluated once, and
a lost executor reads it again from files.  The steps of a model are dropped when its output is written.  A table mapping
that has no place for steps (``steps`` is missing) gets the plain frame, which is the same result.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmart.session import shared_folder


class Steps:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.frames: dict[str, DataFrame] = {}
        #: The frames as they were before they were written, for a look at their plans.
        self.plans: dict[str, DataFrame] = {}

    def once(self, name: str, df: DataFrame) -> DataFrame:
        if name not in self.frames:
            path = f"{self.root}/{name}"
            df.write.mode("overwrite").parquet(path)
            self.plans[name], self.frames[name] = df, self.spark.read.schema(df.schema).parquet(path)
        return self.frames[name]

    def drop(self) -> None:
        """Remove all steps; frames that read them can't be used any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.frames.clear()
        self.plans.clear()


def once(tables: Mapping[str, DataFrame], name: str, df: DataFrame) -> DataFrame:
    """A step of the model that reads these tables."""
    steps = getattr(tables, "steps", None)
    return df if steps is None else steps.once(name, df)


def numbered(tables: Mapping[str, DataFrame], name: str, df: DataFrame, column: str = "_row") -> DataFrame:
    """A step whose rows have a number of their own.  It is always written, since a number must be the same for every reader."""
    steps = getattr(tables, "steps", None) or Steps(df.sparkSession, f"{shared_folder(df.sparkSession)}/steps-{uuid.uuid4().hex}")
    return steps.once(name, df.withColumn(column, F.monotonically_increasing_id()))
