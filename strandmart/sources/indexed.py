"""A versioned table of which a batch rewrites only the files that hold its keys.

Rows lie in hash buckets of the key.  A version is a manifest: for each share (the rows of one bucket that one version wrote) its bucket, folder,
number of rows, and least and greatest key.  A batch finds its shares in three steps, each on less than the one before: the
manifest (bucket and key range), the key columns of what is left, and the whole rows of shares that really hold a key of the batch.  These are written
again with the batch's new rows in the new version's folder; all others are listed as they are.  The pointer to the manifest is renamed
last, so readers see the old or the new table, and a run that breaks off leaves the old one.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from strandmart.operators.merge import as_batch, last_per_key, merged
from strandmart.sources.tables import SwappedTable

BUCKET = "_bucket"
#: Files that a task may hold open at once; beyond them it sorts its rows by bucket.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


class IndexedTable(SwappedTable):
    """``keys`` and ``buckets`` belong to the table from its first version on; a bucket should be a few hundred MB.

    ``most_shares`` bounds the files of a bucket: at that number its shares are written together at its next change.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 64, most_shares: int = 8):
        super().__init__(spark, root)
        self.keys, self.buckets, self.most_shares = list(keys), buckets, most_shares
        self.schema: StructType | None = None
        if self.exists():
            self._open()

    def _open(self) -> None:
        kept = json.loads(self.spark.read.text(f"{self.root}/TABLE").first()[0])
        if kept["keys"] != self.keys:
            raise ValueError(f"the table's key is {kept['keys']}")
        self.buckets, self.schema = kept["buckets"], StructType.fromJson(kept["schema"])

    def shares(self, version: str | None = None) -> DataFrame:
        """``bucket``, ``folder``, ``rows``, ``low`` and ``high`` of a version, the current one if none is named."""
        return self.spark.read.parquet(f"{self.root}/manifest/{version or self.current()}")

    def read(self) -> DataFrame:
        return self._rows([(r.bucket, r.folder) for r in self.shares().select("bucket", "folder").collect()])

    def _rows(self, shares: Sequence[tuple[int, str]]) -> DataFrame:
        """The rows of some shares."""
        paths = [f"{self.root}/data/{folder}/{BUCKET}={bucket}" for bucket, folder in shares]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _place(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _new_name(self, version: str) -> None:
        if not re.fullmatch(r"[\w.-]+", version):
            raise ValueError(f"{version!r} can't be a folder's name")
        if version == self.current():
            raise ValueError(f"version {version} is the current one")

    def write(self, df: DataFrame, version: str, partition_by: Sequence[str] = ()) -> None:
        """Replace the whole table."""
        if partition_by:
            raise ValueError("rows lie in buckets of the key")
        self._new_name(version)
        if self.schema is None:
            self.schema = StructType.fromJson(json.loads(df.schema.json()))
            self._put("TABLE", json.dumps({"keys": self.keys, "buckets": self.buckets, "schema": self.schema.jsonValue()}))
        self._commit(self._stored(df.select(*self.schema.names), version), version)

    def _stored(self, df: DataFrame, version: str) -> DataFrame:
        """Write rows by bucket; the shares that they make.

        A large bucket is written by several tasks, each a file of its own, and rows go to the files of their task's buckets unsorted:
        a task's memory depends neither on the number of buckets nor on the size of the table.
        """
        folder = f"{self.root}/data/{version}"
        placed = df.withColumn(BUCKET, self._place()).hint("rebalance", BUCKET)
        before = self.spark.conf.get(WRITERS)
        self.spark.conf.set(WRITERS, str(max(int(before), 16)))
        try:
            placed.write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        finally:
            self.spark.conf.set(WRITERS, before)
        key = F.struct(*self.keys)
        keys = self.spark.read.schema(StructType([*self.schema.fields]).add(BUCKET, IntegerType())).parquet(folder)
        return keys.groupBy(F.col(BUCKET).alias("bucket")).agg(F.count("*").alias("rows"), F.min(key).alias("low"), F.max(key).alias("high")).select(
            "bucket", F.lit(version).alias("folder"), "rows", "low", "high"
        )

    def _commit(self, shares: DataFrame, version: str) -> None:
        shares.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/{version}")
        self._point_to(version)

    def upsert(self, source: DataFrame, version: str, keys, keep, order, stamp=None) -> None:
        """Merge a batch: shares that hold one of its keys are written again, new keys go to shares of their own."""
        if list(keys) != self.keys:
            raise ValueError(f"the table's key is {self.keys}")
        if not self.exists():
            spare = [c for c in order if c.startswith("_")]
            self.write(last_per_key(source, keys, order).drop(*spare), version)
            return
        self._new_name(version)
        if self.schema is None:
            self._open()
        kinds = {f.name: f.dataType.simpleString() for f in self.schema.fields}
        last, missing = as_batch(source, kinds, keys, order)
        # the batch's last rows are ranked once and read again for each of the steps
        batch_folder = f"{self.root}/batch/{version}"
        last.withColumn(BUCKET, self._place()).write.mode("overwrite").parquet(batch_folder)
        batch = self.spark.read.schema(StructType([*self.schema.fields]).add(BUCKET, IntegerType())).parquet(batch_folder)

        old = self.shares()
        key = F.struct(*self.keys)
        span = batch.groupBy(BUCKET).agg(F.min(key).alias("first"), F.max(key).alias("last"))
        listed = old.join(span, F.col("bucket") == F.col(BUCKET))
        # one small row for each share of a touched bucket
        listed = listed.select("bucket", "folder", ((F.col("high") >= F.col("first")) & (F.col("low") <= F.col("last"))).alias("near")).collect()
        hit = self._holding(batch, [(r.bucket, r.folder) for r in listed if r.near])
        left: dict[int, set[str]] = {}
        for r in listed:
            if (r.bucket, r.folder) not in hit:
                left.setdefault(r.bucket, set()).add(r.folder)
        hit |= {(bucket, folder) for bucket, folders in left.items() if len(folders) >= self.most_shares for folder in folders}

        out = merged(self._rows(sorted(hit)), batch.drop(BUCKET), self.keys, {*keys, *keep, *missing}, stamp)
        made = self._stored(out, version)
        gone = self.spark.createDataFrame(sorted(hit), "bucket int, folder string")
        self._commit(old.join(gone, ["bucket", "folder"], "left_anti").select("bucket", "folder", "rows", "low", "high").unionByName(made), version)

    def _holding(self, batch: DataFrame, shares: Sequence[tuple[int, str]]) -> set[tuple[int, str]]:
        """Of some shares those that hold a key of the batch; only key columns are read."""
        place = F.regexp_extract("_metadata.file_path", rf"/data/([\w.-]+)/{BUCKET}=\d+/", 1)
        held = self._rows(shares).select(*self.keys, place.alias("folder")) if shares else None
        if held is None:
            return set()
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(f"h.{k}").eqNullSafe(F.col(f"b.{k}"))
        found = held.alias("h").join(batch.select(*self.keys, BUCKET).alias("b"), same).select(F.col(f"b.{BUCKET}").alias("bucket"), "h.folder").distinct()
        return {(r.bucket, r.folder) for r in found.collect()}
