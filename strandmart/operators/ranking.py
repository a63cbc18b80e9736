"""Rank-and-keep operators.

``row_number() <= n`` directly above the window lets Spark put a group limit
before the shuffle: each map task sends at most n rows per key, so a key with a
third of all rows is cut down before it reaches one reducer.  Ranks that must
keep *every* row are not done with a window over the raw group; they go through
map-side combined aggregates joined back on the key.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmart.session import shared_folder

Order = Sequence[Column | str]


def _columns(order: Order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _newest_first(order: Order) -> list[Column]:
    return [F.desc_nulls_last(c) if isinstance(c, str) else c for c in order]


def _comparable(df: DataFrame) -> list[str]:
    """Columns that can break a tie."""
    skip = ("map", "variant", "calendarinterval")
    return [name for name, kind in df.dtypes if not kind.startswith(skip)]


def dealt(df: DataFrame) -> DataFrame:
    """The rows dealt anew, for a sort that follows: a scan's task holds a whole row group, however large that is.

    The place hangs on the row and the task that it comes from, so a task that runs again deals the same, and equal rows of many tasks part.
    """
    return df.withColumn("_task", F.spark_partition_id()).repartition(*[F.col(f"`{c}`") for c in _comparable(df)], "_task").drop("_task")


def top_n_by(df: DataFrame, keys: Sequence[str], order: Order, n: int, total: bool = True) -> DataFrame:
    """First n rows per key.  ``total`` appends all columns as tie-break, so that
    the result depends neither on input order nor on partitioning."""
    taken = [c for c in order if isinstance(c, str)]
    ties = [F.asc_nulls_first(f"`{c}`") for c in _comparable(df) if c not in keys and c not in taken]
    ranked = Window.partitionBy(*keys).orderBy(*_newest_first(order), *(ties if total else []))
    return df.withColumn("_rn", F.row_number().over(ranked)).filter(F.col("_rn") <= n).drop("_rn")


def latest_by(df: DataFrame, keys: Sequence[str], order: Order, total: bool = True) -> DataFrame:
    """Newest row per key; text order columns mean descending, nulls last."""
    return top_n_by(df, keys, order, 1, total)


def best_by(df: DataFrame, keys: Sequence[str], metric: Column | str, ties: Order = ()) -> DataFrame:
    """Row with the largest metric per key."""
    metric = F.col(metric) if isinstance(metric, str) else metric
    return latest_by(df, keys, [metric.desc_nulls_last(), *ties])


def richest_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row with the most non-null columns per key."""
    filled = sum((F.col(f"`{c}`").isNotNull().cast("int") for c in df.columns), F.lit(0))
    return latest_by(df.withColumn("_filled", filled), keys, ["_filled"]).drop("_filled")


def dense_rank_by(df: DataFrame, keys: Sequence[str], order: str, name: str = "rank") -> DataFrame:
    """Dense rank with every row kept; no task holds a key.

    Distinct (key, order) pairs are dealt by ranges of both, so a hot key lies in many parts.  A pair's rank is its place within its part
    and key, plus the pairs that the key has in the parts before.  The parts are written, since the two steps must see the same ones.
    """
    spark = df.sparkSession
    pairs = df.select(*keys, order).distinct()
    place = [*[F.asc_nulls_first(k) for k in keys], F.asc_nulls_first(order)]
    dealt = pairs.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *place)
    folder = f"{shared_folder(spark)}/ranked-{uuid.uuid4().hex}"
    dealt.withColumn("_part", F.spark_partition_id()).write.parquet(folder)
    parts = spark.read.parquet(folder)
    within = F.row_number().over(Window.partitionBy("_part", *keys).orderBy(F.asc_nulls_first(order)))
    counts = F.sort_array(F.collect_list(F.struct("_part", "_n")))
    before = parts.groupBy(*keys, "_part").agg(F.count(F.lit(1)).cast("int").alias("_n")).groupBy(*keys).agg(counts.alias("_counts"))
    spread = before.select(*keys, F.explode(F.transform("_counts", lambda x: F.struct(
        x["_part"].alias("_part"),
        F.aggregate(F.filter("_counts", lambda y: y["_part"] < x["_part"]), F.lit(0), lambda acc, y: acc + y["_n"]).alias("_before"),
    ))).alias("_e")).select(*keys, "_e.*")
    ranked = _join_back(parts.withColumn("_within", within), spread, [*keys, "_part"], ["_before"])
    ranked = ranked.select(*keys, order, (F.col("_within") + F.col("_before")).alias(name))
    return _join_back(df, ranked, [*keys, order], [name])


def first_flag(df: DataFrame, keys: Sequence[str], order: Order, name: str = "is_first") -> DataFrame:
    """True for exactly one row per key, the first in order; every row is kept.

    Same flag as ``row_number() == 1`` but no task holds a whole group:
    identical rows are counted, the first distinct row per key is a map-side
    combined minimum, and the counted rows are repeated at the end.
    """
    columns = list(df.columns)
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    rest = [c for c in columns if c not in keys and c not in order]
    place = F.struct(*_columns(order), *[F.col(c) for c in rest])
    firsts = counted.groupBy(*keys).agg(F.min(place).alias("_first"))
    marked = _join_back(counted.withColumn("_place", place), firsts, keys, ["_first"])
    copies = marked.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
    is_first = (F.col("_place") == F.col("_first")) & (F.col("_copy") == 1)
    return copies.select(*columns, is_first.alias(name))


def _join_back(df: DataFrame, small: DataFrame, keys: Sequence[str], add: Sequence[str]) -> DataFrame:
    """Null-safe left join of per-key values; a hot key on the left is split by AQE."""
    right = small.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *add)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(right, same, "left").drop(*[f"_k{i}" for i in range(len(keys))])
