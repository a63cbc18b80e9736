"""Keyed upsert and insert-if-absent as DataFrame expressions."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmart.operators.ranking import dealt, latest_by


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    match = F.lit(True)
    for l, r in zip(left, right):
        match = match & F.col(l).eqNullSafe(F.col(r))
    return match


def last_per_key(source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows are applied in order, so the last one per key wins."""
    return latest_by(source, keys, order)


def as_batch(
    source: DataFrame, kinds: Mapping[str, str], keys: Sequence[str], order: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """The last row per key in the target's columns and types, and the columns that the source lacks (null there)."""
    batch = last_per_key(source, keys, order)
    missing = [c for c in kinds if c not in batch.columns]
    batch = batch.withColumns({c: F.lit(None).cast(kinds[c]) for c in missing})
    return batch.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in kinds.items()]), missing


def merged(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], frozen: Collection[str], stamp: tuple[str, Column] | None = None
) -> DataFrame:
    """Target after a batch with one row per key: matched rows take all columns but ``frozen`` ones, the others are added."""
    columns, kinds = list(target.columns), dict(target.dtypes)
    incoming = batch.withColumnsRenamed({c: f"_n_{c}" for c in columns}).withColumn("_hit", F.lit(True))
    new_keys = [f"_n_{k}" for k in keys]

    joined = target.join(incoming, _same(keys, new_keys), "left")
    hit = F.col("_hit").isNotNull()
    updated = []
    for c in columns:
        value = F.col(f"`{c}`")
        if stamp is not None and c == stamp[0]:
            value = F.when(hit, stamp[1].cast(kinds[c])).otherwise(value)
        elif c not in frozen:
            value = F.when(hit, F.col(f"`_n_{c}`")).otherwise(value)
        updated.append(value.alias(c))

    touched = (
        target.select(*keys)
        .join(incoming.select(*new_keys), _same(keys, new_keys), "left_semi")
        .distinct()
        .withColumnsRenamed({k: f"_t_{k}" for k in keys})
    )
    fresh = batch.join(touched, _same(keys, [f"_t_{k}" for k in keys]), "left_anti")
    return joined.select(*updated).unionByName(fresh.select(*columns))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    keep: Sequence[str],
    order: Sequence[str],
    stamp: tuple[str, Column] | None = None,
) -> DataFrame:
    """Target after the batch: matched rows take every source column except keys
    and ``keep``; unmatched source rows are added.

    A small batch never moves the target: the target is left-joined to the
    batch, and new keys are found by an anti join against the target keys the
    batch touches, which are few.  Each time the batch is the side Spark may
    broadcast after measuring it.  Of the batch's rows with one key the last in
    ``order`` counts.  ``stamp`` is set on matched rows only.  The source is
    dealt anew before it is sorted for that.

    This plan reads and returns the whole target; ``IndexedTable`` rewrites only the parts that a batch touches.
    """
    batch, missing = as_batch(dealt(source), dict(target.dtypes), keys, order)
    return merged(target, batch, keys, {*keys, *keep, *missing}, stamp)


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the source whose key the target lacks (first row per key)."""
    batch = latest_by(source, keys, [])
    known = target.select(*keys).distinct().withColumnsRenamed({k: f"_t_{k}" for k in keys})
    return batch.join(known, _same(keys, [f"_t_{k}" for k in keys]), "left_anti")
