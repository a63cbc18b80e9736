"""Aggregates; all combine map-side, so a hot key costs one row per map task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmart.operators.ranking import _join_back


def count_by(df: DataFrame, keys: Sequence[str | Column], name: str = "ct") -> DataFrame:
    """Rows per key or expression."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def _joined(values: Column, sep: str) -> Column:
    return F.when(F.size(values) > 0, F.array_join(F.sort_array(values), sep))


def distinct_text(c: Column | str, sep: str) -> Column:
    """Aggregate: sorted distinct values as one text, null when there are none.

    Sets combine map-side, and several lists per key need no row expansion.
    """
    return _joined(F.collect_set((F.col(c) if isinstance(c, str) else c).cast("string")), sep)


def sorted_text(c: Column | str, sep: str) -> Column:
    """Aggregate: all values (duplicates kept), sorted, as one text."""
    return _joined(F.collect_list((F.col(c) if isinstance(c, str) else c).cast("string")), sep)


def concat_distinct(
    df: DataFrame, keys: Sequence[str], columns: Mapping[str, str] | Sequence[str], sep: str
) -> DataFrame:
    """Distinct values of each column per key, sorted, joined with ``sep``.

    Two levels: values are made distinct by (key, column, value), which spreads a hot key over all tasks, and only distinct values meet at
    their key.
    """
    names = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    values = [F.struct(F.lit(i).alias("_i"), F.col(c).cast("string").alias("_v")) for i, c in enumerate(names)]
    long = df.select(*keys, F.explode(F.array(*values)).alias("_e")) if len(values) > 1 else df.select(*keys, values[0].alias("_e"))
    distinct = long.select(*keys, "_e._i", "_e._v").distinct()

    def text(i):
        return _joined(F.collect_list(F.when(F.col("_i") == i, F.col("_v"))), sep)

    return distinct.groupBy(*keys).agg(*[text(i).alias(target) for i, target in enumerate(names.values())])


def concat_sorted(df: DataFrame, keys: Sequence[str], column: str, sep: str, name: str) -> DataFrame:
    """All values (duplicates kept), sorted, joined with ``sep``.

    Two levels: values are counted by (key, value), which spreads a hot key over all tasks, and each comes to its key once.
    """
    counted = df.select(*keys, F.col(column).cast("string").alias("_v")).groupBy(*keys, "_v").agg(F.count(F.lit(1)).cast("int").alias("_n"))
    found = F.sort_array(F.collect_list(F.when(F.col("_v").isNotNull(), F.struct("_v", "_n"))))
    every = F.flatten(F.transform(found, lambda x: F.array_repeat(x["_v"], x["_n"])))
    return counted.groupBy(*keys).agg(F.when(F.size(found) > 0, F.array_join(every, sep)).alias(name))


def flag_counts(
    df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column], prefix: str = "count_"
) -> DataFrame:
    """Rows per flag as columns."""
    return df.groupBy(*keys).agg(
        *[F.count_if(flag).cast("bigint").alias(prefix + name) for name, flag in flags.items()]
    )


def flagged_keys(counts: DataFrame, names: Sequence[str], prefix: str = "count_") -> DataFrame:
    """0/1 columns ``is_<name>`` from the counts."""
    return counts.withColumns(
        {f"is_{n}": (F.col(prefix + n) > 0).cast("int") for n in names}
    )


def pivot_latest(
    df: DataFrame,
    keys: Sequence[str],
    kind: str,
    kinds: Mapping[str, Sequence[str]],
    order: Sequence[str],
) -> DataFrame:
    """Newest values per key and kind as columns, in one aggregation.

    ``kinds`` maps a kind to the columns it carries.  The newest row per kind is
    a conditional maximum of (order, values), which combines map-side; no
    window and no second grouping are needed.
    """
    picked = []
    for i, (value, columns) in enumerate(kinds.items()):
        row = F.struct(*[F.col(o) for o in order], *[F.col(c) for c in columns if c not in order])
        picked.append(F.max(F.when(F.col(kind) == value, row)).alias(f"_p{i}"))
    grouped = df.filter(F.col(kind).isin(*kinds)).groupBy(*keys).agg(*picked)
    out = [F.col(f"_p{i}.{c}").alias(c) for i, cs in enumerate(kinds.values()) for c in cs]
    return grouped.select(*keys, *out)


def pivot_first(
    df: DataFrame, keys: Sequence[str], kind: Column, kinds: Mapping[str, str], values: Mapping[str, str],
    order: Sequence[str],
) -> DataFrame:
    """First values per key and kind: columns ``<kind alias><suffix>`` for each value."""
    aggs = []
    for text, alias in kinds.items():
        row = F.struct(*order, *[v for v in values if v not in order])
        first = F.min(F.when(kind == text, row))
        aggs += [first.getField(v).alias(alias + suffix) for v, suffix in values.items()]
    return df.groupBy(*keys).agg(*aggs)


def group_totals(df: DataFrame, keys: Sequence[str], totals: Mapping[str, Column]) -> DataFrame:
    """Whole-group aggregates on every row (an unordered window).

    The null key is a group too.  Totals are map-side combined and joined back,
    so the rows of a hot group stay spread over many tasks.
    """
    summary = df.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()])
    return _join_back(df, summary, keys, list(totals))


def collect_parallel(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Parallel lists, one row per key whatever its size, all in the same order, nulls kept.

    The row is the result's form and as long as the key has rows; work over the
    items themselves belongs on the long rows, before they are collected.
    """
    rest = [c for c in columns if c not in order]
    row = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])
    grouped = df.groupBy(*keys).agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    return grouped.select(*keys, *[F.col(f"_rows.{c}").alias(c) for c in columns])
