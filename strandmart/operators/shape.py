"""Unions and un-pivot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_padded(frames: Sequence[DataFrame], schema: Mapping[str, str]) -> DataFrame:
    """UNION ALL by name onto one schema: absent columns are typed nulls, others are cast."""

    def shaped(df: DataFrame) -> DataFrame:
        have = set(df.columns)
        return df.select(
            *[
                (F.col(f"`{c}`") if c in have else F.lit(None)).try_cast(kind).alias(c)
                for c, kind in schema.items()
            ]
        )

    return reduce(DataFrame.unionByName, [shaped(df) for df in frames])


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames of differing columns by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """Columns to (name, value) rows."""
    return df.unpivot(list(ids), list(values), name, value)
