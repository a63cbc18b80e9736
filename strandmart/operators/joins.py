"""Join operators.

No side is broadcast by hint unless it is a literal table of fixed size; Spark
broadcasts other small sides itself, from measured sizes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmart.operators.ranking import latest_by


def _renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def left_on(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], take: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """Left equi-join of left columns (keys of ``on``) with right columns (values),
    adding only the taken right columns under new names."""
    names = dict(take) if isinstance(take, Mapping) else {c: c for c in take}
    keys = {r: f"_r{i}" for i, r in enumerate(on.values())}
    slim = right.select(
        *[F.col(r).alias(k) for r, k in keys.items()], *[F.col(o).alias(n) for o, n in names.items()]
    )
    match = F.lit(True)
    for l, r in on.items():
        match = match & (left[l] == slim[keys[r]])
    return left.join(slim, match, "left").drop(*keys.values())


def lookup(
    facts: DataFrame, master: DataFrame, on: Mapping[str, str], take: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """Name lookup in a master table; the same table may be used under several names."""
    return left_on(facts, master, on, take)


def override(df: DataFrame, fixes: DataFrame, key: str, column: str, new: str) -> DataFrame:
    """Correction table: the new value wins where there is one."""
    slim = fixes.select(F.col(key).alias("_key"), F.col(new).alias("_new"))
    return (
        df.join(slim, F.col(key) == F.col("_key"), "left")
        .withColumn(column, F.coalesce("_new", column))
        .drop("_key", "_new")
    )


def map_latest(
    df: DataFrame, mapping: DataFrame, keys: Sequence[str], column: str, new: str, order: Sequence[str]
) -> DataFrame:
    """Replace ``column`` by the newest mapping of its (trimmed) composite key."""
    trimmed = [F.trim(F.col(k).cast("string")) for k in keys]
    usable = mapping.dropna(subset=[*keys, new]).select(
        *[c.alias(f"_m{i}") for i, c in enumerate(trimmed)], F.col(new).alias("_new"), *order
    )
    names = [f"_m{i}" for i in range(len(keys))]
    newest = latest_by(usable, names, order).select(*names, "_new")
    match = F.lit(True)
    for name, c in zip(names, trimmed):
        match = match & (c == F.col(name))
    return (
        df.join(newest, match, "left")
        .withColumn(column, F.coalesce("_new", column))
        .drop(*names, "_new")
    )


def semi_on(df: DataFrame, ids: DataFrame, key: str, other: str) -> DataFrame:
    """``key IN (SELECT other …)``."""
    return df.join(ids.select(F.col(other).alias("_id")), F.col(key) == F.col("_id"), "left_semi")


def anti_on(df: DataFrame, ids: DataFrame, key: str, other: str) -> DataFrame:
    """Rows without a partner (``LEFT JOIN … IS NULL``): a null key has none and is kept."""
    return df.join(ids.select(F.col(other).alias("_id")), F.col(key) == F.col("_id"), "left_anti")


def anti_null_safe(df: DataFrame, ids: DataFrame, key: str, other: str) -> DataFrame:
    """``key NOT IN (SELECT other … WHERE other IS NOT NULL)``: a null key is dropped.

    Nulls leave both sides first, so the plain hash anti join applies instead of
    the null-aware one, which must broadcast the list.
    """
    return anti_on(df.filter(F.col(key).isNotNull()), ids.filter(F.col(other).isNotNull()), key, other)


def or_join(
    left: DataFrame, right: DataFrame, either: Sequence[str], key: str, take: Sequence[str], row_id: Sequence[str]
) -> DataFrame:
    """Left join on ``a = key OR b = key`` without a nested loop.

    One equi-join per alternative over the left keys only; matches are
    deduplicated on (row id, right row) and joined to the left table once.
    ``row_id`` must identify a left row.
    """
    slim = right.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_t_{c}") for c in take])
    hits = None
    for column in either:
        matched = left.select(*row_id, F.col(column).alias("_k")).join(slim, F.col("_k") == F.col("_key")).drop("_k")
        hits = matched if hits is None else hits.unionByName(matched)
    hits = hits.distinct()
    names = {c: f"_i{i}" for i, c in enumerate(row_id)}
    hits = hits.withColumnsRenamed(names)
    same = F.lit(True)
    for c, n in names.items():
        same = same & left[c].eqNullSafe(hits[n])
    return (
        left.join(hits, same, "left")
        .drop(*names.values(), "_key")
        .withColumnsRenamed({f"_t_{c}": c for c in take})
    )


def coalesce_sources(
    base: DataFrame, sources: Sequence[tuple[DataFrame, Column]], on: str, columns: Sequence[str]
) -> DataFrame:
    """Left join several sources, each only for the rows its condition names, and
    take the first non-null value per column.

    The condition is part of the join, so a base row without it is kept.
    """
    out = base
    for i, (source, condition) in enumerate(sources):
        slim = source.select(
            F.col(on).alias(f"_s{i}_id"), *[F.col(c).alias(f"_s{i}_{c}") for c in columns]
        )
        out = out.join(slim, (F.col(on) == F.col(f"_s{i}_id")) & condition, "left")
    merged = {
        c: F.coalesce(*[F.col(f"_s{i}_{c}") for i in range(len(sources))]) for c in columns
    }
    spare = [f"_s{i}_{c}" for i in range(len(sources)) for c in ["id", *columns]]
    return out.withColumns(merged).drop(*spare)


def pairs_with_default(
    subjects: DataFrame,
    facts: DataFrame,
    subject_key: str,
    fact_key: str,
    n_pairs: int,
    take: Sequence[str],
) -> DataFrame:
    """Every subject with every pair of a fixed list: matching facts, else one row of nulls.

    ``facts.pair`` is the number of a fact's pair, from 0.  Subjects are not
    multiplied before the join: facts are joined once, and the pairs a subject
    lacks come from the set of its pairs, combined map-side and never longer than the list.
    """
    numbered = facts.select(F.col(fact_key).alias("_fk"), F.col("pair").cast("int").alias("pair"), *take)
    found = subjects.join(numbered, F.col(subject_key) == F.col("_fk")).drop("_fk")
    sets = numbered.groupBy("_fk").agg(F.collect_set("pair").alias("_has"))
    everything = F.array(*[F.lit(i) for i in range(n_pairs)])
    lacking = F.array_except(everything, F.coalesce("_has", F.array().cast("array<int>")))
    missing = (
        subjects.join(sets, F.col(subject_key) == F.col("_fk"), "left")
        .withColumn("pair", F.explode(lacking))
        .drop("_fk", "_has")
    )
    kinds = dict(numbered.dtypes)
    missing = missing.withColumns({c: F.lit(None).cast(kinds[c]) for c in take})
    return found.unionByName(missing)


def prefix_join(ids: DataFrame, names: DataFrame, id_column: str, name_column: str) -> DataFrame:
    """Names that start with an id, as an equi-join on the prefixes of the lengths that ids have.

    The lengths and last characters that ids have together (a few values) are a scalar subquery: a name makes one row
    for each length where its character is the last one of some id of that length.
    """
    return ids.join(_prefixes(ids, names, id_column, name_column), F.col(id_column) == F.col("_prefix")).drop("_prefix")


def _prefixes(ids: DataFrame, names: DataFrame, id_column: str, name_column: str) -> DataFrame:
    """Names with each ``_prefix`` that has the length and the last character of some id."""
    ends = ids.filter(F.length(id_column) > 0).agg(F.collect_set(F.struct(F.length(id_column).alias("n"), F.right(id_column, F.lit(1)).alias("end")))).scalar()
    name = F.col(name_column)
    reached = F.filter("_ends", lambda e: (e["n"] <= F.length(name)) & (F.substr(name, e["n"], F.lit(1)) == e["end"]))
    prefixed = names.filter(F.length(name) > 0).withColumn("_ends", ends).withColumn("_n", F.explode(F.array_distinct(F.transform(reached, lambda e: e["n"]))))
    return prefixed.withColumn("_prefix", F.substr(name_column, F.lit(1), F.col("_n"))).drop("_n", "_ends")
