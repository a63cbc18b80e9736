"""Properties of the operators: order, partitioning, repetition, hot keys."""

import pytest
from pyspark.sql import functions as F

from strandmart.operators import (
    dense_rank_by,
    first_flag,
    group_totals,
    insert_absent,
    latest_by,
    or_join,
    pairs_with_default,
    prefix_join,
    upsert,
)
from strandmart.plans.upserts import RUN, SPECS, UNSET, apply_upsert


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows has one key, some keys are null, some rows are equal."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 31 == 1, None).otherwise(F.col("id") % 50)
    return spark.range(3000).select(key.alias("k"), (F.col("id") % 11).alias("v"), (F.col("id") % 4).alias("w"))


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_latest_by_ignores_input_order(hot, parts):
    once = rows(latest_by(hot, ["k"], ["v"]))
    assert rows(latest_by(hot.orderBy(F.rand(parts)).repartition(parts), ["k"], ["v"])) == once
    assert len(once) == hot.select("k").distinct().count()


def test_latest_by_limits_before_the_shuffle(hot):
    plan = latest_by(hot, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_first_flag_marks_one_row_per_key(hot):
    out = first_flag(hot, ["k"], ["v"])
    assert out.count() == hot.count()
    firsts = out.groupBy("k").agg(F.count_if("is_first").alias("n")).filter("n <> 1")
    assert firsts.count() == 0


def test_group_totals_and_ranks_keep_all_rows(hot):
    totals = group_totals(hot, ["k"], {"n": F.count(F.lit(1))})
    assert totals.count() == hot.count()
    assert totals.filter("k IS NULL").select("n").distinct().collect()[0][0] == hot.filter("k IS NULL").count()
    ranked = dense_rank_by(hot, ["k"], "v", "r")
    assert ranked.count() == hot.count()
    assert ranked.filter("k = 7").agg(F.max("r")).collect()[0][0] == hot.filter("k = 7").select("v").distinct().count()


def test_or_join_equals_nested_loop(spark):
    left = spark.createDataFrame([(1, "a", "b"), (2, "x", None), (3, "b", "b"), (4, None, None)], "id int, p string, q string")
    right = spark.createDataFrame([("a", "r1"), ("b", "r2"), ("b", "r3")], "key string, why string")
    got = rows(or_join(left, right, ["p", "q"], "key", ["why"], ["id"]).select("id", "why"))
    loop = left.join(right, (F.col("p") == F.col("key")) | (F.col("q") == F.col("key")), "left").select("id", "why")
    assert got == rows(loop)


def test_prefix_join_equals_nested_loop(spark):
    ids = spark.createDataFrame([("0C1",), ("0C12",), ("9",)], "id string")
    names = spark.createDataFrame([("0C12_x",), ("0C1",), ("zz",), ("9/a",)], "n string")
    loop = ids.join(names, F.col("n").startswith(F.col("id"))).select("id", "n")
    assert rows(prefix_join(ids, names, "id", "n").select("id", "n")) == rows(loop)


def test_pairs_with_default(spark):
    subjects = spark.createDataFrame([("s1", "f1"), ("s2", "f2"), ("s3", None)], "s string, f string")
    facts = spark.createDataFrame([("f1", 0, "x"), ("f1", 0, "y"), ("f1", 2, "z")], "o string, pair int, v string")
    got = rows(pairs_with_default(subjects, facts, "f", "o", 3, ["v"]).select("s", "pair", "v"))
    assert got == sorted(
        [("s1", 0, "x"), ("s1", 0, "y"), ("s1", 1, None), ("s1", 2, "z")]
        + [(s, p, None) for s in ("s2", "s3") for p in range(3)], key=str,
    )


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "a", "old", "t0"), (2, "b", "old", "t0")], "id int, v string, created_at string, updated_at string")


def test_upsert_last_row_wins_and_keeps(spark, target):
    batch = spark.createDataFrame(
        [(2, "x", "new", "t1", 1), (2, "y", "new", "t1", 2), (3, "z", "new", "t1", 1)],
        "id int, v string, created_at string, updated_at string, n int",
    )
    once = upsert(target, batch, ["id"], ["created_at"], ["n"], ("updated_at", F.lit("run")))
    assert rows(once) == [(1, "a", "old", "t0"), (2, "y", "old", "run"), (3, "z", "new", "t1")]
    twice = upsert(once, batch, ["id"], ["created_at"], ["n"], ("updated_at", F.lit("run")))
    assert rows(twice) == [(1, "a", "old", "t0"), (2, "y", "old", "run"), (3, "z", "new", "run")]
    assert rows(insert_absent(target, batch.drop("n"), ["id"])) == [(3, "z", "new", "t1")]


def test_upsert_without_a_target_column_in_the_batch(spark, target):
    batch = spark.createDataFrame([(2, "x"), (9, "n")], "id int, v string")
    assert rows(upsert(target, batch, ["id"], (), ["v"])) == [(1, "a", "old", "t0"), (2, "x", "old", "t0"), (9, "n", None, None)]


@pytest.mark.parametrize("name", list(SPECS))
def test_upsert_specifications(spark, name):
    """Every specification: insert-only columns stay, the stamp follows its mode."""
    spec = SPECS[name]
    columns = list(dict.fromkeys([*spec.keys, *spec.keep, "payload", "created_at", "updated_at"]))
    kinds = ", ".join(f"`{c}` string" for c in columns)

    def row(key, tag):
        return tuple(key if c in spec.keys else f"{tag}-{c}" for c in columns)

    old = spark.createDataFrame([row("k1", "old"), row("k2", "old")], kinds)
    new = spark.createDataFrame([row("k2", "new"), row("k3", "new")], kinds)
    got = {r[spec.keys[0]]: r.asDict() for r in apply_upsert(spec, old, new, F.lit("run"), ("payload",)).collect()}
    assert set(got) == {"k1", "k2", "k3"}
    assert got["k2"]["payload"] == "new-payload" and got["k1"]["payload"] == "old-payload"
    for c in set(spec.keep) - set(spec.keys):
        assert got["k2"][c] == f"old-{c}"
    stamp = {RUN: "run", UNSET: "old-updated_at"}.get(spec.stamp, "new-updated_at")
    assert got["k2"]["updated_at"] == stamp
    assert got["k3"]["updated_at"] == "new-updated_at"


def test_collect_parallel_has_one_row_per_key(hot):
    from strandmart.operators import collect_parallel

    whole = collect_parallel(hot, ["k"], ["v", "w"], ["v", "w"])
    assert whole.count() == hot.select("k").distinct().count() and whole.filter("size(v) <> size(w)").count() == 0
    assert rows(whole.select("k", F.explode(F.arrays_zip("v", "w")).alias("e")).select("k", "e.*")) == rows(hot)
