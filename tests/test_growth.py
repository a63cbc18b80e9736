"""What a task holds, a row carries or a shuffle moves must not grow faster than the input."""

import glob
import os
import random
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from strandmart.checks import source_checks
from strandmart.checks.registry import ORACLES, QUERIES, Inputs
from strandmart.checks.warehouse import DerivedTables
from strandmart.operators.joins import _prefixes, prefix_join
from strandmart.operators.merge import upsert
from strandmart.operators.ranking import dealt
from strandmart.plans.gold import sample_qc, transfer_report
from strandmart.plans.staging import demography, illumina_secondary
from strandmart.session import DEALT, DICTIONARY, MOST_DEALT, PIECE, SCAN, STATISTICS, TASK_BYTES, bound_tasks, fit_tasks
from strandmart.sources import reports
from strandmart.sources.indexed import IndexedTable
from tests.compare import compare
from tests.conftest import DATA


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.fixture
def inputs(spark, tmp_path):
    """A few orders and lines."""
    orders = spark.range(40).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), (F.col("id") * 1.5).alias("o_totalprice"),
        F.lit(datetime(1998, 1, 1)).alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
    )
    lines = spark.range(120).select(
        (F.col("id") % 40).alias("l_orderkey"), F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"), (F.col("id") % 7).cast("int").alias("l_linenumber"),
        F.lit(1.0).alias("l_quantity"), F.lit(10.5).alias("l_extendedprice"), F.lit(0.1).alias("l_tax"), F.lit("A").alias("l_returnflag"), F.lit(datetime(1998, 1, 1)).alias("l_shipdate"),
    )
    for name, rows in (("orders", orders), ("lineitem", lines)):
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    return Inputs(spark, str(tmp_path))


def test_members_carry_a_number_and_not_the_text_of_their_group(spark):
    rng = random.Random(3)
    rows = [(f"n{rng.randrange(9)}", str(rng.randrange(3)), f"AAA{rng.randrange(60)}") for _ in range(200)] + [(None, "1", "AAA1"), ("n1", None, "AAA2")]
    people = spark.createDataFrame(rows, "full_name string, nik string, phenovar_id_subject string")
    groups, texts = demography.duplicate_texts({}, people)
    assert dict(groups.dtypes)["_duplicate"] == "bigint"
    text = {r["_duplicate"]: r["duplicate_name_nik_id_subject"] for r in texts.collect()}
    assert [text[k] for k in sorted(text)] == sorted(set(text.values()))
    got = {(r.full_name, r.nik): text[r["_duplicate"]] for r in groups.collect()}
    assert got == {(r.full_name, r.nik): r.duplicate_name_nik_id_subject for r in demography.same_name_and_id(people).collect()}


def test_a_groups_text_is_written_once_for_many_rows(spark, tmp_path):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before, rng = spark.conf.get(key), random.Random(6)
    long = {k: ",".join(str(rng.random()) for _ in range(10_000)) for k in range(10)}
    texts = spark.createDataFrame([*long.items(), (10, "a,b")], "_duplicate long, duplicate_name_nik_id_subject string")
    members = [(f"AAA{k}", k % 13 if k % 13 < 11 else None) for k in range(1300)] + [("AAA0", 0), (None, 1)]
    rows = spark.createDataFrame(rng.sample(members, len(members)), "id_subject string, _duplicate long")
    try:
        for n, most in enumerate((before, "-1")):
            spark.conf.set(key, most)
            demography.with_texts({}, rows, texts).write.parquet(f"{tmp_path}/{n}")
            got = spark.read.parquet(f"{tmp_path}/{n}").select("id_subject", "_duplicate", F.md5("duplicate_name_nik_id_subject").alias("md5")).collect()
            md5 = {r["_duplicate"]: r.md5 for r in texts.select("_duplicate", F.md5("duplicate_name_nik_id_subject").alias("md5")).collect()}
            assert sorted(map(str, got)) == sorted(str(Row(id_subject=i, _duplicate=k, md5=md5.get(k))) for i, k in members)
            size = sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/{n}/*.parquet"))
            # a thousand rows have a long text; a text has three or four parts
            assert size < 5 * sum(map(len, long.values())), size
    finally:
        spark.conf.set(key, before)
        bound_tasks(spark)
    assert spark.conf.get(DICTIONARY, None) is None and not [k for k in spark.conf.getAll if k.startswith(STATISTICS)]


def test_rows_of_a_large_group_lie_in_several_tasks(spark):
    texts = spark.createDataFrame([(0, "x" * (demography.PART_TEXT * 9)), (1, "y,z")], "_duplicate long, duplicate_name_nik_id_subject string")
    rows = spark.range(1200).select(F.concat(F.lit("AAA"), "id").alias("id_subject"), F.when(F.col("id") < 500, 0).when(F.col("id") < 502, 1).alias("_duplicate"))
    parts, key = demography.with_texts({}, rows, texts), "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        tasks = {r["_duplicate"]: r.n for r in parts.groupBy("_duplicate", F.spark_partition_id().alias("p")).count().groupBy("_duplicate").agg(F.count("p").alias("n")).collect()}
    finally:
        spark.conf.set(key, before)
        bound_tasks(spark)
    assert tasks[0] > 1 and tasks[None] > 1 and tasks[1] == 1


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        table = IndexedTable(spark, str(tmp_path), ["id"], 1)
        table.write(spark.range(0, 200_000, 1, 8).select("id", F.hash("id").alias("v")), "v1")
    finally:
        spark.conf.set(key, before)
    assert len(glob.glob(f"{tmp_path}/data/v1/_bucket=0/*.parquet")) > 1 and table.shares().count() == 1
    assert table.read().count() == 200_000 and table.shares().first().rows == 200_000


def test_tasks_are_bounded_and_smaller_settings_stay(spark):
    before = {key: spark.conf.get(key) for key in TASK_BYTES}
    try:
        for own, kept in (("1g", False), ("64k", True)):
            for key in TASK_BYTES:
                spark.conf.set(key, own)
            bound_tasks(spark)
            assert all((spark.conf.get(key) == own) is kept for key in TASK_BYTES)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_the_number_of_tasks_follows_the_input_of_one_query(spark):
    keys = (SCAN, PIECE, DEALT, "spark.sql.shuffle.partitions")
    before = {key: spark.conf.get(key, None) for key in keys}
    at = lambda key: spark.conf.get(key, None)
    try:
        for own in (None, "50"):
            spark.conf.set(DEALT, own) if own else spark.conf.unset(DEALT)
            bound_tasks(spark)
            scan = at(SCAN)
            for size, dealt in ((0, own), (4 << 20, own), ((400 << 20) + 1, "101"), (1 << 60, str(MOST_DEALT)), (40 << 20, str(MOST_DEALT))):
                fit_tasks(spark, size)
                assert at(DEALT) == dealt and at(SCAN) == "8m"
            bound_tasks(spark)
            assert at(DEALT) == own and at(SCAN) == scan == TASK_BYTES[SCAN]
        spark.conf.unset(DEALT)
        spark.conf.set("spark.sql.shuffle.partitions", "5000")
        spark.conf.set(SCAN, "1m")
        fit_tasks(spark, 1 << 60)
        assert at(DEALT) is None and at(SCAN) == "1m"
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)


def test_pieces_grow_before_a_shuffle_holds_its_rows_in_memory(spark):
    before = {key: spark.conf.get(key, None) for key in (SCAN, PIECE, DEALT)}
    try:
        bound_tasks(spark)
        for size, number in ((800, 200), (2400, 200), (3200, 200), (3600, 225)):
            fit_tasks(spark, size << 20)
            assert spark.conf.get(DEALT) == str(number)
            bound_tasks(spark)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)


def test_an_upserts_batch_is_dealt_before_it_is_sorted(spark):
    # one task has all rows, half of one key, a third of them equal
    rows = [(k % 300 if k % 2 else 7, None if k % 3 else 1, f"v{k % 5}") for k in range(6000)]
    batch = spark.createDataFrame(rows, "id long, n int, v string").coalesce(1)
    target = spark.createDataFrame([(7, "old"), (9, "old"), (1000, "old"), (None, "old")], "id long, v string")
    out = upsert(target, batch, ["id"], (), ["n", "v"])
    below = [x.split("hashpartitioning(")[1] for x in plan(out, "sparkPlan").splitlines() if "REPARTITION_BY_COL" in x or "RepartitionByExpression" in x or "hashpartitioning" in x]
    assert below and all("_task" in x for x in below), plan(out, "sparkPlan")
    sizes = [len(p) for p in dealt(batch).rdd.glom().collect()]
    assert sum(sizes) == 6000 and dealt(batch).columns == batch.columns
    best = {}
    for i, n, v in rows:
        best[i] = max(best.get(i, (-1, "")), (n or 0, v))
    want = {**{i: v for i, (_, v) in best.items()}, 1000: "old", None: "old"}
    got = out.collect()
    assert {r.id: r.v for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("name", ["upserts_registry", "upserts_registry_forms"])
def test_upserts_of_a_larger_table_have_more_tasks_not_larger_ones(spark, tmp_path, name):
    orders, rng, con = 30_000, random.Random(5), duckdb.connect()
    folder, own = str(tmp_path), {PIECE: "8k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    # ids with gaps; no null or repeated ones, as the oracle's full join holds none
    spark.createDataFrame([(k, rng.random()) for k in rng.sample(range(10**6), orders)], "o_orderkey long, o_totalprice double").write.parquet(f"{folder}/orders.parquet")
    con.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{folder}/orders.parquet/*.parquet')")
    before = {key: spark.conf.get(key, None) for key in own}
    try:
        for key, value in own.items():
            spark.conf.set(key, value)
        rows, problem = compare(spark, con, folder, name, QUERIES[name], ORACLES[name])
        part = QUERIES[name](spark, folder).select(F.spark_partition_id().alias("p")).groupBy("p").count()
        largest = part.agg(F.max("count")).first()[0]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)
        bound_tasks(spark)
    assert not problem and rows > orders
    # two thirds of the orders are a target; the session deals them to four partitions
    assert largest < orders * 2 / 3 / 16, largest


def test_short_logs_are_not_shuffled_and_long_ones_give_the_same(spark, monkeypatch):
    texts = ["Computed yield for biosample 'B1' (Id: 1): 2 Bps\nGenerated new Sample: 8", "x 'two words'\nComputed yield for biosample 'two words' (Id: 3): 4 Bps\r\nGenerated new Sample: 5\nGenerated new Sample: 6",
             "Computed yield for biosample 'Sample' (Id: 1): 99999999999999999999 Bps\nGenerated new Sample: 5\nComputed yield for biosample 'Sample' (Id: 2): 1 Bps", "", None, "end"]
    logs = spark.createDataFrame([(k, t) for k, t in enumerate(texts * 2)], "k int, content string")
    short = reports.parse_yield_log(logs, ["k"])
    assert "Exchange" not in plan(short)
    monkeypatch.setattr(reports, "ROW_WORK", -1)
    assert sorted(map(str, short.collect())) == sorted(map(str, reports.parse_yield_log(logs, ["k"]).collect())) and short.count() == 8


def test_sessions_are_parsed_once(inputs):
    runs = reports.sessions_to_runs(source_checks._sessions(inputs), "1997-01-01")
    assert plan(runs, "optimizedPlan").count("from_json(") == 1
    assert runs.count() == 120 and {r.ica_project_id for r in runs.collect()} == {"1-URGENT"}


def test_a_sessions_log_is_parsed_once_for_all_its_runs(spark, monkeypatch):
    run = "struct<Id: string, Name: string, ExperimentName: string, DateCreated: string>"
    kind = f"Id string, Name string, DateCreated string, DateModified string, ExecutionStatus string, HrefIcaAnalysis string, Properties struct<Items: array<struct<Name: string, Content: string, RunItems: array<{run}>>>>"
    log = "Computed yield for biosample 'B' (Id: 5): 77 Bps"
    items = [("Logs.Tail", "old", None), ("Logs.Tail", log, None), ("Input.Runs", None, [(str(k), f"r{k}", None, None) for k in range(50)]), (None, "x", None)]
    rows = [("1", "BCLConvert", "2025-01-01T00:00:00Z", None, None, None, (items,)), ("2", "BCLConvert", "2025-01-01T00:00:00Z", None, None, None, None)]
    parse, seen = reports.parse_yield_log, []
    monkeypatch.setattr(reports, "parse_yield_log", lambda logs, keep: seen.append(logs.count()) or parse(logs, keep))
    out = reports.sessions_to_biosamples(spark.createDataFrame(rows, kind), "2024-01-01")
    assert seen == [1] and sorted(r.run_name for r in out.collect()) == sorted(f"r{k}" for k in range(50))


def test_names_make_prefixes_only_where_an_id_can_end(spark):
    ids = spark.createDataFrame([("C1.",), ("C12345.",), ("C123",), ("",), (None,)], "id string")
    names = spark.createDataFrame([("C1.x_555zz",), ("C12345.a",), ("C123",), ("C1",), ("",), (None,)], "n string")
    assert sorted(r["_prefix"] for r in _prefixes(ids, names, "id", "n").collect()) == ["C1.", "C123", "C123", "C12345."]
    assert sorted(tuple(r) for r in prefix_join(ids, names, "id", "n").collect()) == [("C1.", "C1.x_555zz"), ("C123", "C123"), ("C123", "C12345.a"), ("C12345.", "C12345.a")]


def test_a_split_file_holds_a_bounded_number_of_records(inputs, tmp_path, monkeypatch):
    monkeypatch.setattr(source_checks, "FILE_RECORDS", 10)
    monkeypatch.setattr(source_checks, "scratch", lambda t: f"{tmp_path}/split")
    rows = source_checks._split(inputs).collect()
    assert len(glob.glob(f"{tmp_path}/split/*.csv")) > 1
    assert sorted(int(r.id) for r in rows) == list(range(40)) and [r.id for r in rows if r.is_last] == ["39"]


def test_joins_of_one_key_share_a_shuffle(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        tables = DerivedTables(Inputs(spark, DATA))
        shuffles = plan(illumina_secondary.run(tables)).split("+- == Initial Plan ==")[0].count("Exchange hashpartitioning")
    finally:
        spark.conf.set(key, before)
    assert shuffles <= 10, shuffles


def test_analyses_are_not_sorted_before_they_are_dealt(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        lines = plan(sample_qc.unified(DerivedTables(Inputs(spark, DATA)))).split("+- == Initial Plan ==")[0].splitlines()
    finally:
        spark.conf.set(key, before)
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    dealt = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
    # a shuffle for each platform, the samples, the biobank rows, and two for the subjects: none for what was joined already
    assert len(dealt) == 7, "\n".join(lines)
    for i in dealt:
        inside = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
        below = "\n".join(lines[i:inside])
        assert "WindowGroupLimit" not in below and ("Sort [" not in below or "Join" in below), below


def test_a_sample_takes_the_newest_analysis_of_its_own_platform(spark):
    at = lambda d: datetime(2025, 1, d)
    shared = "id_repository string, run_name string, date_start timestamp, median_coverage double"
    rows = {
        "staging_illumina_sec": [("S1", "i1", at(1), 1.0), ("S1", "i3", at(3), 2.0), ("S1", "i2", at(2), 3.0), ("S2", "i4", None, 4.0), (None, "i5", at(9), 5.0), ("Control1", "i6", at(9), 6.0)],
        "staging_mgi_sec": [("S1", "m1", at(5), 7.0), ("S2", "m2", at(1), 8.0), ("S2", "m3", at(1), 8.0), ("S2", "m0", None, 9.0)],
        "staging_ont_sec": [("S1", "o1", at(9), 10.0)],
    }
    tables = {name: spark.createDataFrame(r, shared).withColumns({"ploidy_estimation": F.lit("XX"), "id_batch": F.lit("B")}) for name, r in rows.items()}
    seq = [("S1", "Illumina"), ("S1", "Illumina"), ("S1", "MGI"), ("S2", "MGI"), ("S2", "Other"), ("S3", "ONT"), (None, "ONT"), ("Control1", "Illumina"), ("S2", None)]
    tables["staging_seq"] = spark.createDataFrame([(*r, None, None) for r in seq], "id_repository string, sequencer string, id_library string, id_index double")
    people = [("S1", "P1", "AAA1", "MALE"), ("S2", "P2", None, "MALE"), ("S2", "P3", "AAA3", "MALE"), (None, "P4", "AAA1", "MALE")]
    tables["staging_simbiox_biosamples_patients"] = spark.createDataFrame(people, "code_repository string, id_patient string, id_subject string, registry_sex string").withColumns({"id_mpi": F.lit("m"), "biobank_nama": F.lit("b"), "patient_categ": F.lit("p")})
    tables["staging_demography"] = spark.createDataFrame([("AAA1", True), ("AAA3", False), ("AAA3", True), (None, True)], "id_subject string, is_excluded boolean")
    got = [(r.id_repository, r.sequencer, r.run_name, r.id_patient, r.is_excluded) for r in sample_qc.unified(tables).collect()]
    two = [("P2", None), ("P3", False), ("P3", True)]
    want = [("S1", "Illumina", "i3", "P1", True)] * 2 + [("S1", "MGI", "m1", "P1", True), ("S3", "ONT", None, None, None)]
    want += [("S2", "MGI", "m2", *p) for p in two] + [("S2", "Other", None, *p) for p in two]
    assert sorted(map(str, got)) in (sorted(map(str, want)), sorted(map(str, want + [(None, "ONT", None, None, None)])))


def test_transfers_meet_samples_that_have_their_patients(spark):
    tables = DerivedTables(Inputs(spark, DATA))
    transfer_report.run(tables)
    assert {"samples", "transfers"} == set(tables.steps.plans)
    assert plan(tables.steps.plans["transfers"], "optimizedPlan").count("Join LeftOuter") == 1
