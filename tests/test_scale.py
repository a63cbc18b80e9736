"""What must not grow faster than its input: logs, large files, joined texts and ranks of a hot key, upserts of few keys."""

import csv
import io
import random
import re
import time

from pyspark.sql import functions as F

from strandmart.operators import concat_distinct, concat_sorted, dense_rank_by
from strandmart.plans import report_chain
from strandmart.sources import big_csv, bronze
from strandmart.sources.indexed import IndexedTable
from strandmart.sources.reports import YIELD_LINE, parse_yield_log


def brute_log(text):
    for line in re.split(r"\r\n|\r|\n", text):
        if m := re.search(YIELD_LINE, line):
            found = re.search(rf"{re.escape(m[1])}.*?Generated new Sample:\s+(\d+)", text, flags=re.DOTALL)
            yield m[1], m[2], int(m[3]), found and found[1]


def log_text(rng, lines):
    names = [rng.choice(["S1", "S12", "xS1_9", "C-77.b", "two words", "Łódź"]) + rng.choice(["", "a", str(k)]) for k in range(lines)]
    out = []
    for k in range(lines):
        name = rng.choice(names)
        out.append(rng.choice([
            f"Computed yield for biosample '{name}' (Id: {k}): {k * 7} Bps", f"Generated new Sample:  {k}", f"mention of {name}_L001 and more", "Generated new Sample: x", f"Generated new Sample:\n {k}",
        ]))
    return rng.choice(["\n", "\r\n"]).join(out)


def test_logs_equal_a_search_for_each_line(spark):
    rng = random.Random(4)
    texts = [log_text(rng, rng.choice([0, 1, 5, 40])) for _ in range(60)] + [None, "", log_text(random.Random(1), 40)] * 2
    logs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, content string")
    got = sorted(map(str, (tuple(r) for r in parse_yield_log(logs, ["k"]).collect())))
    assert got == sorted(str((k, *row)) for k, t in enumerate(texts) if t for row in brute_log(t))


def test_time_to_parse_a_log_follows_its_length(spark):
    def seconds(lines):
        text = "\n".join(f"Computed yield for biosample 'SAMPLE{k}' (Id: {k}): {k} Bps\nGenerated new Sample: {k}" for k in range(lines // 2))
        start = time.perf_counter()
        rows = parse_yield_log(spark.createDataFrame([(text,)], "content string"), []).collect()
        assert {(r.biosample_name, r.generated_sample_id) for r in rows if r.biosample_name in ("SAMPLE3", f"SAMPLE{lines // 2 - 1}")} == {("SAMPLE3", "3"), (f"SAMPLE{lines // 2 - 1}", str(lines // 2 - 1))}
        assert len(rows) == lines // 2
        return time.perf_counter() - start

    seconds(10)
    short, long = seconds(2_500), seconds(10_000)
    assert long < 5 * short + 2, (short, long)


def test_large_files_equal_the_csv_module(spark, tmp_path):
    rng = random.Random(5)
    fields = ["", "plain", 'a "quoted" word', "two\nlines", "comma, comma", "\n\n", "x" * 300, "line\n" * 400, '"', "ü\n\"ü\""]
    wanted = {}
    for name, n, end in (("a-2025-01-01", 3000, "\n"), ("b-2025-01-01", 500, "\r\n"), ("c-2025-01-01", 0, "\n")):
        rows = [[str(k), *rng.choices(fields, k=2)] for k in range(n)]
        text = io.StringIO(newline="")
        csv.writer(text, lineterminator=end).writerows([["id", "note", "note"], *rows])
        (tmp_path / f"{name}.csv").write_bytes(text.getvalue().encode())
        wanted[name] = rows
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        read = big_csv.read_bronze_large(spark, str(tmp_path), "2025-01-01", ["note.1", "id", "note"])
        blocks = read.select(f"{bronze.ROW_ORDER}.file", f"{bronze.ROW_ORDER}.block").distinct().count()
        found = {}
        for r in read.orderBy(bronze.ROW_ORDER).collect():
            found.setdefault(r[bronze.ROW_ORDER].file.rsplit("/", 1)[1][:12], []).append([r.id, r.note or "", r["note.1"] or ""])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {k: v for k, v in wanted.items() if v}
    assert blocks > 20
    assert big_csv.read_bronze_large(spark, str(tmp_path), "2030-01-01", ["id"]).count() == 0


def test_headers_over_many_lines_and_repeated_names(spark, tmp_path):
    long = "name\n" * 200
    (tmp_path / "a.csv").write_text(f'id,"{long}",note,note,\n1,2,3,4,5\n')
    (tmp_path / "b.csv").write_text("﻿id,note,note.1,note\n6,7,8,9\n")
    (tmp_path / "c.csv").write_text('id,"never closed\n1,2\n')
    rows = bronze.read_bronze_all(spark, str(tmp_path), ["id", long, "note", "note.1", "note.2", "Unnamed: 4"])
    assert sorted(tuple(r[:6]) for r in rows.collect()) == [("1", "2", "3", "4", None, "5"), ("6", None, "7", "8", "9", None)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joined_texts_meet_their_key_distinct(spark):
    rows = spark.range(2000).select(F.when(F.col("id") % 3 > 0, "hot").alias("k"), (F.col("id") % 7).cast("string").alias("a"), F.lit(None).cast("string").alias("b"), F.lit("x").alias("c"))
    distinct, repeated = concat_distinct(rows, ["k"], ["a", "b", "c"], ","), concat_sorted(rows, ["k"], "a", ",", "a")
    assert {tuple(r) for r in distinct.collect()} == {("hot", "0,1,2,3,4,5,6", None, "x"), (None, "0,1,2,3,4,5,6", None, "x")}
    got = {r.k: r.a.split(",") for r in repeated.collect()}
    assert {k: len(v) for k, v in got.items()} == {"hot": 1333, None: 667} and all(v == sorted(v) for v in got.values())
    assert concat_sorted(rows, ["k"], "b", ",", "b").where("b is not null").count() == 0
    # the first exchange is on key and value, so a hot key lies in many tasks there
    assert re.search(r"hashpartitioning\(k#\d+, _i#\d+, _v#\d+", plan_of(distinct)) and re.search(r"hashpartitioning\(k#\d+, _v#\d+", plan_of(repeated))


def test_dense_ranks_without_a_window_over_a_key(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "b", None]), rng.choice([None, *range(300)])) for _ in range(3000)]
    ranked = dense_rank_by(spark.createDataFrame(rows, "k string, v int"), ["k"], "v")
    order = {k: sorted({v for x, v in rows if x == k}, key=lambda v: (v is not None, v)) for k in {k for k, _ in rows}}
    assert sorted(map(str, (tuple(r) for r in ranked.collect()))) == sorted(str((k, v, order[k].index(v) + 1)) for k, v in rows)
    windows = re.findall(r"Window \[.*?windowspecdefinition\((.*?)\)", plan_of(ranked))
    assert windows and all(w.startswith("_part#") for w in windows)


def test_a_batch_of_one_key_writes_one_share(spark, tmp_path):
    table = IndexedTable(spark, str(tmp_path / "t"), ["a", "b"], 8)
    rows = spark.range(400).select((F.col("id") % 20).alias("a"), F.col("id").alias("b"), F.lit(1).alias("v"), F.lit("o").alias("w"))
    table.write(rows, "v1")
    before = {(r.bucket, r.folder) for r in table.shares().collect()}
    one = spark.createDataFrame([(3, 23, 5, 1), (3, 23, 6, 2)], "a int, b int, v int, k int")
    table.upsert(one, "v2", ["a", "b"], [], ["k"])
    after = {(r.bucket, r.folder) for r in table.shares().collect()}
    assert len(before - after) == len(after - before) == 1
    again = IndexedTable(spark, str(tmp_path / "t"), ["a", "b"])
    assert again.buckets == 8 and again.read().count() == 400
    assert [tuple(r) for r in again.read().where("a = 3 and b = 23").collect()] == [(3, 23, 6, "o")]
    assert table.shares("v1").count() == len(before)  # the old version can still be read
    for wrong in (lambda: table.upsert(one, "v2", ["a", "b"], [], ["k"]), lambda: table.upsert(one, "v3", ["a"], [], ["k"]), lambda: table.upsert(one, "a/b", ["a", "b"], [], ["k"]), lambda: IndexedTable(spark, str(tmp_path / "t"), ["a"])):
        try:
            wrong()
        except ValueError:
            continue
        raise AssertionError("accepted")


def test_reports_are_read_from_files(spark, tmp_path):
    (tmp_path / "out" / "x").mkdir(parents=True)
    (tmp_path / "out" / "x" / "ind.json").write_text('{"order_details": {"order_id": "R1"},\n "clinical_recommendations": [{"drug_name": "D", "gene_symbol": "G"}]}')
    prefix = "s3://" + report_chain.Buckets().pgx_output + "/"
    status = spark.createDataFrame([(prefix + "out/x/ind.json",), (prefix + "out/absent.json",), (None,)], "report_path_ind string").withColumn("ind_report_creation_date", F.lit("2025-01-01").cast("timestamp"))
    details, state = report_chain.detail_table(spark, str(tmp_path / "d"), 2), report_chain.state_table(spark, str(tmp_path / "s"), 2)
    read = report_chain.report_files(spark, str(tmp_path))
    assert report_chain.run_chain(status, "2024-10-01", read, details, state, "r1")
    assert [(r.order_id, r.drug_name) for r in details.read().collect()] == [("R1", "D")]
    assert not report_chain.run_chain(status.where("report_path_ind like '%x%'"), "2024-10-01", read, details, state, "r2")
