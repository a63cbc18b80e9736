"""Files, tables and streams on a local folder."""

import pytest

from strandmart.sources import bronze, inventory, reports, tables
from strandmart.streaming.event_log import LOG_COLUMNS, append_log, load_landed


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_bronze_files(spark, tmp_path):
    root = tmp_path / "bronze"
    put(root, "2025-01-01.csv", 'id,note\n1,"a, ""b""\nc"\n2,\n')
    put(root, "2025-01-02_1.csv", "id,note\n3,x\n")
    put(root, "2025-01-02_2.csv", "id,extra\n4,y\n")
    put(root, "2025-01-03.csv", "")
    one = bronze.read_bronze(spark, str(root), "2025-01-01", ["id", "note"])
    assert sorted(map(tuple, one.collect())) == [("1", 'a, "b"\nc'), ("2", None)]
    assert bronze.read_bronze(spark, str(root), "2030-01-01", ["id"]).count() == 0
    two = bronze.read_bronze_multi(spark, str(root), "2025-01-02")
    assert sorted(map(str, map(tuple, two.select("id", "note", "extra").collect()))) == ["('3', 'x', None)", "('4', None, 'y')"]
    assert bronze.read_bronze_all(spark, str(root)).count() == 4
    assert bronze.read_bronze_multi(spark, str(root), "2031") is None
    dated = bronze.date_of_file(one)
    assert str(dated.first()["ds"]) == "2025-01-01"


def test_head_names(spark):
    df = spark.createDataFrame([("a", 1)], "`id.S` string, n int")
    assert bronze.head_names(df).columns == ["id", "n"]


def test_merge_latest(spark, tmp_path):
    df = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", "b")], "id string, v string")
    assert bronze.merge_latest(df, str(tmp_path), "2025-01-01").count() == 2
    assert spark.read.option("header", True).csv(f"{tmp_path}/latest").count() == 2


def test_swapped_table(spark, tmp_path):
    table = tables.SwappedTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    table.write(spark.range(3), "v1")
    reader = table.read()
    table.write(table.read().filter("id > 0"), "v2")
    assert table.current() == "v2" and table.read().count() == 2
    assert reader.count() == 3
    with pytest.raises(ValueError):
        table.write(spark.range(1), "v2")


def test_full_refresh_and_samples(spark, tmp_path):
    tables.full_refresh(spark.range(5), str(tmp_path / "f"))
    tables.full_refresh(spark.range(2), str(tmp_path / "f"))
    assert spark.read.parquet(str(tmp_path / "f")).count() == 2
    for schema in ("prod_x", "stage_x"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{tmp_path}/{schema}'")
    tables.replace_table(spark.range(50), "prod_x.samples")
    tables.replace_table(spark.range(50), "prod_x.tmp_samples")
    assert tables.sample_catalog(spark, "prod_x", "stage_x", 10) == ["samples"]
    assert spark.table("stage_x.samples").count() == 10
    spark.sql("DROP DATABASE prod_x CASCADE")
    spark.sql("DROP DATABASE stage_x CASCADE")


def test_event_log(spark, tmp_path):
    rows = [("e1", "2025-01-01 10:00:00", "t", "h", "c", "{}"), ("e2", "2025-01-02 10:00:00", "t", "h", "c", "{}")]
    log = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in LOG_COLUMNS))
    other = spark.createDataFrame([("e3", "2025-01-01 23:00:00", "t", "h2", "c", "{}")], log.schema)
    append_log(log, str(tmp_path / "log"), "r1")
    append_log(other, str(tmp_path / "log"), "r2")
    append_log(log, str(tmp_path / "log"), "r1")
    assert sorted(r["ehr_id"] for r in spark.read.parquet(str(tmp_path / "log")).collect()) == ["e1", "e2", "e3"]


def test_landed_files_load_once(spark, tmp_path):
    header = ",".join(LOG_COLUMNS)
    put(tmp_path / "land", "2025-01-01.csv", f"{header}\ne1,2025-01-01 10:00:00,t,h,c,{{}}\n")
    args = [str(tmp_path / n) for n in ("land", "log", "ckpt")]
    load_landed(spark, *args)
    put(tmp_path / "land", "2025-01-02.csv", f"{header}\ne2,2025-01-02 10:00:00,t,h,c,{{}}\n")
    load_landed(spark, *args)
    load_landed(spark, *args)
    assert spark.read.parquet(args[1]).count() == 2


def test_inventory_from_files(spark, tmp_path):
    put(tmp_path / "runs" / "r1", "a.cram", "12345")
    put(tmp_path / "runs" / "r2", "b.txt", "1")
    objects = inventory.from_files(spark, str(tmp_path / "runs"), "bucket")
    assert sorted((r["key"], r["size"]) for r in objects.collect()) == [("r1/a.cram", 5), ("r2/b.txt", 1)]


def test_whole_reports(spark, tmp_path):
    put(tmp_path / "out" / "s1", "ind.json", '{"version": "v2", "order_details": {"order_id": "o"},\n "clinical_recommendations": [{"drug_name": "d"}]}')
    files = reports.read_whole(spark, str(tmp_path / "out"), "*.json")
    assert [tuple(r) for r in reports.report_versions(files).collect()] == [("s1/ind.json", "v2")]
    assert reports.explode_reports(files).select("order_id", "drug_name", "version").collect()[0] == ("o", "d", "v2")


def test_log_look_ahead(spark):
    log = "Computed yield for biosample 'A' (Id: 1): 10 Bps\nComputed yield for biosample 'B' (Id: 2): 20  Bps\nGenerated new Sample:  7\n"
    df = spark.createDataFrame([("x", log)], "k string, content string")
    got = sorted(map(tuple, reports.parse_yield_log(df, ["k"]).collect()))
    assert got == [("x", "A", "1", 10, "7"), ("x", "B", "2", 20, "7")]


def test_barcode_fallback(spark):
    keys = ["L/no_sample/r/bam_pass/S1_x/a.bam", "L/no_sample/r/bam_pass/barcode07/a.bam", "L/no_sample/q/bam_pass/S2/a.bam"]
    objects = spark.createDataFrame([(k,) for k in keys], "key string")
    known = spark.createDataFrame([("L/no_sample/q/",)], "prefix string")
    got = [tuple(r) for r in reports.barcodes_from_folders(objects, known).collect()]
    assert got == [("L/no_sample/r/", "S1_x")]
