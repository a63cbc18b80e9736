"""Golden cases of the id parsers and rules; rules are total."""

from itertools import product

import pytest
from pyspark.sql import functions as F

from strandmart.functions import dates, json_text, qc_rules, rules, text
from strandmart.plans.silver import decrypt_hex, form_group, group_table
from strandmart.settings import Buckets


def values(spark, rows, schema, *columns):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


def test_pair_category(spark):
    rows = [("XX", "FEMALE"), ("xy", "Male"), ("XX", None), ("nan", "MALE"), ("XY", "FEMALE"), (None, "MALE"), ("", "MALE")]
    got = values(spark, rows, "p string, s string", qc_rules.pair_category("p", "s"))
    assert got == ["Match", "Match", "No Data", "No Data", "Mismatch", "No Data", "No Data"]


def test_batch_category(spark):
    rows = [(3, 0), (2, 0), (2, 1), (1, 1), (0, 2), (0, 3), (1, 2)]
    got = values(spark, rows, "m int, n int", qc_rules.batch_category("m", "n"))
    assert got == ["Fail", "Pass", "Incomplete Data", "Pass", "Pass", "Incomplete Data", "Incomplete Data"]


def test_coverage_category(spark):
    rows = [
        (30.0, 85.0, "c", 5.0, "v"), (None, 0.0, None, None, None), (25.0, 90.0, "c", 5.0, "v"), (0.0, 0.0, "c", 5.0, "v"),
        (0.0, 0.0, "nan", 5.0, "v"), (float("nan"), 95.0, "c", 5.0, "v"),
    ]
    got = values(
        spark, rows, "a double, b double, c string, s double, v string",
        qc_rules.coverage_category("a", "b", "c", "s", "v"),
    )
    assert got == ["Pass", "No Data", "No Data", "Fail", "No Data", "No Data"]


def test_ont_yield(spark):
    rows = [("ONT", "0"), ("ONT", "59000000000"), ("ONT", "60000000000"), ("ONT", "90000000000"), ("ONT", None), ("MGI", "5")]
    got = values(spark, rows, "s string, y string", qc_rules.ont_yield_status("s", "y"))
    assert got == ["No Yield", "Yield < 60GB", "60GB ≤ Yield < 90GB", "High Yield", "No Yield", ""]


# A few states and their labels.
KNOWN_STATES = {
    ("Pass", "Pass", "Match", False, False, False): ("Pass", "Pass", "Pass", "Pass"),
    ("Pass", "Incomplete Data", "No Data", False, True, False): (
        "Incomplete Data", "Stalled: Registry", "Incomplete Data (No Registry Sex Data)", "Incomplete Data"),
    ("Fail", "Fail", "No Data", True, False, False): (
        "Fail", "Fail", "Fail (Coverage and Batch Sex Check), Incomplete Data (No Ploidy Data)", "Fail (Coverage QC)"),
    ("Fail", "Fail", "Match", True, False, False): (
        "Fail", "Fail", "Fail (Coverage and Batch Sex Check)", "Fail (Coverage and Batch Sex Check)"),
    ("No Data", "Pass", "Mismatch", True, False, False): (
        "Fail", "Fail", "Fail (Sex Check), Incomplete Data (No Coverage Data)", "Fail (Sex Check)"),
    ("No Data", "Pass", "No Data", True, True, True): (
        "Incomplete Data", "Stalled: Registry/Analysis", "Incomplete Data (No Registry and QC Data)", "Incomplete Data"),
    ("No Data", "Pass", "Match", False, False, False): (
        "Incomplete Data", "Stalled: Batch Analysis", "Incomplete Data (No Coverage Data)", "Undefined"),
    ("Fail", "Pass", "Mismatch", True, False, False): (
        "Fail", "Fail", "Fail (Coverage QC and Sex Check)", "Fail (Coverage and Sex Check)"),
    ("Pass", "Fail", "Mismatch", False, False, False): ("Fail", "Fail", "Fail (Sex Check)", "Fail (Sex Check)"),
}


def test_state_labels(spark):
    df = spark.createDataFrame(qc_rules.STATES, "a string, b string, c string, x boolean, y boolean, z boolean")
    df = df.withColumn("s", qc_rules.qc_state("a", "b", "c", "x", "y", "z"))
    labels = [f("s") for f in (qc_rules.strict_status, qc_rules.strict_progress, qc_rules.strict_reason, qc_rules.strict_diagnosis)]
    got = {tuple(r)[:6]: tuple(r)[7:] for r in df.select("*", *labels).collect()}
    assert len(got) == 216 and all(None not in v for v in got.values())
    assert all(v[2] != "Unidentified" for v in got.values())
    for state, wanted in KNOWN_STATES.items():
        assert got[state] == wanted, state


def test_remaining_labels_are_total(spark):
    rows = list(product(qc_rules.COVERAGES, qc_rules.BATCHES, qc_rules.PAIRINGS, ["ONT", "MGI", "Illumina"], [None, 10.0, 40.0]))
    df = spark.createDataFrame(rows, "a string, b string, c string, s string, v double")
    color = qc_rules.strict_color("a", "b", "c", F.lit(""), "s", "v")
    tier = qc_rules.coverage_tier("b", "c", qc_rules.coverage_class("v", F.lit(90.0)))
    step = qc_rules.progress("s", F.lit("1"), F.lit(None).cast("string"), "v", "v", "b")
    assert df.filter(color.isNull() | tier.isNull() | step.isNull()).count() == 0


@pytest.mark.parametrize(
    "folder, run",
    [
        ("0H0155101C01_5d61bff4_rerun_2024-08-13_013035-DRAGEN_Germline_WGS_4-2-7_sw-mode-JK-31f0", "0H0155101C01_5d61bff4_rerun_2024-08-13_013035"),
        ("0G0021201C01-1-DRAGEN-4-2-6-Germline-All-Callers-DRAGEN_Germline_WGS_4-2-6-v2_sw", "0G0021201C01-1-DRAGEN-4-2-6-Germline-All-Callers"),
        ("0C0194101C05_fe14319c_rerun_2025-02-26_043012-2dd6b9ea-9e2b-4a69-8b54-6a4980054643", "0C0194101C05_fe14319c_rerun_2025-02-26_043012"),
        ("0C0194101C05_fe14319c-x-y", "0C0194101C05_fe14319c"),
    ],
)
def test_run_from_folder(spark, folder, run):
    assert values(spark, [(folder,)], "f string", rules.run_from_folder("f")) == [run]


def test_path_and_run_ids(spark):
    path = f"s3://{Buckets().citus_liquid}/0E0050901C01_9fb9a9ea/0E0050901C01.cram/0E0050901C01.cram"
    got = values(spark, [(path,)], "p string", rules.sample_and_run_from_path("p", Buckets()))
    assert tuple(got[0]) == ("0E0050901C01", "0E0050901C01_9fb9a9ea")
    runs = [("SKI_3175140_9efb681c-DRAGEN",), ("0C0123801C03_250209_M_1a75a295-ede8",), ("0H0066801C01-1-DRAGEN-4-2-6-Germline-All",), ("0C0067101C03_8b688247-D",)]
    assert values(spark, runs, "r string", rules.sample_from_run("r")) == ["SKI_3175140", "0C0123801C03_250209_M", "0H0066801C01", "0C0067101C03"]


def test_sheet_ids(spark):
    rows = [("Test1",), ("BC12",), ("DNB3",), ("0C1-2",), (None,)]
    df = spark.createDataFrame(rows, "i string")
    kept = df.filter(~F.coalesce(F.col("i").rlike(rules.ZLIMS_TRIALS), F.lit(False)))
    assert [r[0] for r in kept.select(rules.zlims_sample_id("i")).collect()] == ["0C1", None]


def test_age(spark):
    rows = [("2020-01-01", "2019-01-01"), ("1990-01-01", "2020-01-01"), (None, "2020-01-01")]
    assert values(spark, rows, "b string, c string", dates.age_years("b", "c")) == [0, 29, None]


def test_dates(spark):
    rows = [("240131",), ("991231",), ("soon",)]
    got = values(spark, rows, "d string", dates.parse_day("d", "yyMMdd").cast("string"))
    assert got == ["2024-01-31", "1999-12-31", None]
    nanos = [("2025-01-02T03:04:05.1234567Z",), ("2025-01-02T03:04:05Z",), ("2025-01-02",), ("bad",)]
    got = values(spark, nanos, "d string", dates.parse_nanos("d").cast("string"))
    assert got == ["2025-01-02 03:04:05.123456", "2025-01-02 03:04:05", "2025-01-02 00:00:00", None]


def test_json_text(spark):
    rows = [('{"a": 1}',), ("{'a': None, 'b': [True]}",), ('say "hi"',), (None,), ("nan",)]
    got = values(spark, rows, "v string", json_text.to_valid_json("v"))
    assert got == ['{"a": 1}', '{"a": null, "b": [true]}', '"say \\"hi\\""', "null", "null"]


def test_clean_ids(spark):
    rows = [("0C01-DRAGEN-4",), ("0C01_250209_M",), ("0C01_250209_T",), ("0C01",), (None,)]
    assert values(spark, rows, "i string", text.clean_sample_id("i")) == ["0C01", "0C01", "0C01", "0C01", None]


def test_form_groups(spark):
    kind = "AAA01/00000000-aaaa-bbbb-cccc-ddddeeeeffff/Formulir-Spesifik-Penyakit-Examination--X|Basic"
    got = values(spark, [(kind,), ("other",)], "k string", form_group("k"), group_table(form_group("k")))
    assert got == [("Formulir-Spesifik-Penyakit-Examination--X_Basic", "phenovar_docs_exam-x_basic"), (None, None)]


def test_decrypt_junk_is_null(spark):
    key, iv = F.lit("0123456789abcdef"), F.lit("fedcba9876543210")
    assert values(spark, [("zz",), ("00" * 16,), (None,)], "c string", decrypt_hex("c", key, iv)) == [None, None, None]
