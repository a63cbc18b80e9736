"""Python-literal text and raw files as they come: quotes, constants, depth, header orders."""

import json
import time

import pytest
from pyspark.sql import functions as F

from strandmart.functions.json_text import repair_quotes, text_list, to_valid_json
from strandmart.operators.joins import pairs_with_default, prefix_join
from strandmart.plans.silver import UNREAD, flatten_documents, nesting
from strandmart.sources import bronze

VALUES = [
    {"a": "O'Brien", "b": "y"}, {"a": 'he said "no"', "b": "y"}, {"a": 'both \' and "', "n": None, "t": True, "f": [1, 2.5, "None, True"]},
    {"back": "c:\\x\\", "line": "x\ny", "umlaut": "ä\x81", "free": "is True , or None "}, {}, {"k": {"l": {"m": [{"n": "'"}]}}},
]


def test_literals_keep_what_strings_hold(spark):
    df = spark.createDataFrame([(k, repr(v)) for k, v in enumerate(VALUES)], "k int, t string")
    got = {r.k: json.loads(r.j) for r in df.select("k", repair_quotes("t").alias("j")).collect()}
    assert got == dict(enumerate(VALUES))


def test_valid_json_and_lists(spark):
    texts = [repr({"a": "O'B"}), "is True , or None ", None, "nan", '{"a": "it\'s"}']
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = [json.loads(r.j) for r in df.orderBy("k").select(to_valid_json("t").alias("j")).collect()]
    assert got == [{"a": "O'B"}, "is True , or None", None, None, {"a": "it's"}]
    lists = spark.createDataFrame([(repr(["O'B", "z"]),), ('["a\'b"]',)], "t string")
    assert [r.x for r in lists.select(text_list("t").alias("x")).collect()] == [["O'B", "z"], ["a'b"]]


def test_documents_of_any_depth_and_unread_ones(spark):
    deep = {"k0": "leaf O'B"}
    for k in range(1, 9):
        deep = {f"k{k}": deep}
    kind = "AAA1/12345678-1234-1234-1234-123456789abc/form-x|examination"
    rows = [(kind, k, "b", "1", "2025-01-01", t) for k, t in (("p1", repr(deep)), ("p2", "{'a': broken"), ("p3", "{'a': 'x', 'b': \"it's\"}"))]
    docs = spark.createDataFrame(rows, "document_type string, participant_id string, institution_name string, version string, created_at string, question_answer string")
    names = spark.createDataFrame([], "id string, name string")
    got = {(r.id_subject, r.path): r.value for r in flatten_documents(docs, names).collect()}
    assert got.pop(("p2", UNREAD)).startswith("{")
    assert got == {("p1", ".".join(f"k{k}" for k in range(8, -1, -1))): "leaf O'B", ("p3", "a"): "x", ("p3", "b"): "it's"}


def test_nesting_counts_braces_outside_strings(spark):
    texts = {"{}": 1, '{"a": {}}': 2, '{"a": "{{{", "b": "\\"{"}': 1, '{"a": {"b": {"c": 1}}, "d": {"e": 2}}': 3, "[]": 0, "": 0, "x": 0, '{"a": "line\\n{", "{": {"b": 1}}': 2}
    df = spark.createDataFrame([(t, n) for t, n in texts.items()], "t string, n int")
    assert [(r.t, r.n, r.got) for r in df.select("*", nesting("t").alias("got")).collect() if r.n != r.got] == []
    assert df.limit(1).select(nesting(F.lit(None).cast("string")).alias("x")).first().x == 0


def _seconds(spark, text):
    kind = "AAA1/12345678-1234-1234-1234-123456789abc/form-x|examination"
    docs = spark.createDataFrame([(kind, "p", "b", "1", "2025-01-01", text)], "document_type string, participant_id string, institution_name string, version string, created_at string, question_answer string")
    names = spark.createDataFrame([], "id string, name string")
    start = time.perf_counter()
    rows = flatten_documents(docs, names).collect()
    return time.perf_counter() - start, {(r.path, r.value) for r in rows}


def test_time_to_flatten_follows_the_length(spark):
    def objects(n):
        return json.dumps({f"k{k}": {"a": str(k)} for k in range(n)}), {(f"k{k}.a", str(k)) for k in range(n)}

    def braces(n):
        return json.dumps({f"k{k}": "{" for k in range(n)}), {(f"k{k}", "{") for k in range(n)}

    for made in (objects, braces):
        _seconds(spark, made(100)[0])
        (text, want), (long, more) = made(2000), made(8000)
        (short_s, got), (long_s, got_more) = _seconds(spark, text), _seconds(spark, long)
        assert got == want and got_more == more
        assert long_s < 6 * short_s + 1, (short_s, long_s)  # four times the text; sixteen times the time before


def test_two_answers_may_have_one_path(spark):
    assert _seconds(spark, '{"a.b": {"c": "1"}, "a": {"b.c": "2"}}')[1] == {("a.b.c", "1"), ("a.b.c", "2")}


def test_files_by_column_name(spark, tmp_path):
    for name, text in (("a-2025-01-01", "id,note\n1,x\n"), ("b-2025-01-01", "note,id,more\ny,2,z\n"), ("c-2025-01-01", ""), ("d-2025-01-02", "id,note\n3,w\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    rows = bronze.read_bronze_multi(spark, str(tmp_path), "2025-01-01", ["id", "note"])
    assert sorted((r.id, r.note) for r in rows.select("id", "note").collect()) == [("1", "x"), ("2", "y")]
    assert bronze.with_row_order(rows).count() == 2
    assert bronze.read_bronze(spark, str(tmp_path), "2030-01-01", ["id"]).count() == 0
    every = bronze.read_bronze_all(spark, str(tmp_path))
    assert sorted((r.id, r.note, r.more) for r in every.collect()) == [("1", "x", None), ("2", "y", "z"), ("3", "w", None)]


@pytest.mark.parametrize("n", [3, 70])
def test_pairs_beyond_a_machine_word(spark, n):
    subjects = spark.createDataFrame([("s",)], "s string")
    facts = spark.createDataFrame([("s", n - 1, "v")], "o string, pair int, v string")
    got = pairs_with_default(subjects, facts, "s", "o", n, ["v"]).collect()
    assert sorted((r.pair, r.v) for r in got) == [(k, "v" if k == n - 1 else None) for k in range(n)]


def test_prefixes_of_the_lengths_of_ids(spark):
    ids = spark.createDataFrame([("ab",), ("abc",), ("x",), ("",)], "id string")
    names = spark.createDataFrame([("abcd",), ("a",), ("xy",), (None,)], "name string")
    got = prefix_join(ids, names, "id", "name")
    assert sorted((r.id, r.name) for r in got.collect()) == [("ab", "abcd"), ("abc", "abcd"), ("x", "xy")]
    assert got.select(F.col("id")).columns == ["id"]
