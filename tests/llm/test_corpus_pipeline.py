"""The pipeline's stages in a row on a small table, against what the planted rows call for."""

import random

import corpus_pipeline
from tests.llm.cases import TEXTS, documents
from tests.llm.test_simhash import copies_of


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(2000)]
    text = lambda: " ".join(f"the {w} of {v} and" for w, v in zip(rng.choices(words, k=60), rng.choices(words, k=60), strict=True))
    base, leak = [text() for _ in range(20)], " ".join(rng.choices(words, k=40))
    rows = [(100 + k, t) for k, t in enumerate(base)]
    rows += [(200, base[0]), (201, copies_of(rng, base[1], 2)), (202, "### " * 50), (203, f"{text()} {leak} {text()}"), (204, f"{text()} token = 'abcdefghijklmnop1234' {text()}")]
    docs = documents(spark, [*rows, *TEXTS[1:4]])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept, seen = {}, spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        seen = stage(spark, seen, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert seen.columns == docs.columns
            path = str(tmp_path / f"stage{k}")
            seen.write.parquet(path)
            seen = spark.read.parquet(path)
        kept[name] = {r.doc_id: r for r in seen.collect()}
    names = list(kept)
    clean = set(range(100, 120))
    assert set(kept[names[0]]) == clean | {200, 201, 203, 204}
    assert set(kept[names[1]]) == clean | {203, 204}
    assert set(kept[names[2]]) == clean | {204} == set(kept[names[3]]) == set(kept[names[4]])
    assert "[assign]" in kept[names[3]][204].text and "abcdefghijklmnop1234" not in kept[names[3]][204].text
    assert kept[names[3]][100].text == base[0] and kept[names[4]][100].n_tokens == len(kept[names[4]][100].ids) > 0
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {k: r.ids_sha256 for k, r in kept[names[4]].items()}


def test_stages_on_an_empty_table(spark, tmp_path):
    documents(spark).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_a_leak_takes_no_other_row_of_its_id_along(spark, tmp_path):
    rng = random.Random(10)
    words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(2000)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    leak = text(40)
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = [(None, text(120)), (None, text(120)), (5, text(120)), (6, None)]
    docs = documents(spark, [*clean, (None, f"{text(60)} {leak} {text(60)}"), (5, f"{text(60)} {leak} {text(60)}")])
    kept = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(str, clean))
