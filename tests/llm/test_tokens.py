"""Byte-pair encoding, token files and their round trips, against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strandmart.llm import bpe, token_files
from tests.llm.cases import TEXTS, documents

WORD_PATH, BYTE_PATH = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
WORD, BYTE = bpe.WordBpe(WORD_PATH), token_files.Pieces(BYTE_PATH)
LIBRARY = {p: Tokenizer.from_file(p) for p in (WORD_PATH, BYTE_PATH)}
any_text = st.text(max_size=60) | st.text("ab Σß\u0301'sdt<|endoftext|>\n", max_size=60)


@settings(max_examples=200, deadline=None)
@given(any_text)
def test_word_bpe_is_the_librarys(text):
    ids = LIBRARY[WORD_PATH].encode(text, add_special_tokens=False).ids
    mine = WORD.encode_many([text])[0]
    assert list(mine) == ids
    assert WORD.decode(mine) == LIBRARY[WORD_PATH].decode(ids, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(any_text)
def test_byte_pieces_are_the_librarys(text):
    ids = LIBRARY[BYTE_PATH].encode(text, add_special_tokens=False).ids
    assert np.frombuffer(BYTE.encode_many([text])[0], "<u2").tolist() == ids


def test_every_assigned_letter_and_long_runs():
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}" for c in range(0x3000) if not 0xD800 <= c < 0xE000] + ["a" * 3000, "ab" * 2000]
    found = LIBRARY[WORD_PATH].encode_batch(texts, add_special_tokens=False)
    assert [list(x) for x in WORD.encode_many(texts)] == [e.ids for e in found]


def test_leftmost_merges_where_merges_are_out_of_order():
    slow = bpe.WordBpe(WORD_PATH)
    slow.at_once = False
    words = [w.encode() for w in ("aaaaaaa", "banana", "mississippi", "x")]
    assert [a.tolist() for a in slow.merge(words)] == [a.tolist() for a in WORD.merge(words)]


def test_a_full_table_of_words_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 3)
    small = bpe.WordBpe(WORD_PATH)
    texts = ["one two three", "four five six seven", "one four"]
    assert [list(small.encode_many([t])[0]) for t in texts] == [list(x) for x in WORD.encode_many(texts)]


def test_digests_and_round_trip(spark):
    docs = documents(spark)
    got = bpe.round_trip_digests(docs, WORD_PATH).collect()
    want = []
    for i, text in TEXTS:
        ids = LIBRARY[WORD_PATH].encode(text or "", add_special_tokens=False).ids
        back = LIBRARY[WORD_PATH].decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    twice = bpe.decoded(bpe.encoded(docs, WORD_PATH), WORD_PATH).collect()
    assert {(r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in twice} == {(w[0], w[3]) for w in want}
    assert bpe.round_trip_digests(docs.limit(0), WORD_PATH).count() == 0


def test_token_files_read_back(spark, tmp_path):
    folder = str(tmp_path / "tokens")
    manifest = token_files.write_tokens(documents(spark), BYTE_PATH, folder, shards=3)
    got = token_files.read_tokens(manifest, folder, token_files.crc32).collect()
    start, want = 0, []
    for i, text in sorted(TEXTS, key=lambda r: -1 if r[0] is None else r[0]):
        ids = np.array([*LIBRARY[BYTE_PATH].encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    whole = token_files.read_tokens(manifest, folder).orderBy("start").first()
    assert len(whole["value"]) == want[0][2] and whole["value"][-1] == 0
    empty = token_files.write_tokens(documents(spark).limit(0), BYTE_PATH, str(tmp_path / "none"))
    assert token_files.read_tokens(empty, str(tmp_path / "none")).count() == 0


def test_starts_do_not_depend_on_the_partitioning(spark, tmp_path):
    rng = random.Random(6)
    rows = [(rng.choice([1, 2, None]), rng.choice(["a b", "c d e", "same text", None, "x" * rng.randint(1, 9)])) for _ in range(400)] + [(2, "hot text")] * 300
    seen = []
    for k, parts in enumerate((1, 3, 7)):
        docs = spark.createDataFrame(rng.sample(rows, len(rows)), "doc_id long, text string").repartition(parts)
        folder = str(tmp_path / f"t{k}")
        manifest = token_files.write_tokens(docs, BYTE_PATH, folder, shards=parts + 4)
        assert manifest.agg({"n_docs": "max"}).first()[0] < 400  # the hot text is in several shards
        seen.append(sorted(map(str, (tuple(r) for r in token_files.read_tokens(manifest, folder, token_files.crc32).collect()))))
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 700


def test_pieces_equal_the_library(monkeypatch):
    monkeypatch.setattr(token_files, "KNOWN_PIECES", 300)
    monkeypatch.setattr(token_files, "JOINED_WORDS", 7)
    rng = random.Random(8)
    bits = [" word", " Straße", "don't", " I'll", "12", " 345", "\n\n", "  ", " ", "ﬁne", " ½", "。", " Ελλάδα", " ǅ", "́", " áb", "<|endoftext|>", "#!", " " * 5, "\t"]
    model = token_files.Pieces(BYTE_PATH)
    for _ in range(60):
        texts = ["".join(rng.choice(bits) + rng.choice(["", " " + "".join(rng.choices("abcdé", k=4))]) for _ in range(rng.randint(0, 60))) for _ in range(4)]
        want = [LIBRARY[BYTE_PATH].encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(x, f"<u{model.width}").tolist() for x in model.encode_many(texts)] == want
