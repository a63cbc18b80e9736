"""SimHash fingerprints, links by shared points, components and the removal of near copies, against brute force."""

import random
import re

import numpy as np
import xxhash

from strandmart.llm import simhash
from strandmart.llm.components import components
from tests.llm.cases import TEXTS, documents


def brute_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + n]) for k in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, near):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if a < b and near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_fingerprints(spark):
    for _, text in TEXTS:
        if text is None or len(text) < 1000:
            assert simhash.fingerprint(text) == brute_fingerprint(text)
    assert simhash.fingerprint(None) == 0 and simhash.fingerprint("one two") == brute_fingerprint("one two")


def test_links_reach_what_brute_force_reaches(spark):
    rng = random.Random(3)
    values = {0, 2**64 - 1}
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 5)):
            v = base
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                v ^= 1 << bit
            values.add(v)
    values = sorted(values)
    frame = spark.createDataFrame([(np.uint64(v).astype(np.int64).item(),) for v in values], "fp long")
    want = brute_components(values, lambda a, b: (a ^ b).bit_count() <= 3)
    found = components(simhash.links(frame.repartition(3), len(values))).collect()
    root = {v: v for v in values} | {r.node % 2**64: r.root % 2**64 for r in found}
    groups = lambda roots: sorted(sorted(v for v in values if roots[v] == r) for r in set(roots.values()))
    assert groups(root) == groups(want)


def test_components_of_paths_stars_and_nulls(spark):
    pairs = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(5, 5), (None, 3), (200, 201), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(2, 41)} | {k: 100 for k in range(101, 130)} | {201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates(spark):
    got = simhash.near_duplicates(documents(spark)).collect()
    assert len(got) == len(TEXTS)
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id in (1, 7)} == {(1, 1), (7, 1)}
    assert {(r.doc_id, r.component_id, r.fp) for r in got if r.doc_id in (2, 3, 4)} == {(k, 2, 0) for k in (2, 3, 4)}
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert simhash.near_duplicates(documents(spark).limit(0)).count() == 0


def near(a, b):
    return (a ^ b).bit_count() <= 3


def copies_of(rng, text, bits):
    """A text with one word changed whose fingerprint is that many bits away, and not more."""
    words = text.split()
    for k in rng.sample(range(len(words)), len(words)):
        made = " ".join([*words[:k], "changed", *words[k + 1 :]])
        if (brute_fingerprint(made) ^ brute_fingerprint(text)).bit_count() == bits:
            return made
    return None


def test_one_of_each_equals_brute_force(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(4000)]
    texts = [" ".join(rng.choices(words, k=150)) for _ in range(24)]
    rows = [(k * 10, t) for k, t in enumerate(texts)]
    for k, text in enumerate(texts[:12]):
        rows += [(k * 10 + j, made) for j, bits in enumerate((0, 1, 2, 3, 4, 5), 1) if (made := copies_of(rng, text, bits))]
    rows += [(5000, " " + texts[0].upper() + "\n"), (None, texts[0]), (0, texts[0]), (900, None), (901, ""), (-3, texts[20])]
    points = {t: brute_fingerprint(t) for _, t in rows}
    root = brute_components(sorted(set(points.values())), near)
    want = sorted({min((i for i, t in rows if i is not None and root[points[t]] == r)) for r in set(root.values())})
    docs = documents(spark, rows)
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == want and len(want) < len(rows)
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_one_of_each_keeps_one_row_of_a_group_without_ids(spark):
    rows = [(None, "one two three four five"), (None, "one two three four five"), (None, "other words of another text")]
    assert sorted(r.text for r in simhash.one_of_each(documents(spark, rows)).collect()) == sorted({t for _, t in rows})
