"""Hard negatives, near-duplicate vectors and the filter audit, against brute force and their SQL."""

import math
import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandmart.llm import filter_audit, hard_negatives, pstable
from strandmart.llm.queries import ORACLES, QUERIES
from tests.compare import compare, database
from tests.conftest import DATA
from tests.llm.cases import LONG, TEXTS, documents

NAMES = ("op11_hard_negatives", "op12_embedding_near_duplicates", "op13_filter_audit")
VECTORS = "vec_id long, embedding array<double>, label int, n_links string, score string, `key` string, rank string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, None, None, None, None) for r in rows], VECTORS)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, name):
    rows, problem = compare(spark, database(DATA), DATA, name, QUERIES[name], ORACLES[name])
    assert not problem, problem
    assert rows > 0


def odd_rows():
    nan, inf = float("nan"), float("inf")
    return [(9001, None, 1), (9002, [], 1), (9003, [1.0, None], 1), (9004, [1.0, nan], 1), (9005, [inf, 1.0], 1), (9006, [0.0, -0.0], 1), (9007, [1.0, 2.0], None), (None, [1.0, 2.0, 3.0], 1)]


# ---- near-duplicate vectors


def clusters(rng, dims, groups):
    rows = []
    for size, spread in groups:
        centre = rng.standard_normal(dims)
        rows += [centre + spread * rng.standard_normal(dims) for _ in range(size)]
    return rows


def brute_links(rows, threshold):
    ids = [i for i, _ in rows]
    units = np.array([np.array(v) / np.linalg.norm(v) for _, v in rows])
    linked = units @ units.T >= threshold
    np.fill_diagonal(linked, False)
    low = np.array(ids)
    while True:
        now = np.minimum(low, np.where(linked, low[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (now == low).all():
            return {i: (int(n), int(c)) for i, n, c in zip(ids, linked.sum(axis=1), low, strict=True)}
        low = now


def test_near_duplicate_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pstable, "BLOCK", 40)  # so that the large group is split into pairs of blocks
    rng = np.random.default_rng(4)
    found = clusters(rng, 32, [(150, 0.06), (60, 0.09), *[(3, 0.05)] * 20, *[(1, 0)] * 200])
    found += [found[0] * 3.5, found[0] * 1e200, *[found[1]] * 30]
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(found)), found, strict=True)]
    want = brute_links([(i, [x / max(map(abs, v)) for x in v]) for i, v in rows], 0.95)
    alone = [(9006, [0.0] * 32), (9010, [1.0, 2.0]), *((i, v) for i, v, _ in odd_rows()[:5])]
    frame = vectors(spark, [(i, v, 1) for i, v in [*rows, *alone]])
    got = {r.vec_id: (r.n_links, r.component_id) for r in pstable.near_duplicates(frame, recall=1 - 1e-9).collect()}
    assert got == want | {i: (0, i) for i, _ in alone}
    assert max(n for n, _ in want.values()) > 100


def test_near_duplicate_vectors_at_the_threshold(spark):
    rng = np.random.default_rng(6)
    rows = []
    for k in range(400):
        a, b = np.linalg.qr(rng.standard_normal((64, 2)))[0].T
        rows += [(2 * k, a.tolist(), 1), (2 * k + 1, (0.9501 * a + math.sqrt(1 - 0.9501**2) * b).tolist(), 1)]
    got = pstable.near_duplicates(vectors(spark, rows)).where("n_links > 0").count()
    assert got >= 0.95 * len(rows)


def test_near_duplicate_vectors_of_odd_tables(spark):
    same = [(5, [1.0, -0.0], 1), (5, [1.0, 0.0], 1), (None, [2.0, 0.0], 1), (7, [1.0, 0.001], 1), (None, [0.0, 1.0], 2)]
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in pstable.near_duplicates(vectors(spark, same)).collect()), key=str)
    assert got == sorted([(5, 3, 5), (5, 3, 5), (None, 3, 5), (7, 3, 5), (None, 0, None)], key=str)
    assert pstable.near_duplicates(vectors(spark, same).limit(0)).count() == 0
    floats = vectors(spark, same).withColumn("embedding", F.col("embedding").cast("array<int>"))
    assert pstable.near_duplicates(floats).where("n_links = 3").count() == 4


def test_keys_agree_whatever_the_batch():
    rng = np.random.default_rng(2)
    units = pstable.unit(rng.standard_normal((500, 48)))
    whole = pstable.table_keys(units, 10, 20, 5)
    assert all((pstable.table_keys(units[k : k + 7], 10, 20, 5) == whole[k : k + 7]).all() for k in range(0, 500, 7))
    assert abs(pstable.agreement(math.sqrt(0.1)) - 0.8738) < 1e-3


# ---- hard negatives


def brute_negatives(rows, anchors, scale=256):
    good = [(i, label, [math.floor(scale * x) for x in v]) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, label, q in good:
        if i not in anchors:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), j, other) for j, other, v in good if j != i and len(v) == len(q))
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            inside = [(t, n) for t, n, other in scored if other != label and -30 * s <= -100 * t <= -90 * s][:10]
            out += [(i, p, k, n, -s, -t) for k, (t, n) in enumerate(inside, 1)]
    return sorted(out)


@pytest.mark.parametrize("size", [1.0, 2e6])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", 8 * 16 * 7)  # several blocks of anchors
    monkeypatch.setattr(hard_negatives, "ROWS", 50)  # and of rows within a task
    rng = np.random.default_rng(8)
    n = 500 if size == 1.0 else 120
    rows = [(k, (size * np.round(rng.standard_normal(16) / 4, 2 if k % 3 else 1)).tolist(), int(x)) for k, x in enumerate(rng.choice(4, n, p=[0.1, 0.6, 0.2, 0.1]))]
    rows += [(n + k, rows[10][1], k % 2) for k in range(20)]  # ties
    rows += [(700 + k, [0.0] * 16, 1) for k in range(3)] + odd_rows()
    anchors = {*range(0, n, 25), n, 701, 9007}
    got = hard_negatives.hard_negatives(vectors(spark, rows).repartition(5), F.col("vec_id").isin(list(anchors)))
    assert sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in got.collect()) == brute_negatives(rows, anchors)
    assert hard_negatives.hard_negatives(vectors(spark, rows).limit(0), F.lit(True)).count() == 0


def test_bounds_leave_no_result_out():
    rng = np.random.default_rng(1)
    lines, query = np.floor(256 * rng.standard_normal((40, 3000))), np.floor(256 * rng.standard_normal(40))
    exact, bar = query @ lines, 800_000
    seen = []
    places, scores = hard_negatives.vertical_scan(query, lines, lines.min(axis=1), lines.max(axis=1), lambda low, high: seen.append(len(low)) or high >= bar)
    assert set(places) == set(np.flatnonzero(exact >= bar)) and (scores == exact[places]).all()
    assert seen[-1] < 1000 < seen[0]


def test_repeated_anchors_count_each(spark):
    rows = [(100, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (1, [1.0, 1.0], 1), (2, [0.5, 0.0], 2)]
    got = hard_negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 100 == 0).collect()
    assert [(r.anchor_id, r.positive_id, r.rank, r.negative_id) for r in got] == [(100, 1, 1, 2)] * 2


# ---- filter audit


def brute_audit(docs, labels):
    good, toxic = ({i for i, *x in labels if i is not None and x[k] == 1} for k in (0, 1))
    first, out = {}, {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    parts = {p or "" for _, _, p in docs}
    counts = {(p, "".join(o), s): [0] * 6 for p in parts for o in permutations("ABCDE") for s in range(1, 6)}
    for i, t, p in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t],
        }
        for o in permutations("ABCDE"):
            gone = False
            for s, x in enumerate(o, 1):
                row = counts[p or "", "".join(o), s]
                lost = fails[x] and not gone
                for k, yes in enumerate((not gone and not fails[x], lost, fails[x] and gone, fails[x] and sum(fails.values()) == 1, lost and i in good, lost and i in toxic)):
                    row[k] += yes
                gone |= fails[x]
    shapley = {(p, x): sum(c[1] for (q, o, s), c in counts.items() if q == p and o[s - 1] == x) for p in parts for x in "ABCDE"}
    for (p, o, s), c in counts.items():
        out[p, o, s] = (*c, shapley[p, o[s - 1]])
    return out


def test_filter_audit_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "PARTS", 2)
    rng = random.Random(3)
    words = [f"{'W' if k % 9 == 0 else 'w'}ord{k}" for k in range(300)]
    docs = []
    for k in range(80):
        text = " ".join(rng.choices(words[: rng.choice([20, 300])], k=rng.choice([100, 199, 200, 260]))) + rng.choice(["", " #", " |", "\n"])
        docs += [(k, text, rng.choice(["en", "de", None, "fr"]))] + [(100 + k, text, "en")] * (k % 4 == 0) + [(k, text, "fr")] * (k % 9 == 0)
    docs += [(i, t, "odd") for i, t in TEXTS] + [(-5, LONG, "en"), (None, LONG, None), (400, "\U0001f600" * 30 + "ABC", "de"), (401, "A" * 3 + "b" * 97, "de"), (402, "A" * 4 + "b" * 96, "de")]
    labels = [(k, k % 2, k % 3 % 2) for k in range(60)] + [(3, None, 1), (3, 1, None), (None, 1, 1), (999, 1, 1)]
    frame = documents(spark, [(i, t) for i, t, _ in docs]).withColumn("good", F.lit("x")).withColumn("lang", F.lit(None).cast("string")).limit(0)
    frame = frame.unionByName(spark.createDataFrame(docs, "doc_id long, text string, lang string"), allowMissingColumns=True).repartition(7)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.filter_audit(frame, marks).collect()
    names = [*filter_audit.OUTCOMES, "shapley"]
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in names) for r in got} == brute_audit(docs, labels)
    assert all(r["filter"] == r.filter_order[r.step - 1] for r in got)
    assert filter_audit.filter_audit(frame.limit(0), marks).count() == 0
    assert filter_audit.filter_audit(frame, marks.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_fields_do_not_run_into_each_other():
    big = 2**62
    total = filter_audit.packed(0b1100011) * big + filter_audit.packed(0b0000001) * (big - 1)
    counts = filter_audit.unpacked(total.to_bytes(600 * 6 * 8, "little"))
    first = counts[filter_audit.orders().index("ABCDE")]
    assert first[0].tolist() == [0, 2 * big - 1, 0, big - 1, big, big] and first[1].tolist() == [0, 0, big, 0, 0, 0]
