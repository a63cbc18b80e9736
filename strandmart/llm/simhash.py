"""SimHash near-duplicates by meeting in the middle.

Two fingerprints at three bits or fewer share a point that lies within half the way of each, so each distinct fingerprint emits
the points around it, equal points meet in a shuffle, and the fingerprints that share a point are linked.  Half of three bits is
one and a half: fingerprints with an odd number of set bits emit their neighbours at one bit, those with an even number also those at two.
This suffices, since ends at one or three bits differ in parity and ends at two bits meet at one bit from each.  Two bits are flipped only
within the same half of the fingerprint, since of three differing bits two lie in one half.  So an odd fingerprint
emits 64 points and an even one 1,057, and by geometry at most 1,121 distinct fingerprints share a point, whatever the data.

At a point, all fingerprints but those two bits away are within three bits of everyone there; one of them is the centre and the others
link to it.  That keeps reachability without a row for each pair.  Exact copies share one fingerprint and count once.
"""

from __future__ import annotations

import math
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmart.llm.components import components, local_roots
from strandmart.llm.tables import written

RADIUS = 3
#: Fingerprints whose points are dealt out together, hashes whose bits are counted together, points that a bucket should
#: hold, and least number of buckets.  A fingerprint travels once to each bucket it has points in, so fewer buckets move less.
CHUNK, VOTES, BUCKET_POINTS, LEAST_BUCKETS = 2048, 32_768, 3_000_000, 64

_ONE = [1 << i for i in range(64)]
_TWO = [a | b for half in (_ONE[:32], _ONE[32:]) for a, b in combinations(half, 2)]
#: Flips of even fingerprints: none, one bit, two bits of a half.  Odd ones use the places 1 to 64.
FLIPS = np.array([0, *_ONE, *_TWO], np.uint64)
NEAR = 65


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The 64-bit fingerprint of a text; zero without a word."""
    found = ("" if text is None else text).encode("utf-8", "surrogatepass").lower().split()
    return _bits(_hashes(found, words, seed))


def _hashes(found: list[bytes], words: int, seed: int = 42) -> np.ndarray:
    """Hashes of the shingles of a text's words; of all words where there are fewer."""
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    ends = list(accumulate(len(w) + 1 for w in found))
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    n = max(1, len(found) - words + 1)
    spans = zip(starts[:n], ends[words - 1 :] if len(found) >= words else ends[-1:], strict=True)
    return np.fromiter((digest(joined[s : e - 1], seed) for s, e in spans), np.uint64, n)


def _bits(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes."""
    votes = np.zeros(64, np.int64)
    for k in range(0, len(hashes), VOTES):
        bits = np.unpackbits(hashes[k : k + VOTES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``fp`` (the fingerprint's bits as a long) of every document.

    A null text counts as an empty one; repeated rows give repeated rows; an empty table gives an empty one; other columns are not read.
    """
    slim = docs.select(id_col, text_col)
    kind = slim.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), words, seed) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], [id_col, "fp"])

    return slim.mapInArrow(run, f"`{id_col}` {kind}, fp long")


def _bucket(points: np.ndarray, bits: int) -> np.ndarray:
    """A bucket of ``bits`` bits, each the parity of a fixed choice of the point's bits.

    It is linear: the bucket of a flipped fingerprint is its own bucket flipped by that of the flip.
    """
    out = np.zeros(len(points), np.int64)
    for k, choice in enumerate(np.random.default_rng(17).integers(1, 2**64, bits, dtype=np.uint64)):
        out |= (np.bitwise_count(points & choice) & 1).astype(np.int64) << k
    return out


def _flips_by_bucket(bits: int, odd: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flips in the order of their buckets, and where each bucket's begin and how many they are."""
    flips = np.arange(1, NEAR) if odd else np.arange(len(FLIPS))
    place = _bucket(FLIPS[flips], bits)
    counts = np.bincount(place, minlength=2**bits)
    return flips[np.argsort(place, kind="stable")], np.cumsum(counts) - counts, counts


def _is_odd(fps: np.ndarray) -> np.ndarray:
    return (np.bitwise_count(fps) & 1).astype(bool)


def _dealt(fps: np.ndarray, bits: int):
    """The fingerprints of each bucket in which they have a point; the points follow from the two."""
    owners, places = [], []
    for odd in (False, True):
        mine = fps[_is_odd(fps) == odd]
        reached = np.flatnonzero(_flips_by_bucket(bits, odd)[2])
        owners.append(np.repeat(mine, len(reached)))
        places.append((_bucket(mine, bits)[:, None] ^ reached).ravel())
    owner, place = np.concatenate(owners), np.concatenate(places)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    bounds = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1], [True]))) if len(place) else [0]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        yield int(place[a]), owner[a:b].tobytes()


def _points(fps: np.ndarray, bucket: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint as often as it has points in the bucket, and the flips that give them."""
    owners, flips = [], []
    for odd in (False, True):
        mine = fps[_is_odd(fps) == odd]
        ordered, starts, counts = _flips_by_bucket(bits, odd)
        want = _bucket(mine, bits) ^ bucket
        n = counts[want]
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        owners.append(np.repeat(mine, n))
        flips.append(ordered[np.repeat(starts[want], n) + within])
    return np.concatenate(owners), np.concatenate(flips)


def _meet(fps: np.ndarray, flip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of the fingerprints that share a point."""
    points = fps ^ FLIPS[flip]
    order = np.argsort(points, kind="stable")
    points = points[order]
    same = points[1:] == points[:-1]
    shared = np.concatenate((same, [False])) | np.concatenate(([False], same))
    points, order = points[shared], order[shared]
    if not len(points):
        return fps[:0], fps[:0]
    fps, near = fps[order], flip[order] < NEAR
    first = np.flatnonzero(np.concatenate(([True], points[1:] != points[:-1])))
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(points))))
    # the first of those less than two bits away is the centre; without one the point proves no link
    place = np.where(near, np.arange(len(points)), len(points))
    centre = np.minimum.reduceat(place, first)[group]
    linked = (centre < len(points)) & (centre != np.arange(len(points)))
    a, b = fps[linked], fps[centre[linked]]
    close = np.bitwise_count(a ^ b) <= RADIUS
    return local_roots(a[close], b[close])


def links(distinct: DataFrame, n_fingerprints: int, fp_col: str = "fp") -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct fingerprints at ``RADIUS`` bits or fewer, directly or through others."""
    spark = distinct.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = max(LEAST_BUCKETS, parts, math.ceil(n_fingerprints * (len(FLIPS) + NEAR) / 2 / BUCKET_POINTS))
    bits = (least - 1).bit_length()

    def deal(batches):
        rest = np.zeros(0, np.uint64)
        schema = pa.schema([("bucket", pa.int64()), ("fps", pa.binary())])

        def rows(fps):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*_dealt(fps, bits), strict=True), schema.types, strict=True)], schema=schema)

        for batch in batches:
            rest = np.concatenate((rest, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)))
            while len(rest) >= CHUNK:
                yield rows(rest[:CHUNK])
                rest = rest[CHUNK:]
        if len(rest):
            yield rows(rest)

    def meet(table: pa.Table) -> pa.Table:
        # in order, so that points agree on a centre and most links of a group are the same few
        fps = np.sort(np.frombuffer(b"".join(table.column("fps").to_pylist()), np.uint64))
        a, b = _meet(*_points(fps, table.column("bucket")[0].as_py(), bits))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    points = distinct.select(fp_col).mapInArrow(deal, "bucket long, fps binary")
    return points.groupBy("bucket").applyInArrow(meet, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, words: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, ``fp`` and ``component_id``: the smallest id among all documents reachable by links, itself included.

    Texts without a word share the fingerprint zero and are linked like any others.  Null ids never are the smallest; a
    component of null ids has a null one.  Repeated rows stay repeated.
    """
    one = written(fingerprints(docs, words, seed, id_col, text_col), "fingerprints")
    distinct = written(one.groupBy("fp").agg(F.min(id_col).alias("low_id")), "distinct-fingerprints")
    n = distinct.count()
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / 50_000))
    found = components(links(distinct.select("fp").repartition(tasks, "fp"), n))
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low_id", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low_id").alias("component_id"))
    ids = rooted.select("fp", "root").join(lowest, "root").select("fp", "component_id")
    return one.join(ids, "fp").select(id_col, "fp", "component_id")


def one_of_each(docs: DataFrame, words: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component of ``near_duplicates``: the one with the smallest id; all columns stay.

    Repeated rows are copies of each other and null ids come after all others.  Texts without a word, null ones too, share the fingerprint
    zero and are linked like any others.  An empty table gives an empty one.
    """
    # whole rows lie in one column, so no name of theirs can clash, and a number tells repeated rows apart
    rows = written(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "rows")
    found = written(near_duplicates(rows.select("row", F.col(f"doc.`{text_col}`").alias("text")), words, seed, "row", "text").select("row", "component_id"), "groups")
    ids = rows.select("row", F.col(f"doc.`{id_col}`").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
    firsts = found.join(ids, "row").groupBy("component_id").agg(first).select(F.col("first.row").alias("row"))
    # what goes is the smaller side of the join with the texts
    gone = written(found.join(firsts, "row", "left_anti").select("row"), "gone")
    return rows.join(gone, "row", "left_anti").select("doc.*")
