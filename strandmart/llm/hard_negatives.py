"""Hard negatives by a vertical scan of bounds over the dimensions of vectors (BOND).

Rows lie in blocks by column: one line for each dimension.  For an anchor the lines are read in the order of its component's size.
After a few lines each candidate has a partial score, and the least and greatest values of the lines not yet read bound what is still to come; a
candidate whose bounds show that it can't be among the results leaves the bitmap.  Those that stay to the end have exact integer scores.

Two scans share this: the first finds each anchor's best rows of its label (bound: its best k so far), the second the best rows of other labels
within a window of each of these (bounds: the windows, and the best k so far in each).  Anchors are read in blocks of bounded
size, broadcast one by one; every row meets every block.  A task carries each anchor's best through all its blocks of rows and sends them once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmart.llm.tables import written

#: Bytes of a block of anchors, rows of a block, and lines read between two looks at the bounds.
ANCHOR_BYTES, ROWS, LINES = 8_000_000, 16_384, 8


def quantised(vectors: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of every component: doubles while scores stay below 2**53, Python integers beyond that."""
    whole = np.floor(scale * vectors.astype(np.float64))
    if whole.size and np.abs(whole).max() ** 2 * whole.shape[1] >= 2.0**52:
        return np.array([[int(x) for x in row] for row in whole.tolist()], object)
    return whole


def vertical_scan(query: np.ndarray, lines: np.ndarray, least: np.ndarray, most: np.ndarray, useful) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the columns of ``lines`` that ``useful`` (by lower and upper bounds) keeps to the end."""
    order = np.argsort(-np.abs(query), kind="stable")
    ends = np.stack((query * least, query * most))[:, order]
    rest = [np.concatenate((np.cumsum(x[::-1])[::-1], [0])) for x in (ends.min(axis=0), ends.max(axis=0))]
    alive, score = None, np.zeros(lines.shape[1], lines.dtype)
    for k in range(0, len(order), LINES):
        for d in order[k : k + LINES]:
            score = score + query[d] * (lines[d] if alive is None else lines[d, alive])
        done = min(k + LINES, len(order))
        keep = useful(score + rest[0][done], score + rest[1][done])
        if not keep.all():
            alive = np.flatnonzero(keep) if alive is None else alive[keep]
            score = score[keep]
        if not len(score):
            break
    return np.arange(lines.shape[1]) if alive is None else alive, score


def _kth(values: np.ndarray, k: int):
    """The k-th largest value."""
    return np.partition(values, len(values) - k)[len(values) - k]


def _best(scores: np.ndarray, ids: np.ndarray, old, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of old and new: higher scores first, ties by smaller ids."""
    if old is not None:
        scores, ids = np.concatenate((old[0], scores)), np.concatenate((old[1], ids))
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


class _Block:
    """Rows by column, sorted by label."""

    def __init__(self, ids, labels, vectors):
        order = np.argsort(labels, kind="stable")
        self.ids, self.labels, self.lines = ids[order], labels[order], np.ascontiguousarray(vectors[order].T)
        self.least, self.most = self.lines.min(axis=1), self.lines.max(axis=1)
        self._left_out, self._others = None, None

    def of(self, label) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, "right"))

    def without(self, label) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lines of the other labels; anchors come by label, so the last one asked for is kept."""
        if self._left_out != label:
            a, b = self.of(label)
            self._left_out, self._others = label, (np.r_[self.ids[:a], self.ids[b:]], np.concatenate((self.lines[:, :a], self.lines[:, b:]), axis=1))
        return self._others


def _nearest(block: _Block, anchor, best, k: int):
    """An anchor's best rows of its label."""
    _, own, label, query, _ = anchor
    a, b = block.of(label)
    others = np.flatnonzero(block.ids[a:b] != own)
    if not len(others):
        return best
    lines = block.lines[:, a:b] if len(others) == b - a else block.lines[:, a:b][:, others]
    enough = best[0][-1] if best is not None and len(best[0]) == k else None

    def useful(low, high):
        bound = enough
        if len(low) >= k:
            bound = _kth(low, k) if bound is None else max(bound, _kth(low, k))
        return np.ones(len(low), bool) if bound is None else high >= bound

    places, scores = vertical_scan(query, lines, block.least, block.most, useful)
    return _best(scores, block.ids[a:b][others[places]], best, k)


def _windowed(block: _Block, anchor, best, k: int, shares: tuple[int, int]):
    """For each score of an anchor's positives, its best rows of other labels within the window."""
    _, _, label, query, targets = anchor
    # 100 s against shares of the target, in whole numbers
    windows = [(-(-shares[0] * t // 100), shares[1] * t // 100) for t in targets]
    best = [None] * len(windows) if best is None else best
    ids, lines = block.without(label)
    if not len(ids):
        return best

    def useful(low, high):
        keep = np.zeros(len(low), bool)
        for (bottom, top), old in zip(windows, best, strict=True):
            bound = old[0][-1] if old is not None and len(old[0]) == k else bottom
            sure = low[(low >= bottom) & (high <= top)]
            if len(sure) >= k:
                bound = max(bound, _kth(sure, k))
            keep |= (high >= bound) & (low <= top)
        return keep

    places, scores = vertical_scan(query, lines, block.least, block.most, useful)
    made = []
    for (bottom, top), old in zip(windows, best, strict=True):
        inside = (scores >= bottom) & (scores <= top)
        made.append(_best(scores[inside], ids[places[inside]], old, k))
    return made


def _blocks(batches, scale: int):
    """Blocks of rows of one length."""
    waiting = {}
    for batch in batches:
        column = batch.column(2)
        flat, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        lengths = np.diff(offsets)
        ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for d in np.unique(lengths):
            at = np.flatnonzero(lengths == d)
            rows = waiting.setdefault(int(d), [])
            rows.append((ids[at], labels[at], quantised(flat[offsets[at][:, None] + np.arange(d)], scale)))
            if sum(len(x[0]) for x in rows) >= ROWS:
                yield int(d), _Block(*(np.concatenate(x) for x in zip(*waiting.pop(int(d)), strict=True)))
    for d, rows in waiting.items():
        yield d, _Block(*(np.concatenate(x) for x in zip(*rows, strict=True)))


def _saturated(scores) -> list[int]:
    return [max(-(2**63), min(2**63 - 1, int(s))) for s in scores]


def _scan(rows: DataFrame, anchors: list, scale: int, k: int, shares) -> DataFrame:
    """``number``, ``target``, ``score`` and ``id`` of each task's best; ``target`` is the positive score, null in the first scan."""
    sent = rows.sparkSession.sparkContext.broadcast(anchors)
    schema = pa.schema([("number", pa.int64()), ("target", pa.int64()), ("score", pa.int64()), ("id", pa.int64())])

    def run(batches):
        best = {}
        for d, block in _blocks(batches, scale):
            for anchor in sent.value:
                if len(anchor[3]) == d:
                    old = best.get(anchor[0])
                    best[anchor[0]] = _nearest(block, anchor, old, k) if shares is None else _windowed(block, anchor, old, k, shares)
        for anchor in sent.value:
            found = best.get(anchor[0])
            if found is None:
                continue
            for target, one in [(None, found)] if shares is None else zip(anchor[4], found, strict=True):
                if one is not None and len(one[0]):
                    n = len(one[0])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([anchor[0]] * n, pa.int64()), pa.array([target] * n, pa.int64()), pa.array(_saturated(one[0]), pa.int64()), pa.array(one[1], pa.int64())], schema=schema
                    )

    return rows.mapInArrow(run, "number long, target long, score long, id long")


def _top(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, shares: tuple[int, int] = (30, 90), scale: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    Scores are inner products of ``floor(scale * x)``, higher ones first, ties by smaller id.  Each row that meets ``anchor`` has as positives its
    best rows of the same label, and for each of them the best rows of other labels whose score is between ``shares`` per cent of the positive's.
    Rows with a null id, label or vector, or with a null or non-finite component, take no part; vectors meet those of their own length only.
    Repeated rows count each; an anchor never meets a row of its own id; an anchor without positives, or a positive without
    negatives, has no row.  Scores beyond 64 bits saturate before windows are taken.  Other columns are not read.  An empty table gives an empty one.
    """
    vector = F.col(f"`{vector_col}`")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    ids, labels = F.col(f"`{id_col}`"), F.col(f"`{label_col}`")
    good = rows.where(ids.isNotNull() & labels.isNotNull() & vector.isNotNull() & ~bad)
    slim = good.select(ids.cast("long").alias("id"), labels.cast("long").alias("label"), vector.cast("array<double>").alias("vec"))
    asked = good.where(anchor).select(
        F.monotonically_increasing_id().alias("number"), ids.cast("long").alias("anchor_id"), labels.cast("long").alias("label"), vector.cast("array<double>").alias("vec")
    )
    asked = written(asked, "anchors")
    size = asked.agg(F.sum(F.size("vec"))).first()[0] or 0
    blocks = max(1, math.ceil(8 * size / ANCHOR_BYTES))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("number"), F.lit(blocks)))
    parts = []
    for k in range(blocks):
        mine = asked.where(F.col("block") == k)
        block = [
            (r.number, r.anchor_id, r.label, quantised(np.array([r.vec], np.float64), scale)[0], ()) for r in mine.select("number", "anchor_id", "label", "vec").toLocalIterator()
        ]  # ANCHOR_BYTES of vectors
        block.sort(key=lambda a: a[2])
        near = written(_top(_scan(slim, block, scale, positives, None), ["number"], positives), "positives")
        targets: dict[int, set] = {}
        for r in near.select("number", "score").distinct().toLocalIterator():  # ``positives`` rows for each anchor of the block
            targets.setdefault(r.number, set()).add(r.score)
        block = [(*a[:4], tuple(sorted(targets[a[0]]))) for a in block if a[0] in targets]
        far = _top(_scan(slim, block, scale, negatives, shares), ["number", "target"], negatives)
        pairs = near.select("number", F.col("id").alias("positive_id"), F.col("score").alias("target"))
        named = mine.select("number", "anchor_id")
        parts.append(written(far.join(pairs, ["number", "target"]).join(named, "number"), "negatives"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    return found.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        F.col("target").alias("positive_score"), F.col("score").alias("negative_score"),
    )
