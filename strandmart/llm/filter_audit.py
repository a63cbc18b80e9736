"""How filters interact: what each removes at each step of each order, from one pass over the texts.

Every document becomes a mask of the filters that it fails, and every mask a big integer whose fields hold the outcome of each step of each
order.  Fields are 64 bits wide, more than any count of rows needs, so integers are simply added, part by part, without a carry from
one field into the next; a part's sum is unpacked at the end.

An integer of 120 orders, 5 steps and 6 outcomes has 28,800 bytes, and a task sends one for each part that it meets.  Sums are added in two
levels, first by part and a salt, so no task gathers those of all tasks of a part.
"""

from __future__ import annotations

from collections import defaultdict
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmart.llm.tables import written

FILTERS = "ABCDE"
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: Bytes of a field, salts of the first level of sums, and parts whose sums a task holds before it sends them on.
FIELD, SALTS, PARTS = 8, 64, 200
_BLANKS = "\t\n\x0b\f\r"


@cache
def orders(filters: str = FILTERS) -> tuple[str, ...]:
    return tuple("".join(p) for p in permutations(filters))


def outcomes(mask: int, good: bool, toxic: bool, order: str, filters: str = FILTERS):
    """The outcomes of a document at every step of an order."""
    removed_before = False
    for letter in order:
        bit = 1 << filters.index(letter)
        fails = bool(mask & bit)
        removed = fails and not removed_before
        yield (
            not fails and not removed_before, removed, fails and removed_before, mask == bit, removed and good, removed and toxic
        )
        removed_before |= fails


@cache
def packed(code: int, filters: str = FILTERS) -> int:
    """All step outcomes of a mask, one field each; above the mask ``code`` has a bit for good and one for toxic documents."""
    n = len(filters)
    mask, good, toxic = code & (1 << n) - 1, bool(code >> n & 1), bool(code >> n + 1 & 1)
    fields = [x for order in orders(filters) for step in outcomes(mask, good, toxic, order, filters) for x in step]
    return int.from_bytes(np.array(fields, "<u8").tobytes(), "little")


def unpacked(total: bytes, filters: str = FILTERS) -> np.ndarray:
    """Counts by order, step and outcome."""
    return np.frombuffer(total, "<u8").reshape(len(orders(filters)), len(filters), len(OUTCOMES)).astype(np.int64)


def _size(filters: str) -> int:
    return len(orders(filters)) * len(filters) * len(OUTCOMES) * FIELD


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``id``, ``part``, a digest of the text as ``key``, and ``mask``: the failures of A to D."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    words = slim.withColumn("words", F.array_remove(F.split(F.translate("text", _BLANKS, " " * len(_BLANKS)), " "), ""))
    n_words, distinct = F.size("words").cast("long"), F.size(F.array_distinct("words")).cast("long")
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long")
    fails = (n_words < 200, 100 * distinct < 50 * n_words, 100 * capitals > 3 * F.length("text").cast("long"), F.col("text").rlike("[#$%&*|]"))
    return words.select("id", "part", F.unhex(F.sha2("text", 256)).alias("key"), _bits(fails).alias("mask"))


def _bits(flags) -> Column:
    return sum((F.when(flag, 1 << k).otherwise(0) for k, flag in enumerate(flags)), F.lit(0)).cast("int")


def codes(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part`` and ``code`` (mask of failures, and bits for good and toxic) of every document.

    E, identical to the text of any smaller id, is found without a group of all copies: the least id of each text is a map-side combined
    minimum, and a document is the first of its text if the pair of its text and id is among them.
    """
    rows = written(measured(docs, id_col, text_col, part_col), "masks")
    named = rows.where(F.col("id").isNotNull())
    firsts = named.groupBy("key").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    said = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    e, above = FILTERS.index("E"), len(FILTERS)
    known = named.join(firsts, ["key", "id"], "left").join(said, "id", "left").select(
        "part",
        (
            F.col("mask") + F.when(F.col("first").isNull(), 1 << e).otherwise(0)
            + F.when(F.col("good"), 1 << above).otherwise(0) + F.when(F.col("toxic"), 2 << above).otherwise(0)
        ).cast("int").alias("code"),
    )
    return known.unionAll(rows.where(F.col("id").isNull()).select("part", F.col("mask").alias("code")))


def audit(coded: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per ``part``, order and step with the outcomes, summed over ``part`` and ``code``."""
    size = _size(filters)

    def sums(totals):
        parts = list(totals)
        return pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.string()), pa.array([totals[p].to_bytes(size, "little") for p in parts], pa.binary())], ["part", "total"]
        )

    def add(batches):
        totals = defaultdict(int)
        for batch in batches:
            parts = batch.column(0).dictionary_encode()
            names, each = parts.dictionary.to_pylist(), parts.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            span = 4 << len(filters)
            for x, n in zip(*np.unique(each * span + batch.column(1).to_numpy(zero_copy_only=False), return_counts=True), strict=True):
                totals[names[x // span]] += packed(int(x % span), filters) * int(n)
                if len(totals) > PARTS:
                    yield sums(totals)
                    totals.clear()
        if totals:
            yield sums(totals)

    def merge(table: pa.Table) -> pa.Table:
        total = sum(int.from_bytes(x.as_py(), "little") for x in table.column("total"))
        return pa.table({"part": table.column("part")[:1], "total": pa.array([total.to_bytes(size, "little")], pa.binary())})

    def unpack(table: pa.Table) -> pa.Table:
        counts = unpacked(merge(table).column("total")[0].as_py(), filters)
        names, n = orders(filters), len(filters)
        letters = np.array([list(order) for order in names])
        removed = counts[:, :, OUTCOMES.index("removed")]
        share = {letter: int(removed[letters == letter].sum()) for letter in filters}
        flat = letters.ravel().tolist()
        made = {
            "part": pa.array(table.column("part")[:1].to_pylist() * len(flat), pa.string()), "filter_order": np.repeat(names, n),
            "step": pa.array(np.tile(np.arange(1, n + 1), len(names)), pa.int32()),
            **{name: counts[:, :, k].ravel() for k, name in enumerate(OUTCOMES)}, "shapley": pa.array([share[x] for x in flat], pa.int64()), "filter": flat,
        }
        return pa.table(made)

    parts = coded.select("part", "code").mapInArrow(add, "part string, total binary").withColumn("salt", F.spark_partition_id() % SALTS)
    level = parts.groupBy("part", "salt").applyInArrow(merge, "part string, total binary")
    counts = ", ".join(f"{name} long" for name in OUTCOMES)
    return level.groupBy("part").applyInArrow(unpack, f"part string, filter_order string, step int, {counts}, shapley long, filter string")


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """The audit of five filters over whole texts, by part.

    A: under 200 words; B: fewer distinct words than half; C: over 3 % capitals A-Z; D: any of ``#$%&*|``; E: the text of any smaller id.
    Null texts count as empty ones (A fails), null parts as the empty string.  Repeated rows of an id count each, and none of them is a
    smaller id than another; null ids have no smaller id and no label.  Of an id's repeated labels one says yes if any does.
    Other columns are not read.  An empty table has no part, so no row.
    """
    return audit(codes(docs, labels, id_col, text_col, part_col))
