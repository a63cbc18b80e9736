"""Benchmark decontamination by latent semantic retrieval.

1. Documents become arrays of term codes over the benchmark's words, one pass over the texts; later passes read the codes only.
2. Document frequencies of the terms over all windows of all documents give the TF-IDF weights.
3. A randomised SVD of the TF-IDF windows, distributed: each task multiplies its windows into a small random (then
   orthonormal) basis, the products are added by blocks of terms, and only matrices of terms by rank reach the driver.
4. Every window of every document and every window of every benchmark item are projected; pairs at or above a cosine are candidates.
5. The longest common subsequence of words and the words of the answer decide; it is computed where the words that a candidate
   region shares with the item, in any order, are enough for it.

The benchmark is the query set: it is read in blocks of about ``BLOCK_ITEMS`` distinct texts and ``BLOCK_WINDOWS`` windows, so what each task gets has a
bound whatever the items' lengths; equal texts are searched once and their ids joined back.  All documents are searched whole, and no number of
candidates is limited.

Defined results: null texts count as empty ones and match nothing; an item without a word matches nothing; repeated rows give
repeated results; empty tables give an empty result; only ids and texts are read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmart.llm.bpe import is_latin
from strandmart.llm.tables import written

#: Items and windows of items searched together, rank of the latent space, and terms whose sums travel together.
BLOCK_ITEMS, BLOCK_WINDOWS, RANK, TERM_BLOCK = 2000, 16_000, 64, 256
#: Windows of documents and of items whose candidates are found together, and windows whose cosines are compared together.
TILE_WINDOWS, TILE_QUERIES, TILE_COSINES = 8192, 4096, 512
#: Bits of the hashes of (item, code) that are mapped.
HELD_BITS = 21
#: Terms in more than this share of the half windows are left out of the vectors, unless they are among an item's rarest.
FREQUENT, RAREST = 0.02, 8
#: Words of half a window; windows are two halves and start at each half.
HALF = 16
#: Least cosine of a candidate (for items shorter than a window, times the root of the share that they can fill),
#: and shares of the item's words in the common subsequence.
COSINE, WITHOUT_ANSWER, WITH_ANSWER, SHORT_WORDS, SHORT = 0.5, 0.8, 0.65, 12, 0.9
#: Half windows projected together, and words of documents coded together.
CHUNK, CODED = 2048, 400_000
#: Cells of the words of candidate regions that are compared together.
REGION_CELLS = 2**20
#: Codes of a half window that are added one after the other.
PLAIN = 8

WORD = re.compile(r"[^\W_]+")
#: The same for Latin-1 texts, as a plain set of characters.
LATIN_WORD = re.compile("[" + re.escape("".join(c for c in map(chr, range(256)) if WORD.match(c))) + "]+")
#: And as bytes: lower case for the characters of words, a space for any other.
LATIN_BYTES = bytes(ord(c.lower()) if WORD.match(c) else 32 for c in map(chr, range(256)))


def words(text: str | None) -> list[str]:
    low = text.lower() if text else ""
    return (LATIN_WORD if is_latin(low) else WORD).findall(low)


@dataclass
class Items:
    """The benchmark items of a block: ids, words as codes, and answers (codes of the last sentence's words)."""

    ids: list
    codes: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: dict[str, int]


def read_items(rows: list) -> Items:
    """Items of ``(id, text)`` rows; those without a word are left out."""
    vocabulary: dict[str, int] = {}
    ids, codes, answers = [], [], []
    for item, text in rows:
        found = words(text)
        if not found:
            continue
        ids.append(item)
        codes.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in found], np.int64))
        sentences = [s for s in re.split(r"[.?!\n]+", text) if words(s)]
        answers.append(np.array([vocabulary[w] for w in words(sentences[-1]) if w in vocabulary], np.int64))
    return Items(ids, codes, answers, vocabulary)


class Coder:
    """Codes of a text's words; Latin-1 texts are cut and looked up many at a time."""

    def __init__(self, vocabulary: dict[str, int], width: str) -> None:
        self.vocabulary, self.width, self.other = vocabulary, width, len(vocabulary)
        latin = [w for w in vocabulary if is_latin(w)]
        self.latin = pa.array([w.encode("latin-1") for w in latin], pa.binary())
        self.codes = np.array([*(vocabulary[w] for w in latin), self.other], width)

    def of(self, texts: list[str | None]) -> list[bytes]:
        out, places, lines = [b""] * len(texts), [], []
        for k, text in enumerate(texts):
            try:
                line = text.encode("latin-1").translate(LATIN_BYTES).strip() if text else b""
            except UnicodeEncodeError:
                found = words(text)
                out[k] = np.fromiter(map(self.vocabulary.get, found, repeat(self.other)), self.width, len(found)).tobytes()
                continue
            if line:
                places.append(k)
                lines.append(line)
        # bytes as text for the kernel, which looks for ASCII white space only
        lists = pc.ascii_split_whitespace(pa.array(lines, pa.binary()).view(pa.string()))
        places_of = pc.index_in(lists.values.view(pa.binary()), value_set=self.latin)
        codes = self.codes[places_of.fill_null(len(self.latin)).to_numpy()]
        ends = lists.offsets.to_numpy()
        for k, a, b in zip(places, ends[:-1], ends[1:], strict=True):
            out[k] = codes[a:b].tobytes()
        return out


def _coded(docs: DataFrame, vocabulary: dict[str, int], id_col: str, text_col: str) -> DataFrame:
    """``id_col`` and the code of each word as bytes; the vocabulary's size stands for any other word."""
    slim = docs.select(id_col, text_col)
    kind = slim.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    width = "<u2" if len(vocabulary) < 2**16 else "<u4"

    def code(batches):
        coder = Coder(shared.value, width)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(coder.of(batch.column(1).to_pylist()), pa.binary())], [id_col, "codes"])

    return slim.mapInArrow(code, f"`{id_col}` {kind}, codes binary")


def _halves(codes: list[np.ndarray], other: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts as rows of ``HALF`` codes, ends filled up with ``other``, and the text of each row."""
    counts = np.array([-(-len(c) // HALF) for c in codes])
    rows = np.full((int(counts.sum()), HALF), other, np.int64)
    flat, at = rows.ravel(), 0
    for c, n in zip(codes, counts, strict=True):
        flat[at : at + len(c)] = c
        at += n * HALF
    return rows, np.repeat(np.arange(len(codes)), counts)


def _projected(rows: np.ndarray, basis: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Sum of the basis rows of each row's codes; only ``used`` codes have one."""
    out = np.empty((len(rows), basis.shape[1]), np.float32)
    for k in range(0, len(rows), CHUNK):
        part = rows[k : k + CHUNK]
        known = used[part]
        counts = known.sum(axis=1)
        codes, order = part[known], np.argsort(-counts, kind="stable")
        starts = (np.cumsum(counts) - counts)[order]
        # The rows with most codes stand first, so those with a code at a place are a run.  The first code is added last, as numpy
        # does; rows of more than PLAIN codes, where numpy adds in another order, are left to it.
        longer = np.searchsorted(-counts[order], -np.arange(HALF))
        sums = np.zeros((len(part), basis.shape[1]), np.float32)
        many = longer[PLAIN]
        for j in [*range(1, min(PLAIN, int(counts.max()))), 0]:
            n = max(many, longer[j])
            sums[many:n] += basis.take(codes.take(starts[many:n] + j), axis=0)
        if many:
            long = order[:many]
            begins = np.cumsum(counts[long]) - counts[long]
            sums[:many] = np.add.reduceat(basis[part[long][known[long]]], begins, axis=0)
        out[k + order] = sums
    return out


def _sums(made: np.ndarray, places: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``made`` at runs of ``places``, column by column: a column stays in the processor's cache."""
    out = np.empty((len(starts), made.shape[1]), made.dtype)
    for k, column in enumerate(np.ascontiguousarray(made.T)):
        out[:, k] = np.add.reduceat(column.take(places), starts)
    return out


def _windows(texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last half of each window: two neighbouring halves of a text, or its only one."""
    follows = np.concatenate((texts[1:] == texts[:-1], [False])) if len(texts) else np.zeros(0, bool)
    preceded = np.concatenate(([False], follows[:-1])) if len(texts) else follows
    first = np.flatnonzero(follows | ~preceded)
    return first, first + follows[first]


def _groups(batches, width: str):
    """Ids and code arrays of runs of documents of about ``CODED`` words; a long document is a run of its own."""
    ids, codes, size = [], [], 0
    for batch in batches:
        for i, c in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            found = np.frombuffer(c.as_py(), width)
            if not len(found):
                continue
            if size and size + len(found) > CODED:
                yield ids, codes
                ids, codes, size = [], [], 0
            ids.append(i)
            codes.append(found)
            size += len(found)
    if ids:
        yield ids, codes


class WordCounts:
    """How often each item has each code, by search among the pairs that there are; a map of their hashes answers for most that there are not."""

    def __init__(self, codes: list[np.ndarray], size: int) -> None:
        self.size = size
        pairs = np.concatenate([k * size + c for k, c in enumerate(codes)])
        self.pairs, self.counts = np.unique(pairs, return_counts=True)
        self.held = np.zeros(2**HELD_BITS, bool)
        self.held[self._hash(self.pairs)] = True

    @staticmethod
    def _hash(pairs: np.ndarray) -> np.ndarray:
        return (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - HELD_BITS)

    def of(self, item: np.ndarray, code: np.ndarray) -> np.ndarray:
        wanted = item * self.size + code
        out = np.zeros(len(wanted), np.int64)
        near = np.flatnonzero(self.held[self._hash(wanted)])
        place = np.minimum(np.searchsorted(self.pairs, wanted[near]), len(self.pairs) - 1)
        out[near] = np.where(self.pairs[place] == wanted[near], self.counts[place], 0)
        return out


class Search:
    """One block of items against all documents."""

    def __init__(self, coded: DataFrame, items: Items, id_col: str, rank: int = RANK, seed: int = 7) -> None:
        self.coded, self.items, self.id_col = coded, items, id_col
        self.size = len(items.vocabulary)
        self.width = "<u2" if self.size < 2**16 else "<u4"
        self.rank = min(rank, self.size)
        self.weights = self._weights()
        self.basis, self.singular_values = self._svd(seed)

    def _weights(self) -> np.ndarray:
        """Inverse document frequency of each term over the half windows of all documents; the last, of other words, is zero.

        The root of the inverse share, not its logarithm: all terms then bring the same energy into the decomposition, and its leading
        directions are rare terms that occur together, as those of a leaked item do, and not the frequent words.
        """
        size, width = self.size, self.width

        def count(batches):
            found, n = np.zeros(size + 1, np.int64), 0
            for _, codes in _groups(batches, width):
                rows, _ = _halves(codes, size)
                n += len(rows)
                rows = np.sort(rows.astype(width), axis=1)
                first = np.concatenate((np.ones((len(rows), 1), bool), rows[:, 1:] != rows[:, :-1]), axis=1)
                found += np.bincount(rows[first], minlength=size + 1)
            terms = np.append(np.flatnonzero(found[:size]), size)
            found[size] = n
            yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(found[terms])], ["term", "n"])

        sums = self.coded.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
        found = np.zeros(size + 1)
        found[sums["term"].to_numpy()] = sums["n"].to_numpy()
        weights = np.sqrt(max(found[size], 1) / np.maximum(found, 1)).astype(np.float32)
        weights[size] = 0
        # Half of all words are a few dozen frequent ones that tell little; the common subsequence still counts them.
        needed = np.zeros(size + 1, bool)
        for c in self.items.codes:
            distinct = np.unique(c)
            needed[distinct[np.argsort(-weights[distinct], kind="stable")[:RAREST]]] = True
        weights[(found > FREQUENT * max(found[size], 1)) & ~needed] = 0
        return weights

    def _product(self, basis: np.ndarray) -> np.ndarray:
        """``X' X basis`` over the TF-IDF half windows X of all documents; terms by rank."""
        size, width, weights, used = self.size, self.width, self.weights, self.weights > 0
        shared = self.coded.sparkSession.sparkContext.broadcast(np.vstack((basis * weights[:-1, None], np.zeros((1, basis.shape[1])))).astype(np.float32))

        def multiply(batches):
            total = np.zeros((size, basis.shape[1]), np.float64)
            for _, codes in _groups(batches, width):
                rows, _ = _halves(codes, size)
                made = _projected(rows, shared.value, used)
                places = np.flatnonzero(used[rows.ravel()])
                order = places[np.argsort(rows.ravel()[places].astype(width), kind="stable")]
                terms = rows.ravel()[order]
                starts = np.flatnonzero(np.concatenate(([True], terms[1:] != terms[:-1]))) if len(terms) else []
                if len(terms):
                    total[terms[starts]] += _sums(made, order // HALF, starts)
            total *= weights[:-1, None]
            for k in range(0, size, TERM_BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([total[k : k + TERM_BLOCK].tobytes()])], ["block", "sums"])

        def add(table: pa.Table) -> pa.Table:
            total = reduce(np.add, (np.frombuffer(x.as_py()) for x in table.column("sums")))
            return pa.table({"block": table.column("block").slice(0, 1), "sums": pa.array([total.tobytes()])})

        parts = self.coded.mapInArrow(multiply, "block long, sums binary").groupBy("block").applyInArrow(add, "block long, sums binary")
        found = np.zeros((size, basis.shape[1]))
        for row in parts.collect():  # terms by rank, whatever the number of documents
            values = np.frombuffer(row["sums"]).reshape(-1, basis.shape[1])
            found[row["block"] : row["block"] + len(values)] = values
        shared.unpersist()
        return found

    def _svd(self, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Right singular vectors (times the weights, with a last row of zeros) and singular values, by one power step."""
        start = np.random.default_rng(seed).standard_normal((self.size, self.rank))
        ortho, _ = np.linalg.qr(self._product(start))
        square = ortho.T @ self._product(ortho)
        values, turn = np.linalg.eigh((square + square.T) / 2)
        vectors = (ortho @ turn[:, ::-1]) * self.weights[:-1, None]
        return np.vstack((vectors, np.zeros((1, self.rank)))).astype(np.float32), np.sqrt(np.maximum(values[::-1], 0))

    def found(self) -> DataFrame:
        """Contaminated documents with item, best cosine, share of the item's words in order, and whether the answer is there."""
        items, size, width, weights, basis = self.items, self.size, self.width, self.weights, self.basis
        id_col = self.id_col
        rows, owner = _halves(items.codes, size)
        a, b = _windows(owner)
        used = weights > 0
        halves = _projected(rows, basis, used)
        queries = np.where((a != b)[:, None], halves[a] + halves[b], halves[a])
        queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-9)
        first = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(items.codes)))))
        lengths = np.array([len(c) for c in items.codes])
        has = WordCounts(items.codes, size + 1)
        least = COSINE * np.sqrt(np.minimum(1, lengths / (2 * HALF)))
        shared = self.coded.sparkSession.sparkContext.broadcast(
            (basis, queries.T.copy(), owner[a], (a - first[owner[a]]) * HALF, least[owner[a]].astype(np.float32), has, lengths, items)
        )
        key = self.coded.schema[id_col].dataType.simpleString()
        item_kind = "string" if items.ids and isinstance(items.ids[0], str) else "long"

        def search(batches):
            basis, queries, item_of, offset, least, has, lengths, items = shared.value
            for ids, codes in _groups(batches, width):
                rows, texts = _halves(codes, size)
                a, b = _windows(texts)
                halves = _projected(rows, basis, used)
                begins = np.concatenate(([0], np.cumsum([-(-len(c) // HALF) for c in codes])))
                best: dict[tuple[int, int], tuple] = {}
                for k in range(0, len(a), TILE_WINDOWS):
                    x, y = a[k : k + TILE_WINDOWS], b[k : k + TILE_WINDOWS]
                    made = np.where((x != y)[:, None], halves[x] + halves[y], halves[x])
                    made /= np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-9)
                    for j in range(0, queries.shape[1], TILE_QUERIES):
                        w, q, cosine = _near(made, queries[:, j : j + TILE_QUERIES], least[j : j + TILE_QUERIES])
                        # a region is as wide as the longest item, so long items take fewer regions at once
                        step = max(1, REGION_CELLS // int(lengths.max() + 4 * HALF))
                        for p in range(0, len(w), step):
                            near, query = w[p : p + step], q[p : p + step]
                            _decide(x[near], query + j, cosine[p : p + step], rows.ravel(), texts, begins, codes, item_of, offset, has, lengths, items, best)
                if best:
                    pairs = sorted(best.items())
                    columns = [
                        pa.array([ids[t] for (t, _), _ in pairs]), pa.array([items.ids[i] for (_, i), _ in pairs]),
                        pa.array([v[1] for _, v in pairs], pa.float64()), pa.array([v[0] for _, v in pairs], pa.float64()),
                        pa.array([v[2] for _, v in pairs], pa.bool_()), pa.array([v[3] for _, v in pairs], pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, [id_col, "item_id", "cosine", "common", "answer", "start_word"])

        return self.coded.mapInArrow(search, f"`{id_col}` {key}, item_id {item_kind}, cosine double, common double, answer boolean, start_word long")


def _near(made: np.ndarray, queries: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows and queries at or above the least cosine, and their cosines; few windows at a time are compared, in the cache."""
    cosine, found = made @ queries, []
    for k in range(0, len(made), TILE_COSINES):
        at = np.flatnonzero(cosine[k : k + TILE_COSINES] >= least)
        found.append(k * queries.shape[1] + at)
    at = np.concatenate(found)
    return at // queries.shape[1], at % queries.shape[1], cosine.ravel()[at]


def _decide(half, query, cosine, flat, texts, begins, codes, item_of, offset, has, lengths, items, best) -> None:
    """Keep the candidates whose region holds the item's words in order, and its answer."""
    item, text = item_of[query], texts[half]
    begin = begins[text] * HALF
    low = np.maximum(half * HALF - offset[query] - 2 * HALF, begin)
    span = lengths[item] + 4 * HALF
    high = np.minimum(low + span, begin + np.array([len(codes[t]) for t in text]))
    # each candidate once: windows of one text and item that look at the same region
    keys = np.unique(np.stack((text, item, low), axis=1), axis=0, return_index=True)[1]
    item, text, low, high, begin, cosine = item[keys], text[keys], low[keys], high[keys], begin[keys], cosine[keys]
    places = low[:, None] + np.arange(int(span.max()))
    inside = places < high[:, None]
    regions = np.sort(np.where(inside, flat[np.minimum(places, len(flat) - 1)], has.size - 1), axis=1)
    fresh = np.concatenate((np.ones((len(regions), 1), bool), regions[:, 1:] != regions[:, :-1]), axis=1)
    # no common subsequence is longer than the words shared in any order, each as often as both have it
    y, x = np.nonzero(fresh)
    at = y * regions.shape[1] + x
    times = np.minimum(np.diff(np.append(at, regions.size)), has.of(item[y], regions[y, x]))
    held = np.bincount(y, weights=times, minlength=len(regions))
    needed = np.where(lengths[item] <= SHORT_WORDS, SHORT, WITH_ANSWER)
    for k in np.flatnonzero(held / lengths[item] >= needed):
        t, i, lo, b, c = text[k], item[k], low[k], begin[k], cosine[k]
        region = flat[lo : high[k]]
        common, last = common_words(items.codes[i], region)
        share = len(common) / lengths[i]
        tail = set(items.answers[i].tolist())
        answer = not tail or len(tail & set(common)) >= 0.5 * len(tail)
        needed = SHORT if lengths[i] <= SHORT_WORDS else WITH_ANSWER if answer else WITHOUT_ANSWER
        if share >= needed:
            new = (float(share), float(c), bool(answer), int(lo - b + last))
            if (t, i) not in best or best[t, i] < new:
                best[int(t), int(i)] = new


def common_words(item: np.ndarray, region: np.ndarray) -> tuple[list[int], int]:
    """Codes of a longest common subsequence, and where in the region its first word stands."""
    table = np.zeros((len(item) + 1, len(region) + 1), np.int32)
    for k in range(len(item) - 1, -1, -1):
        # from the right: best of skipping the item's word, or of taking it at the next place where it stands
        take = np.where(region == item[k], table[k + 1, 1:] + 1, table[k + 1, :-1])
        table[k, :-1] = np.maximum.accumulate(take[::-1])[::-1]
    out, i, j, first = [], 0, 0, -1
    while i < len(item) and j < len(region) and table[i, j]:
        if table[i + 1, j] == table[i, j]:
            i += 1
        elif table[i, j + 1] == table[i, j]:
            j += 1
        else:
            first = j if first < 0 else first
            out.append(int(item[i]))
            i, j = i + 1, j + 1
    return out, max(first, 0)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row for each document and benchmark item that it holds: cosine, share of common words, answer, first word.

    Items of one text are one item to the search, and each of their ids has its rows.
    """
    items = benchmark.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text}`").alias("words")).where("words is not null")
    keyed = items.withColumn("key", F.sha2("words", 256))
    distinct = written(keyed.groupBy("key").agg(F.first("words").alias("words")), "items")
    windows = F.sum(F.ceil(F.size(F.split("words", r"[\W_]+")) / HALF)).alias("windows")
    size = distinct.agg(F.count("*").alias("items"), windows).first()
    blocks = max(1, math.ceil(size["items"] / BLOCK_ITEMS), math.ceil((size["windows"] or 0) / BLOCK_WINDOWS))
    found = []
    for k in range(blocks):
        rows = distinct.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == k).collect()  # about BLOCK_ITEMS texts of BLOCK_WINDOWS windows
        block = read_items([tuple(r) for r in rows])
        if not block.ids:
            continue
        coded = written(_coded(docs, block.vocabulary, id_col, text_col), "coded")
        found.append(Search(coded, block, id_col).found())
    if found:
        ids = keyed.select(F.col("key").alias("_key"), F.col("item").alias("_item"))
        joined = reduce(DataFrame.unionByName, found).join(ids, F.col("item_id") == F.col("_key"))
        return joined.select(id_col, F.col("_item").alias("item_id"), "cosine", "common", "answer", "start_word")
    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    return docs.sparkSession.createDataFrame([], f"`{id_col}` {kind}, item_id {item_kind}, cosine double, common double, answer boolean, start_word long")
