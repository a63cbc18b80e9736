"""Byte-pair encoding and decoding by batched merge rounds.

The symbols of many words lie in one flat array.  In each round every pair of neighbours gets the rank of its merge by binary
search over the sorted pair keys, the lowest rank of each word is found, and all its occurrences are merged at once; words without
a merge leave.  Words are encoded once per worker and kept in a bounded table.

Defined results: a null text counts as an empty one and has no ids; repeated rows are encoded one by one; an empty table
gives an empty table; only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer


def latin_classes() -> dict[str, str]:
    """Letters, numbers and white space below code point 256, as the inside of a pattern's class."""
    found = {"L": "", "N": "", "space": ""}
    for c in map(chr, range(256)):
        kind = "space" if c in "\t\n\x0b\x0c\r \x85\xa0" else unicodedata.category(c)[0]
        if kind in found:
            found[kind] += re.escape(c)
    return found


def is_latin(text: str) -> bool:
    """Whether all code points are below 256."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def unassigned() -> re.Pattern[str]:
    """Code points that Python's character tables don't know; a tokenizer library may."""
    runs, first = [], None
    for c in range(0x110001):
        new = c < 0x110000 and unicodedata.category(chr(c)) == "Cn"
        if new and first is None:
            first = c
        elif not new and first is not None:
            runs.append(f"{re.escape(chr(first))}-{re.escape(chr(c - 1))}")
            first = None
    return re.compile("[" + "".join(runs) + "]")


NONE = np.int64(2**62)
#: Words that a worker keeps, and characters of text whose words are encoded together.
KNOWN_WORDS = 200_000
GROUP_CHARS = 1_000_000

# Fixed value: the pattern that the vocabulary's file gives for its words, for any text and for Latin-1 texts.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
LATIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^{space}{L}{N}]+".format(**latin_classes()))


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class WordBpe:
    """A lower-case vocabulary with word ends, read from a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.final = np.array([vocab[s + end] for s in symbols], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.splits = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        names = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.size = len(self.names)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, made = (np.array(x, np.int64) for x in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in pairs), strict=True))
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        # If no merge makes a symbol that an earlier merge uses, all occurrences of a word's lowest pair can merge at once.
        last_made = np.full(self.size, -1, np.int64)
        np.maximum.at(last_made, made, np.arange(len(made)))
        self.at_once = bool((np.arange(len(made)) > np.maximum(last_made[left], last_made[right])).all())
        self.known: dict[str, tuple[int, ...]] = {}
        self.unknown = unassigned()
        self.bytes = {s: b for b, s in enumerate(symbols)}
        self.library = Tokenizer.from_file(path)

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; NONE where there is no such merge."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE), self.made[at]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in order, and the number of ids of each."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        word = np.repeat(np.arange(len(words)), lengths)
        symbol = self.inner[raw]
        last = np.cumsum(lengths[lengths > 0]) - 1
        symbol[last] = self.final[raw[last]]
        rank = np.full(len(symbol), NONE)
        made = np.zeros(len(symbol), np.int64)
        inside = np.flatnonzero(word[:-1] == word[1:])
        rank[inside], made[inside] = self._lookup(symbol[inside], symbol[inside + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            counts = np.diff(np.append(starts, len(symbol)))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), counts)
            open_ = lowest < NONE
            if not open_.all():
                done.append((word[~open_], symbol[~open_]))
                word, symbol, rank, made, lowest = (x[open_] for x in (word, symbol, rank, made, lowest))
                if not len(symbol):
                    break
            hit = np.flatnonzero(rank == lowest)
            if self.at_once:
                # Of a run of overlapping pairs (as in "aaa") every second one merges, from the left.
                fresh = np.concatenate(([True], np.diff(hit) > 1))
                run = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            else:
                hit = hit[np.concatenate(([True], word[hit][1:] != word[hit][:-1]))]
            symbol[hit] = made[hit]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            new = np.cumsum(keep)[hit] - 1
            word, symbol, rank, made = (x[keep] for x in (word, symbol, rank, made))
            near = np.zeros(len(symbol), bool)
            near[new] = True
            near[new[new > 0] - 1] = True
            changed = np.flatnonzero(near)
            rank[changed] = NONE
            changed = changed[changed + 1 < len(symbol)]
            changed = changed[word[changed] == word[changed + 1]]
            rank[changed], made[changed] = self._lookup(symbol[changed], symbol[changed + 1])
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        word, symbol = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return symbol[order], np.bincount(word, minlength=len(words))

    def learn(self, words: set[str]) -> None:
        """Encode the words that the table lacks; the table starts anew when it is full."""
        new = [w for w in words if w not in self.known]
        if not new:
            return
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known.clear()
            new = list(words)
        ids, counts = self.merge([w.encode("utf-8", "surrogatepass") for w in new])
        flat, at = ids.tolist(), 0
        for w, n in zip(new, counts.tolist(), strict=True):
            self.known[w] = tuple(flat[at : at + n])
            at += n

    def words(self, text: str) -> list[str]:
        """The words of a text without its special tokens, in canonical composition and lower case (letter by letter).

        A text with code points newer than Python's tables is split by the library's own normalizer and pre-tokenizer.
        """
        if is_latin(text):
            return LATIN_WORDS.findall(text.lower())
        if self.unknown.search(text):
            split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return [bytes(map(self.bytes.__getitem__, w)).decode() for w, _ in split]
        return WORDS.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def encode_many(self, texts: list[str]) -> list[array]:
        """Ids of each text; special tokens in a text get their ids."""
        pieces = [self.splits.split(t) if "<|" in t else [t] for t in texts]
        split = [[self.words(p) if k % 2 == 0 else p for k, p in enumerate(ps)] for ps in pieces]
        self.learn({w for ps in split for p in ps[::2] for w in p})
        get = self.known.__getitem__
        out = []
        for ps in split:
            ids = array("I")
            for p in ps:
                if isinstance(p, str):
                    ids.append(self.special[p])
                else:
                    ids.extend(chain.from_iterable(map(get, p)))
            out.append(ids)
        return out

    def decode(self, ids: array) -> str:
        """The token names joined by spaces: the vocabulary's file names no decoder that would restore bytes."""
        return " ".join(map(self.names.__getitem__, ids))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    """One table of each vocabulary in a worker."""
    return WordBpe(path)


def groups(texts: list[str], limit: int = GROUP_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``limit`` characters; a long text is a run of its own."""
    first = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield first, k
            first, size = k, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` with ``ids`` (array of int) of each whole text; read them with ``decoded``."""
    slim = docs.select(id_col, text_col)
    kind = slim.schema[id_col].dataType.simpleString()

    def encode(batches):
        bpe = vocabulary(path)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            for a, b in groups(texts):
                ids = bpe.encode_many(texts[a:b])
                offsets = np.cumsum([0, *map(len, ids)])
                values = np.concatenate([np.frombuffer(x, np.uint32) for x in ids]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))],
                    [id_col, "ids"],
                )

    return slim.mapInArrow(encode, f"`{id_col}` {kind}, ids array<int>")


def decoded(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` with the decoded ``text`` of each row's ids."""
    slim = rows.select(id_col, ids_col)
    kind = slim.schema[id_col].dataType.simpleString()

    def decode(batches):
        bpe = vocabulary(path)
        for batch in batches:
            texts = [bpe.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return slim.mapInArrow(decode, f"`{id_col}` {kind}, text string")


def round_trip_digests(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Number and digest of each text's ids, and digest of the text decoded from them, in one pass over the texts.

    With ``with_ids``, the ids too, as an array of int.
    """
    slim = docs.select(id_col, text_col)
    kind = slim.schema[id_col].dataType.simpleString()

    def digests(batches):
        bpe = vocabulary(path)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            counts, codes, backs, kept = [], [], [], []
            for a, b in groups(texts):
                for ids in bpe.encode_many(texts[a:b]):
                    counts.append(len(ids))
                    codes.append(hashlib.sha256(np.frombuffer(ids, np.uint32).astype("<u4").tobytes()).hexdigest())
                    backs.append(hashlib.sha256(bpe.decode(ids).encode("utf-8", "surrogatepass")).hexdigest())
                    if with_ids:
                        kept.append(np.frombuffer(ids, np.uint32).astype(np.int32))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(codes, pa.string()), pa.array(backs, pa.string())]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, [id_col, *names])

    names = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
    more = ", ids array<int>" if with_ids else ""
    return slim.mapInArrow(digests, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
