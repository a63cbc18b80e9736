"""Token ids as flat binary files.

Each shard of documents, in ascending order of id over all shards, is three files: ``.ids``, the ids of all its documents end to end as
little-endian unsigned integers (two bytes where the vocabulary allows, else four); ``.offsets``, where each document
begins and the last ends, counted in ids from the shard's start, as 64-bit integers; ``.docs``, the documents' ids as 64-bit integers.  The
manifest, a Parquet table, names the shards in order, and its ``base`` (the ids in all shards before, a prefix sum) makes
the offsets global.  Files are read by memory map, or by ranges where the store is not a local one.

A task writes under names of its own and the manifest lists those of the task that counted, so attempts that were lost or
repeated leave no trace in it.

Documents of one id are in the order of their texts' hashes, whatever the partitioning; equal rows follow each other, and a shard may begin between
them, so an id or text that many rows share is no task's alone.  Shards follow the size of the texts.

Defined results: a null text counts as an empty one and has the end id only; a null id sorts first and is kept as the
smallest integer; repeated rows are written one by one; an empty table gives an empty manifest.
"""

from __future__ import annotations

import math
import re
import sys
import zlib
from array import array
from functools import lru_cache
from itertools import pairwise
from uuid import uuid4

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandmart.llm.bpe import groups, is_latin, latin_classes, unassigned
from strandmart.llm.tables import written

NULL_ID = -(2**63)
#: Pieces that a worker keeps; their ids are bytes, about 200 bytes a piece with its text.
KNOWN_PIECES = 1_000_000
#: Words that are encoded in one text, and bytes of text that a shard should hold.
JOINED_WORDS, SHARD_BYTES = 500, 256_000_000
#: Documents whose ids are read together.
READ_DOCS = 500

# Fixed value: the pattern that byte-level vocabularies split texts with, for any text and for Latin-1 texts.  Words stand first, as most pieces
# are words, and none of the endings begins as they do.
PIECES = regex.compile(
    r" ?\p{L}+| ?\p{N}+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
LATIN_PIECES = re.compile(
    " ?[{L}]+| ?[{N}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{space}{L}{N}]+|[{space}]+(?![^{space}])|[{space}]+".format(**latin_classes())
)


def id_width(tokenizer: Tokenizer) -> int:
    """Bytes of an id."""
    return 2 if tokenizer.get_vocab_size() <= 2**16 else 4


class Known(dict):
    """Ids of pieces; empty bytes, which no piece has, for one that is not known, and ``asked`` holds those."""

    def __init__(self) -> None:
        self.asked: set[str] = set()

    def __missing__(self, piece: str) -> bytes:
        self.asked.add(piece)
        return b""


class Pieces:
    """A byte-level tokenizer that encodes each distinct piece of text once; a piece is encoded alike wherever it stands."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.unknown = unassigned()
        self.known = Known()
        self.width = id_width(self.tokenizer)
        self.code = "H" if self.width == 2 else "I"

    def split(self, text: str) -> list[str] | None:
        """The pieces; None for a text that the tokenizer must read whole (special tokens, very new characters)."""
        if any(s in text for s in self.special):
            return None
        if is_latin(text):
            return LATIN_PIECES.findall(text)
        return None if self.unknown.search(text) else PIECES.findall(text)

    def _bytes(self, ids: list[int]) -> bytes:
        values = array(self.code, ids)
        if sys.byteorder == "big":
            values.byteswap()
        return values.tobytes()

    def _learn(self, new: list[str]) -> None:
        """Encode pieces that are not known yet.

        Words with their blank are encoded many at a time: end to end they make a text that falls into the same pieces.
        """
        words = [p for p in new if p[0] == " " and p[1:].isalpha()]
        alone = [p for p in new if not (p[0] == " " and p[1:].isalpha())]
        for k in range(0, len(words), JOINED_WORDS):
            part = words[k : k + JOINED_WORDS]
            made = self.tokenizer.encode("".join(part), add_special_tokens=False)
            place = np.array(made.word_ids, np.int64)
            if not len(place) or place[-1] != len(part) - 1:
                alone += part
                continue
            raw = self._bytes(made.ids)
            cuts = (np.searchsorted(place, np.arange(len(part) + 1)) * self.width).tolist()
            self.known.update(zip(part, (raw[a:b] for a, b in pairwise(cuts)), strict=True))
        for k in range(0, len(alone), 10_000):
            part = alone[k : k + 10_000]
            found = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            self.known.update((p, self._bytes(e.ids)) for p, e in zip(part, found, strict=True))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as they stand in the files."""
        split = [self.split(t) for t in texts]
        get = self.known.__getitem__
        found = [None if p is None else list(map(get, p)) for p in split]
        new = list(self.known.asked)
        self.known.asked.clear()
        if new:
            if len(self.known) + len(new) > KNOWN_PIECES:
                # what this group needs stays
                kept = {x: ids for p, f in zip(split, found, strict=True) if f is not None for x, ids in zip(p, f, strict=True) if ids}
                self.known.clear()
                self.known.update(kept)
            self._learn(new)
        out = []
        for t, p, f in zip(texts, split, found, strict=True):
            if f is None:
                out.append(self._bytes(self.tokenizer.encode(t, add_special_tokens=False).ids))
                continue
            out.append(b"".join(map(get, p) if b"" in f else f))
        return out


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def write_tokens(
    docs: DataFrame, path: str, folder: str, end_id: int = 0, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode every whole text, write the shards into ``folder`` (on a store that all executors share) and return the manifest.

    The manifest has shard, name, width (bytes of an id), n_docs, n_tokens and base; it is also kept as ``folder``/manifest.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    if shards is None:
        size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / SHARD_BYTES))
    # equal rows may lie in several shards, dealt by a number of their own
    placed = slim.select("id", F.xxhash64("text").alias("tie"), F.rand(3).alias("deal"), "text")
    ordered = placed.repartitionByRange(shards, F.asc_nulls_first("id"), "tie", "deal").sortWithinPartitions(F.asc_nulls_first("id"), "tie").select("id", "text")
    if end_id >= 256 ** (width := id_width(Tokenizer.from_file(path))):
        raise ValueError(f"the end id {end_id} doesn't fit the vocabulary's {width} bytes")
    end = end_id.to_bytes(width, "little")

    def write(batches):
        store, root = _open(folder)
        store.create_dir(root)
        name, model, lengths, ids = f"tokens-{uuid4().hex}", pieces(path), array("q"), array("q")
        out = None
        for batch in batches:
            out = out or store.open_output_stream(f"{root}/{name}.ids")
            ids.extend(NULL_ID if i is None else i for i in batch.column(0).to_pylist())
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            for a, b in groups(texts):
                for found in model.encode_many(texts[a:b]):
                    lengths.append(len(found) // width + 1)
                    out.write(found)
                    out.write(end)
        if out is None:
            return
        out.close()
        ends = np.cumsum(np.array(lengths, np.int64))
        for kind, values in (("offsets", np.concatenate(([0], ends))), ("docs", np.array(ids, np.int64))):
            with store.open_output_stream(f"{root}/{name}.{kind}") as file:
                file.write(values.astype("<i8").tobytes())
        row = [TaskContext.get().partitionId(), name, width, len(ids), sum(lengths)]
        yield pa.RecordBatch.from_pydict(dict(zip(("shard", "name", "width", "n_docs", "n_tokens"), ([x] for x in row), strict=True)))

    found = written(ordered.mapInArrow(write, "shard long, name string, width long, n_docs long, n_tokens long"), "shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one short row per shard
    manifest = found.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _file(store: fs.FileSystem, path: str) -> pa.NativeFile:
    """A file for reading by ranges: memory-mapped on a local store."""
    return pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)


def _values(source: pa.NativeFile, kind: str, first: int, count: int) -> np.ndarray:
    """Integers of a range of a file."""
    width = np.dtype(kind).itemsize
    return np.frombuffer(source.read_at(count * width, first * width), kind)


def read_tokens(manifest: DataFrame, folder: str, digest=None) -> DataFrame:
    """One row per document from the files: doc_id, start (ids of all documents before), n_tokens, and the ids.

    With ``digest`` (a function of the ids as unsigned 32-bit integers that returns an integer), its value stands in for the ids.
    """

    def read(batches):
        store, root = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                at = f"{root}/{row['name']}"
                flat, offsets, docs = (_file(store, f"{at}.{kind}") for kind in ("ids", "offsets", "docs"))
                for k in range(0, row["n_docs"], READ_DOCS):
                    n = min(READ_DOCS, row["n_docs"] - k)
                    cut, doc = _values(offsets, "<i8", k, n + 1), _values(docs, "<i8", k, n)
                    ids = [_values(flat, f"<u{row['width']}", a, b - a).astype("<u4") for a, b in pairwise(cut.tolist())]
                    last = pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())) if digest is None else pa.array(map(digest, ids), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc, mask=doc == NULL_ID), pa.array(cut[:-1] + row["base"]), pa.array(np.diff(cut)), last],
                        ["doc_id", "start", "n_tokens", "value"],
                    )

    kind = "array<int>" if digest is None else "long"
    rows = manifest.repartition(max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "shard")
    return rows.mapInArrow(read, f"doc_id long, start long, n_tokens long, value {kind}")


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.tobytes())
