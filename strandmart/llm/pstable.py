"""Near-duplicate vectors by p-stable hashing.

Vectors of unit length are projected on random Gaussian directions, projections are quantised to steps, and a few of them form the
key of a table; vectors that agree in a table's key are compared by their exact cosine.  Tables are as many as find a pair at the threshold with the
wanted probability, and nearer pairs are found almost surely; projections per key follow the number of vectors, so strangers
seldom meet.

Equal vectors are one node with a count.  Keys that one node has alone are left out before any vector travels.  Members of a key are compared in
blocks: a key of more members than a block holds is split into pairs of blocks, which any tasks take.  A block returns, for each node,
the number of its links and the smallest node that it reaches there, never pairs; a pair counts in the first table where it meets.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmart.llm.components import components, local_roots
from strandmart.llm.tables import written

#: Step of the quantised projections, strangers a key should meet, and members of a block and rows of a task's bundle of keys.
STEP, STRANGERS, BLOCK, BUNDLE = 2.0, 0.1, 2048, 20_000
#: Vectors and directions are rounded to these fractions, so that projections are sums of integers below 2**53: the same on every machine.
_FINE, _COARSE = 2.0**20, 2.0**12


def agreement(distance: float, step: float = STEP) -> float:
    """Probability that the projections of two points at this distance fall into one step."""
    if distance <= 0:
        return 1.0
    x = step / distance
    tail = 0.5 * math.erfc(x / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * x) * (1 - math.exp(-x * x / 2))


def shape(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """Projections per key and tables for so many vectors: strangers are at right angles, the pairs wanted at the threshold."""
    near, far = agreement(math.sqrt(max(0.0, 2 - 2 * threshold))), agreement(math.sqrt(2))
    depth = max(1, math.ceil(math.log(max(n, 2) / STRANGERS) / -math.log(far)))
    found = near**depth
    return depth, 1 if found >= recall else math.ceil(math.log(1 - recall) / math.log(1 - found))


@lru_cache(8)
def _directions(dims: int, count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dims])
    return np.rint(rng.standard_normal((dims, count)) * _COARSE), rng.integers(0, int(STEP * _FINE * _COARSE), count).astype(np.float64)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors scaled to length one in double precision, whatever their size."""
    scaled = vectors.astype(np.float64)
    scaled = scaled / np.abs(scaled).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def table_keys(units: np.ndarray, depth: int, tables: int, seed: int) -> np.ndarray:
    """The key of every vector in every table."""
    dims = units.shape[1]
    directions, shifts = _directions(dims, depth * tables, seed)
    places = np.floor((np.rint(units * _FINE) @ directions + shifts) / (STEP * _FINE * _COARSE)).astype(np.int64).view(np.uint64)
    keys = np.broadcast_to((np.arange(tables, dtype=np.uint64) << np.uint64(32)) + np.uint64(dims), (len(units), tables)).copy()
    for k in range(depth):
        keys = _mixed(keys ^ places[:, k::depth])
    return keys


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) + np.uint64(0x9E3779B97F4A7C15)


def _by_length(column):
    """Places and matrix of the vectors of each length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, offsets = np.asarray(column.values.to_numpy(zero_copy_only=False)), column.offsets.to_numpy()
    lengths = np.diff(offsets)
    for d in np.unique(lengths):
        places = np.flatnonzero(lengths == d)
        yield places, flat[offsets[places][:, None] + np.arange(d)]


def _pairs(starts: np.ndarray, sizes: np.ndarray, units: np.ndarray, threshold: float):
    """Places of the pairs within groups that reach the threshold."""
    small = sizes <= 32
    for off in range(1, int(sizes[small].max(initial=1))):
        # the pairs of all small groups that lie this far apart
        some = small & (sizes > off)
        left = np.repeat(starts[some], sizes[some] - off) + _within(sizes[some] - off)
        for k in range(0, len(left), 65_536):
            i = left[k : k + 65_536]
            i = i[(units[i] * units[i + off]).sum(axis=1) >= threshold]
            yield i, i + off
    for start, n in zip(starts[~small], sizes[~small], strict=True):
        for k in range(start, start + n, 512):
            rows = np.arange(k, min(k + 512, start + n))
            i, j = np.nonzero(units[rows] @ units[k : start + n].T >= threshold)
            yield rows[i[j > i]], k + j[j > i]


def _within(sizes: np.ndarray) -> np.ndarray:
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def near_links(nodes: DataFrame, n: int, threshold: float, recall: float, seed: int = 5) -> DataFrame:
    """``node``, ``links`` (copies linked to it) and ``root`` (a node it reaches, at most itself) of ``node``, ``copies`` and ``vec``, in parts.

    A node's links are the sum over its rows; nodes without a link have none.
    """
    depth, tables = shape(n, threshold, recall)
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def deal(batches):
        for batch in batches:
            for places, vectors in _by_length(batch.column(1)):
                keys = table_keys(unit(vectors), depth, tables, seed)
                node = np.repeat(batch.column(0).to_numpy()[places], tables)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(node)], ["key", "node"])

    entries = nodes.select("node", "vec").mapInArrow(deal, "key long, node long")
    shared = written(entries.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "keys")
    wide = F.ceil(F.col("members") / BLOCK)
    total = shared.agg(F.sum(F.col("members") * wide)).first()[0] or 0
    blocks = (
        entries.join(shared, "key").withColumn("blocks", wide.cast("int")).withColumn("side", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", "node", "side", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"))
    )
    bundles = max(parts, math.ceil(total / BUNDLE))
    met = blocks.join(nodes.select("node", "copies", "vec"), "node").withColumn("bundle", F.pmod(F.xxhash64("key", "low", "high"), F.lit(bundles)))

    def check(table: pa.Table) -> pa.Table:
        column = {name: table.column(name).to_numpy() for name in ("key", "low", "high", "side", "node", "copies")}
        ends, links = [], np.zeros(table.num_rows, np.int64)
        for places, vectors in _by_length(table.column("vec")):
            order = np.lexsort([column[c][places] for c in ("node", "high", "low", "key")])
            places, units = places[order], unit(vectors[order])
            mine = {name: values[places] for name, values in column.items()}
            key = mine["key"].view(np.uint64)
            new = np.concatenate(([True], np.any([mine[c][1:] != mine[c][:-1] for c in ("key", "low", "high")], axis=0)))
            starts = np.flatnonzero(new)
            keys = table_keys(units, depth, tables, seed)
            own = np.argmax(keys == key[:, None], axis=1)
            for i, j in _pairs(starts, np.diff(np.append(starts, len(new))), units, threshold):
                # of two different blocks, the pairs within each belong to other tasks
                between = (mine["low"][i] == mine["high"][i]) | (mine["side"][i] != mine["side"][j])
                i, j = i[between], j[between]
                ends.append((mine["node"][i], mine["node"][j]))
                for k in range(0, len(i), 32_768):
                    a, b = i[k : k + 32_768], j[k : k + 32_768]
                    first = ~((keys[a] == keys[b]) & (np.arange(tables) < own[a][:, None])).any(axis=1)
                    np.add.at(links, places[a[first]], mine["copies"][b[first]])
                    np.add.at(links, places[b[first]], mine["copies"][a[first]])
        ids, flat = np.unique(column["node"], return_inverse=True)
        sums, root = np.zeros(len(ids), np.int64), ids.copy()
        np.add.at(sums, flat, links)
        if ends:
            above, low = local_roots(*(np.concatenate(x) for x in zip(*ends, strict=True)))
            root[np.searchsorted(ids, above)] = low
        seen = (sums > 0) | (root != ids)
        return pa.table({"node": ids[seen], "links": sums[seen], "root": root[seen]})

    rows = met.select("bundle", "key", "low", "high", "side", "node", "copies", "vec")
    return rows.groupBy("bundle").applyInArrow(check, "node long, links long, root long")


def near_duplicates(
    rows: DataFrame, threshold: float = 0.95, recall: float = 0.97, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``id_col``, ``n_links`` (other rows linked directly) and ``component_id`` (smallest id reachable by links, its own included).

    Rows link when they were found and their cosine, in double precision, is ``threshold`` or more; a pair at the threshold is found with
    probability ``recall``, equal vectors always.  Null and empty vectors, zero vectors, and vectors with a null or non-finite component link with
    nothing, nor do vectors of different lengths.  Repeated rows are rows like others.  Null ids count as links but are no component's smallest; a
    component of null ids has a null one.  Other columns are not read.  An empty table gives an empty one.
    """
    vector = F.col(f"`{vector_col}`")
    kind = rows.select(vector).schema[0].dataType.elementType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    usable = vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)
    # minus zero is zero
    vec = F.when(F.coalesce(usable, F.lit(False)), F.transform(vector, lambda x: x.cast(kind) + F.lit(0.0).cast(kind)))
    slim = rows.select(F.col(f"`{id_col}`").alias("id"), vec.alias("vec"))
    digest = [F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(17), "vec").alias("h2")]
    distinct = slim.where("vec is not null").groupBy("vec").agg(F.min("id").alias("low"), F.count("*").alias("copies"))
    nodes = written(distinct.select(F.monotonically_increasing_id().alias("node"), "low", "copies", *digest, "vec"), "vectors")
    found = written(near_links(nodes, nodes.count(), threshold, recall), "vector-links")
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    rooted = nodes.select("node", "low", "copies", "h1", "h2").join(links, "node", "left").join(roots, "node", "left")
    rooted = written(rooted.select("h1", "h2", "low", F.coalesce("root", "node").alias("root"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    known = rooted.join(lowest, "root").select("h1", "h2", "n_links", "component_id")
    linked = slim.where("vec is not null").select("id", *digest).join(known, ["h1", "h2"]).select("id", "n_links", "component_id")
    alone = slim.where("vec is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionAll(alone).withColumnRenamed("id", id_col)
