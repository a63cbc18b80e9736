"""Connected components of a link table by alternating large and small stars.

Each round points the neighbours of every node at the smallest node they see, first those above the node and then those below it, until
nothing moves.  A round is two map-side combined minima joined back; links live in written tables, never on the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmart.llm.tables import written


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links held by one task as one link from each node to the smallest it reaches there."""
    nodes, flat = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = label.copy()
        np.minimum.at(low, x, label[y])
        np.minimum.at(low, y, label[x])
        low = low[low]
        if (low == label).all():
            break
        label = low
    above = label != np.arange(len(nodes))
    return nodes[above], nodes[label[above]]


def _state(links: DataFrame) -> tuple:
    """Count and order-free checksums of the links."""
    mixed = F.xxhash64("a", "b")
    row = links.agg(F.count("*"), F.bit_xor(mixed), F.sum(mixed % F.lit(2**31))).first()
    return tuple(row)


def _star(links: DataFrame, keep: str) -> DataFrame:
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    seen = both if keep == "large" else both.where("b < a")
    lowest = seen.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    joined = seen.join(lowest, "a")
    moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")) if keep == "large" else (
        joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionAll(lowest.select("a", F.col("low").alias("b")))
    )
    return moved.where("a <> b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node it reaches) of each node above its root; roots have no row of their own.

    Null ends and loops link nothing; repeated links count once; without links the table is empty.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    links = written(links, "links")
    state = _state(links)
    while state[0]:
        links = written(_star(_star(links, "large"), "small"), "links")
        if (now := _state(links)) == state:
            break
        state = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
