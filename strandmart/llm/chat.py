"""Chat formatting of reply trees with DataFrame operations only.

Messages name their parents.  Jump pointers double in each round by a self-join (a message's ancestor at 1, 2, 4, ... steps), and the rows
of each path double with them, so the paths of a tree of depth d take about log2(d) joins and as many rows as they have messages.
Paths are ranked by score within their tree, and each chosen one becomes one text:

    <turn ROLE>TEXT</turn><turn ROLE>TEXT</turn>

In roles and texts a backslash becomes ``\\b``, ``<`` becomes ``\\l`` and ``>`` becomes ``\\g``, so no text can open or close a turn and all can be
read back.  The loss mask is a list of (start, end) in code points of the formatted text, one for each text of the trained role.

Defined results: a null text or role counts as an empty one; null tree ids form one tree; a message whose parent is missing is a root; messages that
reach no root (cycles) are in no path; a message repeated under the same id is ambiguous, so ids must be unique within a tree (``numbered``
gives repeated turns places of their own); empty tables give empty ones; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmart.llm.tables import written

ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
END = "</turn>"


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def numbered(turns: DataFrame, tree_col: str = "conv_id", order: tuple[str, ...] = ("turn", "role", "text")) -> DataFrame:
    """Turns of linear conversations as messages: ``tree``, ``node`` (their place), ``parent``, ``role``, ``text``, ``score``."""
    place = F.row_number().over(Window.partitionBy(tree_col).orderBy(*order)).cast("long")
    rows = turns.select(F.col(tree_col).alias("tree"), place.alias("node"), "role", "text")
    return rows.select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )


def _same(a: DataFrame, b: DataFrame, left: str, right: str) -> Column:
    return a["tree"].eqNullSafe(b["tree"]) & (a[left] == b[right])


def paths(messages: DataFrame) -> DataFrame:
    """A row for each message of each root-to-leaf path: ``tree``, ``leaf``, ``node``, ``back`` (steps from the leaf)."""
    links = messages.select("tree", "node", "parent")
    nodes = links.select("tree", "node")
    known = nodes.alias("p")
    jumps = links.alias("c").join(known, F.col("c.tree").eqNullSafe(F.col("p.tree")) & (F.col("c.parent") == F.col("p.node")))
    jumps = written(jumps.select("c.tree", "c.node", F.col("c.parent").alias("to")), "jumps")
    parents = jumps.select("tree", F.col("to").alias("node")).distinct()
    leaves = nodes.join(parents, _same(nodes, parents, "node", "node"), "left_anti")
    rows = written(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("back")), "paths")
    left = jumps.count()
    for k in range(max(1, math.ceil(math.log2(left + 2)) + 1) if left else 0):
        step = rows.alias("r").join(jumps.alias("j"), F.col("r.tree").eqNullSafe(F.col("j.tree")) & (F.col("r.node") == F.col("j.node")))
        more = step.select("r.tree", "r.leaf", F.col("j.to").alias("node"), (F.col("r.back") + 2**k).alias("back"))
        rows = written(rows.unionByName(more), "paths")
        twice = jumps.alias("a").join(jumps.alias("b"), F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.to") == F.col("b.node")))
        jumps = written(twice.select("a.tree", "a.node", "b.to"), "jumps")
        if jumps.isEmpty():
            break
    return rows


def formatted(messages: DataFrame, keep: int | None = None, trained: str = "assistant") -> DataFrame:
    """One row for each chosen path: ``tree``, ``leaf``, ``rank`` (1 is the best score, ties by leaf), ``text`` and ``loss`` (spans).

    ``messages`` has tree, node, parent, role, text and score; ``keep`` is the number of paths of each tree, None for all.
    """
    rows = paths(messages)
    body = messages.select("tree", "node", "role", "text", "score")
    full = rows.alias("r").join(body.alias("m"), F.col("r.tree").eqNullSafe(F.col("m.tree")) & (F.col("r.node") == F.col("m.node")))
    turn = F.struct(
        (-F.col("r.back")).alias("at"), escaped(F.coalesce("m.role", F.lit(""))).alias("role"), escaped(F.coalesce("m.text", F.lit(""))).alias("text")
    )
    grouped = full.groupBy(F.col("r.tree").alias("tree"), F.col("r.leaf").alias("leaf")).agg(
        F.sum(F.coalesce("m.score", F.lit(0.0))).alias("score"), F.sort_array(F.collect_list(turn)).alias("turns")
    )
    ranked = grouped.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")))
    if keep is not None:
        ranked = ranked.where(F.col("rank") <= keep)
    head = lambda t: F.concat(F.lit("<turn "), t["role"], F.lit(">"))
    pieces = F.transform("turns", lambda t: F.concat(head(t), t["text"], F.lit(END)))
    walked = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"), F.lit(None).cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(head(t)) + F.length(t["text"]) + len(END)).alias("at"),
            F.when(
                t["role"] == trained,
                F.concat(
                    F.coalesce(acc["spans"], F.array().cast("array<struct<start:int,end:int>>")),
                    F.array(F.struct((acc["at"] + F.length(head(t))).alias("start"), (acc["at"] + F.length(head(t)) + F.length(t["text"])).alias("end"))),
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
    )
    return ranked.select(
        "tree", "leaf", "rank", F.array_join(pieces, "").alias("text"),
        F.coalesce(walked["spans"], F.array().cast("array<struct<start:int,end:int>>")).alias("loss"),
    )


def read_back(text: Column) -> Column:
    """The turns of a formatted text: an array of (role, text), unescaped."""
    pieces = F.filter(F.split(text, END), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescaped(F.regexp_extract(p, "^<turn ([^>]*)>", 1)).alias("role"),
            unescaped(F.regexp_replace(p, "^<turn [^>]*>", "")).alias("text"),
        ),
    )


def under_loss(text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped and end to end."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substring(text, s["start"] + 1, s["end"] - s["start"]))), "")
