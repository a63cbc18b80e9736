"""Large CSV files whose quoted fields hold line breaks, read by many tasks.

Where a record ends depends on all quotes before it, so a block of a file can't be read alone: it may begin inside a field.  The quotes of each
block are counted first, and the parity of the sum over the blocks before says how a block begins.  Then each block joins its lines to
records, and only the pieces at its two ends, where a record runs over the border, are brought together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandmart.operators.shape import union_by_name
from strandmart.sources.bronze import ROW_ORDER, column_names, header_groups, list_files, text_schema

_RECORD = "file string, block long, row long, piece int, text string"
_ARROW = pa.schema([("file", pa.string()), ("block", pa.int64()), ("row", pa.int64()), ("piece", pa.int32()), ("text", pa.string())])


def _quotes(text):
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines to records, block by block.

    ``piece`` is 0 for a whole record, -1 for the end of a record that began in an earlier block, 1 for the
    beginning of one that ends in a later block, and 2 for a block within one record.
    """
    block, inside, begun, held, row = None, False, False, [], 0
    out: list[tuple] = []

    def ended(piece):
        out.append((*block, row, piece, "\n".join(held)))
        held.clear()

    for batch in batches:
        for file, start, parity, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, start) != block:
                if held:
                    ended(2 if begun else 1)
                block, inside, begun, row = (file, start), bool(parity), bool(parity), 0
            held.append(line)
            inside ^= bool(line.count('"') & 1)
            if not inside:
                ended(-1 if begun else 0)
                begun, row = False, row + 1
        if out:
            yield _batch(out)
            out.clear()
    if held:
        ended(2 if begun else 1)
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)


def records(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """``file``, ``block``, ``row`` and ``text`` of every record, headers included; a record belongs to the block where it begins.

    Blocks are of ``spark.sql.files.maxPartitionBytes``.  A quote that is never closed makes the rest of its file one record.
    """
    lines = spark.read.option("lineSep", "\n").text(list(files)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    # one small row for each block; a window over the blocks of one file
    counted = lines.groupBy("file", "block").agg((F.sum(_quotes("value")) % 2).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parity = counted.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) % 2).cast("int").alias("parity"))
    starts = {(r.file, r.block) for r in parity.filter("parity = 1").toLocalIterator()}  # blocks that begin inside a field, mostly none
    sent = spark.sparkContext.broadcast(starts)

    def join(batches):
        def marked():
            for batch in batches:
                odd = [int((f, b) in sent.value) for f, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(odd, pa.int32()), batch.column(2)], ["file", "block", "parity", "value"])

        return _records(marked())

    made = lines.mapInArrow(join, _RECORD)
    whole = made.filter("piece = 0").select("file", "block", "row", "text")
    # pieces of one record lie in neighbouring blocks: each beginning opens a group
    pieces = made.filter("piece <> 0")
    opened = F.sum(F.when(F.col("piece") == 1, 1).otherwise(0)).over(Window.partitionBy("file").orderBy("block", "row"))
    groups = pieces.withColumn("group", opened).groupBy("file", "group").agg(F.sort_array(F.collect_list(F.struct("block", "row", "text"))).alias("p"))
    return whole.unionByName(groups.select("file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["row"].alias("row"), F.array_join("p.text", "\n").alias("text")))


def read_big_csv(spark: SparkSession, files: Sequence[str], header: Sequence[str]) -> DataFrame:
    """Files of one header as text columns, and each row's place in its file as ``ROW_ORDER``; empty lines are left out."""
    rows = records(spark, files).select(F.struct("file", "block", "row").alias(ROW_ORDER), F.regexp_replace("text", "\r$", "").alias("text"))
    rows = rows.filter((F.col("text") != "") & ~((F.col(f"{ROW_ORDER}.block") == 0) & (F.col(f"{ROW_ORDER}.row") == 0)))
    names = [f"c{i}" for i in range(len(header))]
    parsed = rows.select(ROW_ORDER, F.from_csv("text", text_schema(names).simpleString()[7:-1].replace(":", " "), {"escape": '"', "maxCharsPerColumn": "-1"}).alias("r"))
    return parsed.select(*[F.col(f"r.{n}").alias(c) for n, c in zip(names, header, strict=True)], ROW_ORDER)


def read_bronze_large(spark: SparkSession, path: str, ds: str, columns: Sequence[str] | None = None) -> DataFrame | None:
    """As ``read_bronze_multi``, with ``ROW_ORDER``, for files that one task should not read alone."""
    groups = header_groups(spark, list_files(spark, f"{path}/*{ds}*.csv"))
    frames = []
    for record, names in groups.items():
        header = column_names(record)
        frame = read_big_csv(spark, names, header)
        if columns is not None:
            frame = frame.select(*(F.col(f"`{c}`") if c in header else F.lit(None).cast("string").alias(c) for c in columns), ROW_ORDER)
        frames.append(frame)
    if frames:
        return union_by_name(frames)
    return None if columns is None else spark.createDataFrame([], text_schema([*columns, ROW_ORDER]))
