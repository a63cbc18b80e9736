"""Dated raw files.  Everything is read as text; types come later, by ``try_cast``."""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from strandmart.functions.json_text import is_json, repair_quotes
from strandmart.operators.shape import union_by_name

ROW_ORDER = "_row_order"


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(jvm_path)
    return found is not None and len(found) > 0


def _csv(spark: SparkSession, multi_line: bool = True):
    """Reader of CSV with a header.

    Without ``multi_line`` large files are split over tasks, but no field may hold a line break; ``big_csv`` splits such files too.
    """
    return (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
    )


def with_row_order(df: DataFrame) -> DataFrame:
    """File position of each row, to let the last row of a batch win."""
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select("*", place.alias(ROW_ORDER))


def read_bronze(spark: SparkSession, path: str, ds: str, columns: Sequence[str], multi_line: bool = True) -> DataFrame:
    """The file of one date, columns by name; an absent file is an empty frame."""
    return _read_glob(spark, f"{path}/{ds}.csv", columns, multi_line)


#: Lines of a file's beginning in which its header is looked for first; twice as many each time while a field is still open.
HEADER_LINES = 64


def column_names(header: str) -> tuple[str, ...]:
    """Names of a header record: a repeated name gets ``.1``, ``.2`` …, an empty one its place."""
    names: list[str] = []
    for i, name in enumerate(next(csv.reader(io.StringIO(header, newline="")), ())):
        name = name or f"Unnamed: {i}"
        free, k = name, 0
        while free in names:
            k += 1
            free = f"{name}.{k}"
        names.append(free)
    return tuple(names)


def header_groups(spark: SparkSession, files: Sequence[str]) -> dict[str, list[str]]:
    """Files grouped by their header record, found in a distributed pass; a quoted name may go over several lines."""
    if not files:
        return {}
    lines = spark.read.option("lineSep", "\n").text(list(files)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).filter("block = 0")
    heads = lines.groupBy("file").agg(F.min(F.struct("row", "value")).alias("first")).select("file", "first.*")
    is_whole = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 0
    clean = F.rtrim(F.ltrim(F.col("value"), F.lit("\ufeff")), F.lit("\r")).alias("header")
    grouped = heads.select("file", "row", is_whole.alias("whole"), clean).groupBy("header", "whole").agg(F.sort_array(F.collect_list("file")).alias("files"))
    found: dict[str, list[str]] = {}
    open_files = []
    for row in sorted(grouped.collect(), key=lambda r: r["files"]):  # one row for each distinct header
        if row["whole"]:
            found.setdefault(row["header"], []).extend(row["files"])
        else:
            open_files += row["files"]
    reach = HEADER_LINES
    while open_files:
        first = heads.filter(F.col("file").isin(open_files)).select(F.col("file").alias("f"), F.col("row").alias("from"))
        near = lines.join(first, F.col("file") == F.col("f")).filter(F.col("row") < F.col("from") + reach)
        texts = near.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("row", "value")))["value"].alias("lines")).collect()
        open_files = []
        for row in texts:  # ``reach`` lines of each of the few files whose first line ends inside a name
            quotes = list(accumulate(line.count('"') for line in row["lines"]))
            end = next((k for k, n in enumerate(quotes) if n % 2 == 0), None)
            if end is None and len(row["lines"]) == reach:
                open_files.append(row["file"])
            else:
                header = "\n".join(row["lines"][: len(quotes) if end is None else end + 1])
                found.setdefault(header.lstrip("\ufeff").rstrip("\r"), []).append(row["file"])
        reach *= 2
    return {header: sorted(names) for header, names in found.items() if column_names(header)}


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(jvm_path)
    return sorted(str(s.getPath()) for s in found if s.getLen() > 0) if found else []


def read_bronze_multi(
    spark: SparkSession, path: str, ds: str, columns: Sequence[str] | None = None, multi_line: bool = True
) -> DataFrame | None:
    """All files with the date in their name, concatenated by column name.

    Files are grouped by header, one scan for each distinct one.  With ``columns``
    only these come back, null in files that lack them.
    """
    return _read_glob(spark, f"{path}/*{ds}*.csv", columns, multi_line)


def read_bronze_all(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, multi_line: bool = True
) -> DataFrame | None:
    """Every file of the folder as text; empty files are skipped."""
    return _read_glob(spark, f"{path}/*.csv", columns, multi_line)


def _read_glob(spark: SparkSession, pattern: str, columns: Sequence[str] | None, multi_line: bool) -> DataFrame | None:
    files = list_files(spark, pattern)
    groups = header_groups(spark, files)
    if not groups:
        return None if columns is None else spark.createDataFrame([], text_schema(columns))
    frames = []
    for record, names in groups.items():
        header = column_names(record)
        frame = _csv(spark, multi_line or "\n" in record).schema(text_schema(header)).csv(names)
        if columns is not None and tuple(columns) != header:
            frame = frame.select(*(F.col(f"`{c}`") if c in header else F.lit(None).cast("string").alias(c) for c in columns))
        # of several scans the file of a row must be a column of its own: a union has no file metadata
        frames.append(frame if len(groups) == 1 else frame.select("*", "_metadata"))
    return frames[0] if len(frames) == 1 else union_by_name(frames)


def date_of_file(df: DataFrame) -> DataFrame:
    """``ds`` column from the file name."""
    name = F.col("_metadata.file_name")
    return df.select("*", F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1).cast("date").alias("ds"))


def flatten_records(df: DataFrame, column: str, ddl: str, prefix: str = "") -> DataFrame:
    """Nested record text to columns ``<prefix><field>``; Python-literal text is accepted."""
    text = F.when(is_json(column), F.col(column)).otherwise(repair_quotes(column))
    out = df.withColumn("_rec", F.from_json(text, ddl))
    names = out.schema["_rec"].dataType.names
    return out.select(*df.columns, *[F.col(f"_rec.`{n}`").alias(f"{prefix}{n}") for n in names])


def head_names(df: DataFrame) -> DataFrame:
    """Dotted column names cut to their head (``id.S`` becomes ``id``)."""
    renamed = {c: c.split(".")[0] for c in df.columns if "." in c}
    return df.select(*[F.col(f"`{c}`").alias(renamed.get(c, c)) for c in df.columns])


def merge_latest(df: DataFrame, out_root: str, ds: str) -> DataFrame:
    """Distinct union of all correction files as a dated copy and as ``latest``.

    The dated copy is written once; ``latest`` is copied from it, so a lost
    executor never leaves the two different.
    """
    spark = df.sparkSession
    dated = f"{out_root}/{ds}"
    df.distinct().write.mode("overwrite").option("header", True).csv(dated)
    written = spark.read.option("header", True).csv(dated)
    written.write.mode("overwrite").option("header", True).csv(f"{out_root}/latest")
    return written


# Kinds of a correction.
FIX_TYPES = ("id_repository", "id_library", "id_zlims_index", "cram", "vcf")


def corrections_by_kind(df: DataFrame) -> DataFrame:
    """Correction records of the five known kinds, key columns first."""
    first = ["id", "id_repository", "time_requested"]
    rest = [c for c in df.columns if c not in first]
    return df.filter(F.col("fix_type").isin(*FIX_TYPES)).select(*first, *rest)


def write_by_kind(df: DataFrame, out_root: str) -> None:
    """One output folder per kind of correction."""
    corrections_by_kind(df).write.mode("overwrite").partitionBy("fix_type").option("header", True).csv(out_root)


def delta_window(df: DataFrame, ts, modified: str, created: str, days: int = 1) -> DataFrame:
    """Rows modified or created within the last ``days`` up to ``ts``."""
    upper = F.lit(ts)
    lower = upper - F.make_dt_interval(F.lit(days))
    return df.filter(F.col(modified).between(lower, upper) | F.col(created).between(lower, upper))


def since(df: DataFrame, column: str, ds) -> DataFrame:
    """Rows at or after the cut-off; a literal bound, so it reaches the scan."""
    return df.filter(F.col(column) >= F.lit(ds))


