"""Laboratory sheets: columns by position, one specification per sheet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmart.functions.dates import parse_any, parse_first
from strandmart.operators.shape import union_padded

SHEET_SCHEMA = {
    "code_repository": "string",
    "platform": "string",
    "volume_remain": "double",
    "delivery_date": "timestamp",
    "extraction_date": "timestamp",
    "extraction_status": "string",
    "libprep_status": "string",
    "sequencing_start_date": "timestamp",
    "sequencing_finish_date": "timestamp",
    "sequencing_status": "string",
}
DATES = ("delivery_date", "extraction_date", "sequencing_start_date", "sequencing_finish_date")


@dataclass(frozen=True)
class SheetSpec:
    """Positions (from 0) of the known fields, and date formats (``None``: any ISO form)."""

    platform: str
    positions: Mapping[str, int]
    formats: Mapping[str, str | None] = field(default_factory=dict)
    volume: float | None = None


def _fields(code, volume, delivery, extraction, ext_status, lib_status, start, finish, status):
    named = {
        "code_repository": code, "volume_remain": volume, "delivery_date": delivery,
        "extraction_date": extraction, "extraction_status": ext_status, "libprep_status": lib_status,
        "sequencing_start_date": start, "sequencing_finish_date": finish, "sequencing_status": status,
    }
    return {k: v for k, v in named.items() if v is not None}


DASHED, SLASHED, COMPACT = "yyyy-MM-dd", "yyyy/MM/dd", "yyMMdd"
# The six sheets.
SHEETS = {
    "illumina_2024": SheetSpec(
        "ILLUMINA", _fields(4, None, 10, 16, 26, 52, None, None, 75),
        {"delivery_date": DASHED, "extraction_date": DASHED}, volume=0.0,
    ),
    "illumina_2025": SheetSpec(
        "ILLUMINA", _fields(5, 9, 10, 15, 24, 50, 70, 71, 73),
        {"delivery_date": DASHED, "extraction_date": SLASHED,
         "sequencing_start_date": SLASHED, "sequencing_finish_date": SLASHED},
    ),
    "ont": SheetSpec(
        "ONT", _fields(2, 7, 6, 13, 27, 66, 71, 72, 73), dict.fromkeys(DATES, COMPACT)
    ),
    "mgi_2024": SheetSpec(
        "MGI", _fields(2, 7, None, 11, 26, 46, 68, 69, 78),
        {"extraction_date": "yyMMdd;HH:mm", "sequencing_start_date": None, "sequencing_finish_date": None},
    ),
    "mgi_2025": SheetSpec(
        "MGI", _fields(4, 8, None, 10, 23, 40, 58, 59, 61),
        {"extraction_date": "yyMMdd; HH:mm", "sequencing_start_date": None, "sequencing_finish_date": None},
    ),
    "mgi_2025_from_ont": SheetSpec(
        "MGI", _fields(4, 8, None, 10, 23, 40, 59, 60, 62),
        {"extraction_date": "yyMMdd; HH:mm", "sequencing_start_date": None, "sequencing_finish_date": None},
    ),
}


def _typed(name: str, c: Column, spec: SheetSpec) -> Column:
    if name in DATES:
        fmt = spec.formats.get(name)
        return parse_any(c) if fmt is None else parse_first(c, fmt)
    return c.try_cast("double") if name == "volume_remain" else c


def read_sheet(df: DataFrame, spec: SheetSpec) -> DataFrame:
    """Known fields of one sheet, by position; rows without a code are dropped."""
    columns = df.columns
    out = df.select(
        *[_typed(n, F.col(f"`{columns[i]}`"), spec).alias(n) for n, i in spec.positions.items()],
        F.lit(spec.platform).alias("platform"),
    )
    if spec.volume is not None:
        out = out.withColumn("volume_remain", F.lit(spec.volume))
    return out.filter(F.col("code_repository").isNotNull())


def sheets_union(sheets: Sequence[tuple[DataFrame, SheetSpec]]) -> DataFrame:
    """All sheets on one schema; dots of a code become underscores."""
    frames = [read_sheet(df, spec) for df, spec in sheets]
    return union_padded(frames, SHEET_SCHEMA).withColumn(
        "code_repository", F.replace("code_repository", F.lit("."), F.lit("_"))
    )
