"""Date parsing and arithmetic; unparsable text becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandmart.functions.text import as_col

DAYS_PER_YEAR = 365.25
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _parse(c: Column, fmt: str) -> Column:
    parsed = F.try_to_timestamp(c, F.lit(fmt))
    if "yy" not in fmt or "yyyy" in fmt:
        return parsed
    # Two-digit years 69-99 belong to the 1900s; the formatter puts all into the 2000s.
    return F.when(F.year(parsed) >= 2069, parsed - F.expr("INTERVAL 100 YEAR")).otherwise(parsed)


def parse_first(c: Column | str, *formats: str) -> Column:
    """First format that parses."""
    c = as_col(c)
    return F.coalesce(*[_parse(c, fmt) for fmt in formats])


def parse_day(c: Column | str, *formats: str) -> Column:
    return parse_first(c, *formats).cast("date")


def parse_any(c: Column | str) -> Column:
    """ISO-like text of any precision and offset."""
    return as_col(c).try_cast("timestamp")


def parse_nanos(c: Column | str) -> Column:
    """UTC timestamp text with up to nine fraction digits, or a bare date."""
    c = as_col(c)
    return F.regexp_replace(c, r"(\.\d{6})\d{1,3}Z$", "$1Z").try_cast("timestamp")


def age_years(birth: Column | str, at: Column | str) -> Column:
    """Whole years by 365.25-day years, never negative, null kept."""
    years = F.floor(F.datediff(as_col(at), as_col(birth)) / F.lit(DAYS_PER_YEAR))
    return F.when(years < 0, F.lit(0).cast("bigint")).otherwise(years)


def calendar_years(start: Column | str, end: Column | str) -> Column:
    """Completed calendar years between two dates."""
    return F.timestamp_diff("YEAR", as_col(start), as_col(end))


def month_name(c: Column | str) -> Column:
    return F.date_format(as_col(c), "MMMM")


def iso_text(c: Column | str) -> Column:
    return F.date_format(as_col(c), ISO_MICROS)


def fix_birth_century(c: Column | str) -> Column:
    """One known mistyped birth date."""
    c = as_col(c).try_cast("date")
    return F.when(c == F.lit("0976-05-19").cast("date"), F.lit("1976-05-19").cast("date")).otherwise(c)
