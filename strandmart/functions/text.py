"""Text, id and null helpers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mark trial samples, and the texts that stand for a missing value.
TRIAL_WORDS = "(?i)(demo|test|benchmark|dev)"
TRIAL_WORDS_ONT = "(?i)(demo|test|benchmark|dev|barcode)"
NULL_WORDS = ("", "nan", "nat", "none", "null", "<na>")
ZERO_DATES = ("0000-00-00", "0000-00-00 00:00:00")
NO_LIBRARY = "EMPTY"
LIST_QUOTES = "['\"]"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_null(c: Column | str) -> Column:
    """Empty text, textual NaN and zero dates become null; other text is trimmed of nothing."""
    c = as_col(c)
    return F.when(~F.lower(F.trim(c)).isin(*NULL_WORDS, *ZERO_DATES), c)


def nan_to_null(c: Column | str) -> Column:
    """Text ``nan`` (any case) to null; the empty text is kept."""
    c = as_col(c)
    return F.when(F.lower(c) != "nan", c)


def zero_date_to_null(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(~c.cast("string").isin(*ZERO_DATES), c)


def number_or_null(c: Column | str) -> Column:
    """Text compared with a number: cast, and never let NaN through (NaN >= 30 is true)."""
    value = as_col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(as_col(c), F.lit(""))


def is_trial(c: Column | str, words: str = TRIAL_WORDS) -> Column:
    return as_col(c).rlike(words)


def has_any(c: Column | str, parts: Iterable[str]) -> Column:
    """Case-insensitive LIKE '%part%' over several parts."""
    low = F.lower(as_col(c))
    found = F.lit(False)
    for part in parts:
        found = found | low.contains(part.lower())
    return found


def regexp_or_null(c: Column | str, pattern: str) -> Column:
    """First match or null."""
    return F.regexp_substr(as_col(c), F.lit(pattern))


def capture_or_null(c: Column | str, pattern: str, group: int = 1) -> Column:
    """Captured group or null (``regexp_extract`` alone gives the empty text)."""
    return F.nullif(F.regexp_extract(as_col(c), pattern, group), F.lit(""))


def strip_quotes(c: Column | str) -> Column:
    """Remove quotes anywhere, then outer blanks."""
    return F.trim(F.regexp_replace(as_col(c), LIST_QUOTES, ""))


def unquote(c: Column | str) -> Column:
    """TRIM(BOTH '"')."""
    return F.btrim(as_col(c), F.lit('"'))


def part(c: Column | str, sep_regex: str, index: int) -> Column:
    """1-based (or negative) part of a split; null when absent."""
    return F.try_element_at(F.split(as_col(c), sep_regex), F.lit(index))


def clean_sample_id(c: Column | str) -> Column:
    """Sample id without pipeline or top-up suffix."""
    c = as_col(c)
    return (
        F.when(c.ilike("%dragen%"), regexp_or_null(c, r"\w+"))
        .when(c.ilike("%_m") | c.ilike("%_t"), regexp_or_null(c, "[A-Za-z0-9]+"))
        .otherwise(c)
    )


def batch_from_user_tags(c: Column | str) -> Column:
    """First quoted ``LP…`` tag of a tag list kept as text."""
    return strip_quotes(regexp_or_null(c, "(?i)'LP.+?'"))


def library_from_tags(technical: Column | str, user: Column | str) -> Column:
    """Library of a sample: run-name tag first, then the user tags, ``EMPTY`` means none."""
    run_tag = regexp_or_null(technical, "(?i)'bssh.run.name:LP.* '")
    from_run = regexp_or_null(F.trim(F.regexp_replace(run_tag, "['\",]", "")), "(?i)LP.+")
    return F.nullif(F.coalesce(from_run, batch_from_user_tags(user)), F.lit(NO_LIBRARY))


def recode(c: Column | str, mapping: Mapping[str, str], keep_other: bool = True) -> Column:
    """Dictionary recode; unmapped values are kept, or become null."""
    c = as_col(c)
    out = None
    for old, new in mapping.items():
        out = F.when(c == old, new) if out is None else out.when(c == old, new)
    return out.otherwise(c) if keep_other else out


def first_rule(rules: Sequence[tuple[Column, Column | str | None]], default: Column | None = None) -> Column:
    """Ordered rules, first match wins."""
    out = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out if default is None else out.otherwise(default)


def alias_of_survey_id(c: Column | str) -> Column:
    """``SKI_<digits>`` alias of an origin code that contains SKI."""
    c = as_col(c)
    return F.concat(regexp_or_null(c, "(?i)SKI"), F.lit("_"), regexp_or_null(c, r"\d+"))
