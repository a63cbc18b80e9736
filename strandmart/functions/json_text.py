"""JSON held as text, and text that is a Python literal instead of JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandmart.functions.text import as_col


# Python constants and their JSON form.
CONSTANTS = (("None", "null"), ("True", "true"), ("False", "false"), ("nan", "null"))
# What mostly stands between strings, and is JSON already.
PLAIN = (": ", ", ", ":", ",", "{", "}", "[", "]", "{}", "[]", ": {", ": [", "}, ", "], ", "}}", "]}")
# A quoted string with either quote, text between strings, or a quote that ends nowhere.
TOKEN = r"""("[^"\\]*+(?:\\.[^"\\]*+)*+"|'[^'\\]*+(?:\\.[^'\\]*+)*+'|[^"']++|["'])"""


def _json_string(token: Column) -> Column:
    """A Python string literal as a JSON string."""
    plain = F.substring(token, F.lit(2), F.length(token) - 2)
    inner = F.replace(plain, F.lit("\\'"), F.lit("'"))
    # after an even number of backslashes: a bare quote, and the two-digit code point that JSON lacks
    inner = F.regexp_replace(inner, r'(?<!\\)((?:\\\\)*+)"', r'$1\\"')
    inner = F.regexp_replace(inner, r"(?<!\\)((?:\\\\)*+)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
    special = plain.contains("\\") | plain.contains('"')
    return F.concat(F.lit('"'), F.when(special, inner).otherwise(plain), F.lit('"'))


def _json_between(token: Column) -> Column:
    """What stands between strings: constants renamed, tuples as lists, no comma before an end."""
    made = token
    for old, new in CONSTANTS:
        made = F.regexp_replace(made, rf"\b{old}\b", new)
    made = F.regexp_replace(F.translate(made, "()", "[]"), r",\s*([\]\}])", "$1")
    return F.when(token.isin(*PLAIN), token).otherwise(made)


def repair_quotes(c: Column | str) -> Column:
    """Python-literal text to JSON text, token by token: what strings hold is never changed, only how it is written."""
    tokens = F.regexp_extract_all(as_col(c), F.lit("(?s)" + TOKEN), F.lit(1))
    is_string = lambda t: (F.length(t) > 1) & (t.startswith("'") | t.startswith('"'))
    return F.array_join(F.transform(tokens, lambda t: F.when(is_string(t), _json_string(t)).otherwise(_json_between(t))), "")


def is_json(c: Column | str) -> Column:
    return F.try_parse_json(as_col(c)).isNotNull()


def to_valid_json(c: Column | str) -> Column:
    """JSON text kept; Python-literal text repaired; anything else quoted; null is ``null``."""
    c = as_col(c)
    trimmed = F.trim(c)
    repaired = repair_quotes(trimmed)
    # to_json quotes and escapes inside a one-element array; the brackets come off.
    wrapped = F.to_json(F.array(trimmed))
    quoted = F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)
    return (
        F.when(c.isNull() | (F.lower(trimmed) == "nan"), F.lit("null"))
        .when(is_json(trimmed), trimmed)
        .when(trimmed.rlike(r"^[\[\{]") & is_json(repaired), repaired)
        .otherwise(quoted)
    )


def json_fields(c: Column | str, ddl: str) -> Column:
    """Parse once into the named fields only."""
    return F.from_json(as_col(c), ddl)


def text_list(c: Column | str) -> Column:
    """List stored as text, with either quote, to an array of text."""
    return F.from_json(repair_quotes(c), "array<string>")


def newest_of_list(c: Column | str) -> Column:
    """Newest timestamp of a list stored as text; bad entries are ignored."""
    return F.array_max(F.transform(text_list(c), lambda x: x.try_cast("timestamp")))


def list_to_json(c: Column | str) -> Column:
    """Array to JSON text, null entries as empty text."""
    return F.to_json(F.transform(as_col(c), lambda x: F.coalesce(x.cast("string"), F.lit(""))))


def sum_ignoring_blanks(c: Column | str) -> Column:
    """Whole-number sum of a text array; blanks and junk count nothing."""
    numbers = F.transform(as_col(c), lambda x: x.try_cast("double").try_cast("bigint"))
    present = F.filter(numbers, lambda x: x.isNotNull())
    return F.aggregate(present, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
