"""Quality rules: a threshold table compiled into one Spark projection.

The measures of a text are built-in array and string expressions, and the table of rules becomes one boolean
column each, so the whole operator is a scan with projections: no shuffle, no user function, and nothing that depends on
another row.  A hot source or a group of copies therefore costs what its rows cost.

Defined results: a null text counts as an empty one (no words, base rule failed); repeated rows are judged one by one; an
empty table gives an empty table; other columns of the input are neither read nor returned.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"

# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in a is that it for was on as with be by this are at from or an "
    "der die das und ist von zu den mit sich des auf für im dem nicht ein eine als auch es an "
    "le la les de des et un une en du que est pour dans qui par sur au pas ne il "
    "el los las y por con para su del se lo no una como más o"
).split()


class Rule(NamedTuple):
    """A text is refused when ``measure`` lies outside ``least`` .. ``most``."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


# Thresholds over the measures named in ``RATIOS``.
RULES = (
    Rule("few_words", "n_words", least=20),
    Rule("repeated_windows", "repeat_word_ratio", most=0.3),
    Rule("word_length", "mean_word_chars", least=2.0, most=15.0),
    Rule("symbols", "symbol_word_ratio", most=0.5),
    Rule("stop_words", "stop_word_ratio", least=0.02),
    Rule("same_lines", "dup_line_ratio", most=0.5),
    Rule("bullets", "bullet_line_ratio", most=0.9),
    Rule("cut_lines", "ellipsis_line_ratio", most=0.5),
)
#: The two rules of the contract; both are exact in integers.
BASE_RULES = ("few_words", "repeated_windows")


def _pairs(values: Column, gap: int) -> Column:
    """Hash of each value with the one ``gap`` places on: windows grow by ``gap``."""
    rest = F.greatest(F.size(values) - gap, F.lit(0))
    return F.zip_with(F.slice(values, 1, rest), F.slice(values, F.lit(gap + 1), rest), lambda a, b: F.xxhash64(a, b))


def _steps(values: Column, step) -> Column:
    """``step`` of each value and the next one."""
    rest = F.greatest(F.size(values) - 1, F.lit(0))
    return F.zip_with(F.slice(values, 1, rest), F.slice(values, F.lit(2), rest), step)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col`` and all measures, counts as long and ratios as double.

    Windows of eight words are compared by a 64-bit hash of their word hashes.  A text without a repeated window ends
    there.  Else the windows are sorted as numbers of (leading hash bits, position), equal neighbours are the repeated
    ones, and their positions in text order give the words they cover.
    """
    one = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    one = one.select(
        id_col, "text",
        F.array_remove(F.split("text", SPACE), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
    )
    stop = [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS if w.capitalize() != w)]
    one = one.select(
        id_col,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("lines", lambda x: x.rlike("^\\s*[-*\u2022]"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("lines", lambda x: x.rlike("(\\.\\.\\.|\u2026)\\s*$"))).cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter("words", lambda w: w.isin(stop))).cast("long").alias("n_stop_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    counts = [c for c in one.columns if c != "hashes"]
    two = one.select(*counts, _pairs(F.col("hashes"), 1).alias("hashes"))
    four = two.select(*counts, _pairs(F.col("hashes"), 2).alias("hashes"))
    eight = four.select(*counts, _pairs(F.col("hashes"), 4).alias("hashes"))
    again = eight.select(
        *counts,
        F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.col("hashes")).alias("hashes"),
        # the bits of a position; all others are the leading bits of a hash
        F.expr("shiftleft(1L, length(bin(size(hashes)))) - 1").alias("low"),
    )
    inner = F.transform(
        "hashes",
        lambda h, i: F.coalesce(h.bitwiseAND(F.bitwise_not(F.col("low"))).bitwiseOR(i.cast("long")), F.lit(0).cast("long")),
    )
    packed = again.select(*counts, "hashes", "low", F.sort_array(inner).alias("packed"))
    same = _steps(
        F.col("packed"),
        lambda a, b: F.get("hashes", a.bitwiseAND(F.col("low")).cast("int"))
        == F.get("hashes", b.bitwiseAND(F.col("low")).cast("int")),
    )
    flagged = packed.select(*counts, "packed", "low", same.alias("same"))
    places = F.transform(
        "packed",
        lambda x, k: F.when(
            F.coalesce(F.get("same", k), F.lit(False)) | F.coalesce(F.get("same", k - 1), F.lit(False)),
            x.bitwiseAND(F.col("low")),
        ),
    )
    placed = flagged.select(*counts, F.sort_array(F.array_compact(places)).alias("places"))
    covered = F.aggregate(
        _steps(F.col("places"), lambda a, b: F.least(b - a, F.lit(WINDOW).cast("long"))),
        F.lit(WINDOW).cast("long"),
        lambda total, x: total + x,
    )
    full = placed.select(*counts, F.when(F.size("places") > 0, covered).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"))
    # One measure row per text comes out of a generator: a filter on a measure then stays above it, where the optimizer
    # would else write the whole chain of arrays into the filter and evaluate it anew for each element.
    full = full.select(id_col, F.explode(F.array(F.struct(*(c for c in full.columns if c != id_col)))).alias("m"))
    full = full.select(id_col, "m.*")
    n_words, n_lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return full.select(
        "*",
        (F.col("n_repeat_words") / n_words).alias("repeat_word_ratio"),
        (F.col("word_chars") / n_words).alias("mean_word_chars"),
        (F.col("n_symbols") / n_words).alias("symbol_word_ratio"),
        (F.col("n_stop_words") / n_words).alias("stop_word_ratio"),
        (F.col("n_dup_lines") / n_lines).alias("dup_line_ratio"),
        (F.col("n_bullet_lines") / n_lines).alias("bullet_line_ratio"),
        (F.col("n_ellipsis_lines") / n_lines).alias("ellipsis_line_ratio"),
    )


def fails(rule: Rule) -> Column:
    """The rule as an expression over the measures; the repetition limit is compared in integers."""
    if rule.name == "repeated_windows":
        return F.lit(100) * F.col("n_repeat_words") > F.lit(round(100 * rule.most)) * F.col("n_words")
    outside = [F.lit(False)]
    if rule.least is not None:
        outside.append(F.col(rule.measure) < F.lit(rule.least))
    if rule.most is not None:
        outside.append(F.col(rule.measure) > F.lit(rule.most))
    return reduce(or_, outside)


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures, ``base_failed``, the first rule that refuses a text (``reason``, else null) and ``kept``."""
    base = reduce(or_, (fails(r) for r in rules if r.name in BASE_RULES), F.lit(False))
    reason = F.coalesce(*(F.when(fails(r), F.lit(r.name)) for r in rules), F.lit(None).cast("string"))
    return measured(docs, id_col, text_col).select("*", base.alias("base_failed"), reason.alias("reason"), reason.isNull().alias("kept"))


def kept_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule refuses, columns as they were; whole rows ride along, so nothing is joined."""
    whole = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return judged(whole, rules, "row", "text").where("kept").select("row.*")
