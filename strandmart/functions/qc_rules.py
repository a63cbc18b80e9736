"""Sample quality labels.  Inputs are plain columns, outputs total text columns."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandmart.functions.text import as_col, first_rule, number_or_null

MATCH, MISMATCH, NO_DATA = "Match", "Mismatch", "No Data"
PASS, FAIL, INCOMPLETE = "Pass", "Fail", "Incomplete Data"

# Thresholds.
MIN_COVERAGE = 30
MID_COVERAGE = 20
MIN_BREADTH = 85
MID_BREADTH = 80
PROGRESS_BREADTH = 90
SMALL_CRAM = 1e9
ONT_RESEQUENCE = 60000000000
ONT_TOP_UP = 90000000000

# Yield labels.
YIELD_NONE = "No Yield"
YIELD_LOW = "Yield < 60GB"
YIELD_MID = "60GB ≤ Yield < 90GB"
YIELD_HIGH = "High Yield"

# Reasons.  First row that fits wins; "*" fits anything.
# (coverage, batch, pair, sex missing, ploidy missing, reason)
ANY = "*"
REASONS = [
    ("Pass", "Pass", "Match", ANY, ANY, "Pass"),
    ("Pass", ANY, "Mismatch", ANY, ANY, "Fail (Sex Check)"),
    ("Fail", ANY, "Mismatch", ANY, ANY, "Fail (Coverage QC and Sex Check)"),
    (ANY, ANY, "Mismatch", ANY, ANY, "Fail (Sex Check), Incomplete Data (No Coverage Data)"),
    ("Pass", "Fail", "Match", ANY, ANY, "Fail (Batch Sex Check)"),
    ("Pass", "Fail", ANY, True, True, "Fail (Batch Sex QC), Incomplete Data (No Sex Data)"),
    ("Pass", "Fail", ANY, True, ANY, "Fail (Batch Sex Check), Incomplete Data (No Registry Sex Data)"),
    ("Pass", "Fail", ANY, ANY, ANY, "Fail (Batch Sex Check), Incomplete Data (No Ploidy Sex Data)"),
    ("Pass", "Incomplete Data", "Match", ANY, ANY, "Incomplete Data (Incomplete Batch Check)"),
    ("Pass", ANY, ANY, True, True, "Incomplete Data (No Sex Data)"),
    ("Pass", ANY, ANY, True, ANY, "Incomplete Data (No Registry Sex Data)"),
    ("Pass", ANY, ANY, ANY, True, "Incomplete Data (No Ploidy Data)"),
    ("Pass", "Incomplete Data", ANY, ANY, ANY, "Fail (Sex Check)"),
    ("Pass", ANY, ANY, ANY, ANY, "No Data"),
    ("Fail", "Pass", "Match", ANY, ANY, "Fail (Coverage QC)"),
    ("Fail", "Incomplete Data", "Match", ANY, ANY,
     "Fail (Coverage QC), Incomplete Data (Incomplete Batch Check)"),
    ("Fail", "Fail", ANY, True, True,
     "Fail (Coverage and Batch Sex Check), Incomplete Data (No Sex Data)"),
    ("Fail", "Fail", ANY, True, ANY,
     "Fail (Coverage and Batch Sex Check), Incomplete Data (No Registry Sex Data)"),
    ("Fail", "Fail", "Match", ANY, ANY, "Fail (Coverage and Batch Sex Check)"),
    ("Fail", "Fail", ANY, ANY, ANY,
     "Fail (Coverage and Batch Sex Check), Incomplete Data (No Ploidy Data)"),
    ("Fail", ANY, ANY, True, True, "Fail (Coverage QC), Incomplete Data (No Sex Data)"),
    ("Fail", ANY, ANY, False, True, "Fail (Coverage QC), Incomplete Data (No Ploidy Sex Data)"),
    ("Fail", ANY, ANY, True, False, "Fail (Coverage QC), Incomplete Data (No Registry Data)"),
    ("Fail", "Pass", ANY, ANY, ANY, "Fail (Coverage QC and Sex Check)"),
    ("Fail", ANY, ANY, ANY, ANY, "Fail (Coverage QC), Incomplete Data (?)"),
    (ANY, "Fail", "Match", ANY, ANY, "Fail (Batch Sex Check)"),
    (ANY, "Fail", ANY, False, True,
     "Fail (Batch Sex Check), Incomplete Data (No Coverage and Ploidy Data)"),
    (ANY, "Fail", ANY, True, False,
     "Fail (Batch Sex Check), Incomplete Data (No Coverage and Sex Registry Data)"),
    (ANY, "Fail", ANY, True, True,
     "Fail (Batch Sex Check), Incomplete Data (No Coverage and Sex Data)"),
    (ANY, "Fail", ANY, ANY, ANY, "Fail (Batch Sex Check)"),
    (ANY, ANY, ANY, False, False, "Incomplete Data (No Coverage Data)"),
    (ANY, ANY, ANY, False, True, "Incomplete Data (No QC Data)"),
    (ANY, ANY, ANY, True, False, "Incomplete Data (No Registry Sex and Coverage Data)"),
    (ANY, ANY, ANY, True, True, "Incomplete Data (No Registry and QC Data)"),
]


def pair_category(ploidy: Column | str, sex: Column | str) -> Column:
    """Karyotype against registry sex."""
    ploidy, sex = F.upper(as_col(ploidy)), F.upper(as_col(sex))
    agrees = ((ploidy == "XX") & (sex == "FEMALE")) | ((ploidy == "XY") & (sex == "MALE"))
    unknown = sex.isNull() | ploidy.isNull() | ploidy.isin("NAN", "")
    return first_rule([(agrees, MATCH), (unknown, NO_DATA)], F.lit(MISMATCH))


def batch_category(mismatches: Column | str, no_data: Column | str) -> Column:
    """Batch verdict: more than two mismatches fail; up to two doubtful samples pass."""
    mismatches, no_data = as_col(mismatches), as_col(no_data)
    return first_rule(
        [(mismatches > 2, FAIL), (mismatches + no_data < 3, PASS)], F.lit(INCOMPLETE)
    )


def coverage_category(coverage, breadth, cram, cram_size, vcf) -> Column:
    """Pass, Fail (a zero-coverage run that did leave small files) or No Data."""
    coverage, breadth = number_or_null(coverage), number_or_null(breadth)

    def named(c):
        return as_col(c).isNotNull() & (F.lower(as_col(c)) != "nan")

    enough = (coverage >= MIN_COVERAGE) & (breadth >= MIN_BREADTH)
    failed = (number_or_null(cram_size) < SMALL_CRAM) & named(cram) & named(vcf) & (coverage == 0)
    return first_rule([(enough, PASS), (failed, FAIL)], F.lit(NO_DATA))


def coverage_class(coverage, breadth) -> Column:
    coverage, breadth = number_or_null(coverage), number_or_null(breadth)
    return first_rule(
        [
            ((coverage >= MIN_COVERAGE) & (breadth >= MIN_BREADTH), "High Coverage"),
            ((coverage >= MID_COVERAGE) & (breadth >= MID_BREADTH), "Mid Coverage"),
            ((coverage > 0) | (breadth > 0), "Low Coverage"),
        ],
        F.lit(NO_DATA),
    )


def _zero_or_null(c) -> Column:
    return F.coalesce(number_or_null(c), F.lit(0.0)) == 0


def coverage_missing(coverage, breadth) -> Column:
    return _zero_or_null(coverage) & _zero_or_null(breadth)


def text_missing(c) -> Column:
    return F.coalesce(as_col(c), F.lit("")) == ""


def ont_yield_status(sequencer, bases) -> Column:
    bases = number_or_null(bases)
    label = first_rule(
        [
            (F.coalesce(bases, F.lit(0.0)) == 0, YIELD_NONE),
            (bases < ONT_RESEQUENCE, YIELD_LOW),
            (bases < ONT_TOP_UP, YIELD_MID),
        ],
        F.lit(YIELD_HIGH),
    )
    return F.when(as_col(sequencer) == "ONT", label).otherwise("")


# --- labels that depend on the state only ---------------------------------
#
# A sample's state is one of 216: coverage, batch and pair verdict, and three
# missing flags.  A label is a literal array indexed by the state number, so the
# executors do one lookup instead of a long chain of text comparisons.

COVERAGES, BATCHES, PAIRINGS = (PASS, FAIL, NO_DATA), (PASS, FAIL, INCOMPLETE), (MATCH, MISMATCH, NO_DATA)
STATES = list(product(COVERAGES, BATCHES, PAIRINGS, (False, True), (False, True), (False, True)))


def qc_state(coverage_cat, batch_cat, pair_cat, no_coverage, no_sex, no_ploidy) -> Column:
    """Number of the state, in the order of ``STATES``."""
    number = F.lit(0)
    for c, values in ((coverage_cat, COVERAGES), (batch_cat, BATCHES), (pair_cat, PAIRINGS)):
        place = F.when(as_col(c) == values[0], 0).when(as_col(c) == values[1], 1).otherwise(2)
        number = number * 3 + place
    for c in (no_coverage, no_sex, no_ploidy):
        number = number * 2 + as_col(c).cast("int")
    return number


def _by_state(state, rule) -> Column:
    return F.get(F.array(*[F.lit(rule(*s)) for s in STATES]), as_col(state))


def _bad(cov, batch, pair) -> bool:
    return pair == MISMATCH or FAIL in (batch, cov)


def _good(cov, batch, pair) -> bool:
    return (cov, batch, pair) == (PASS, PASS, MATCH)


def strict_status(state) -> Column:
    def rule(cov, batch, pair, *_):
        return FAIL if _bad(cov, batch, pair) else PASS if _good(cov, batch, pair) else INCOMPLETE

    return _by_state(state, rule)


def strict_progress(state) -> Column:
    def rule(cov, batch, pair, no_coverage, no_sex, no_ploidy):
        if _bad(cov, batch, pair):
            return FAIL
        if _good(cov, batch, pair):
            return PASS
        lacking = [n for n, lacks in (("Registry", no_sex), ("Analysis", no_coverage or no_ploidy)) if lacks]
        return "Stalled: " + ("/".join(lacking) or "Batch Analysis")

    return _by_state(state, rule)


def strict_reason(state) -> Column:
    def rule(cov, batch, pair, _, no_sex, no_ploidy):
        facts = (cov, batch, pair, no_sex, no_ploidy)
        fits = (r for *wanted, r in REASONS if all(w in (ANY, f) for w, f in zip(wanted, facts)))
        return next(fits, "Unidentified")

    return _by_state(state, rule)


def strict_diagnosis(state) -> Column:
    def rule(cov, batch, pair, *missing):
        if _good(cov, batch, pair):
            return PASS
        # Checks that failed; a failed batch counts beside a bad coverage only for a sample that matches.
        sex = pair == MISMATCH
        whole = batch == FAIL and not sex and not (cov == FAIL and pair == NO_DATA)
        failed = {
            (True, True, False): "Coverage and Sex Check",
            (True, False, True): "Coverage and Batch Sex Check",
            (True, False, False): "Coverage QC",
            (False, True, False): "Sex Check",
            (False, False, True): "Batch Sex Check",
        }.get((cov == FAIL, sex, whole))
        if failed:
            return f"{FAIL} ({failed})"
        return INCOMPLETE if cov == PASS or any(missing) else "Undefined"

    return _by_state(state, rule)


def strict_color(coverage_cat, batch_cat, pair_cat, yield_status, sequencer, coverage) -> Column:
    cov, batch, pair = as_col(coverage_cat), as_col(batch_cat), as_col(pair_cat)
    yields = as_col(yield_status)
    clean = (batch == PASS) & (pair == MATCH)
    hopeless = (as_col(sequencer) == "Illumina") & (number_or_null(coverage) < MID_COVERAGE)
    return first_rule(
        [
            ((pair == MISMATCH) | (batch == FAIL), "Blacklisted"),
            ((cov == PASS) & clean, "Whitelisted"),
            (cov == PASS, "Graylisted"),
            (yields == YIELD_MID, "Top Up List"),
            (yields == YIELD_LOW, "Blacklisted"),
            ((cov == FAIL) & clean & hopeless, "Blacklisted"),
            ((cov == FAIL) & clean, "Top Up List"),
        ],
        F.lit("Graylisted"),
    )


def progress(sequencer, bases, run_name, coverage, breadth, batch_cat) -> Column:
    thin = (number_or_null(coverage) < MIN_COVERAGE) | (number_or_null(breadth) < PROGRESS_BREADTH)
    return first_rule(
        [
            ((as_col(sequencer) == "ONT") & (number_or_null(bases) < ONT_TOP_UP),
             "Primary Analyzed - Top Up"),
            (as_col(run_name).isNull(), "Primary Analyzed"),
            (thin & (as_col(batch_cat) == PASS), "Secondary Analyzed - Top Up"),
        ],
        F.lit("Secondary Analyzed"),
    )


def coverage_tier(batch_cat, pair_cat, cov_class) -> Column:
    batch, pair, level = as_col(batch_cat), as_col(pair_cat), as_col(cov_class)
    clean = (batch == PASS) & (pair == MATCH)
    return first_rule(
        [
            (clean & (level == "High Coverage"), "High Pass"),
            (clean & (level == "Mid Coverage"), "Mid Pass"),
            (clean & (level == "Low Coverage"), "Low Pass"),
            ((pair == MISMATCH) | (batch == FAIL), FAIL),
        ],
        F.lit(NO_DATA),
    )


def add_qc_labels(df):
    """All labels from the unified sample columns plus ``batch_sex_category``."""
    df = df.withColumns(
        {
            "coverage_category": coverage_category(
                "coverage", "at_least_10x", "cram", "cram_size", "vcf"
            ),
            "coverage_class": coverage_class("coverage", "at_least_10x"),
            "coverage_missing": coverage_missing("coverage", "at_least_10x"),
            "sex_missing": text_missing("sex"),
            "ploidy_missing": text_missing("ploidy_estimation"),
            "ont_yield_status": ont_yield_status("sequencer", "sum_of_total_passed_bases"),
        }
    )
    verdict = ("coverage_category", "batch_sex_category", "sex_ploidy_category")
    state = qc_state(*verdict, "coverage_missing", "sex_missing", "ploidy_missing")
    df = df.withColumn("_state", state)
    return df.withColumns(
        {
            "qc_strict_status": strict_status("_state"),
            "qc_strict_progress": strict_progress("_state"),
            "qc_strict_color": strict_color(*verdict, "ont_yield_status", "sequencer", "coverage"),
            "qc_strict_reason": strict_reason("_state"),
            "qc_strict_diagnosis": strict_diagnosis("_state"),
            "progress": progress(
                "sequencer", "sum_of_total_passed_bases", "run_name", "coverage",
                "at_least_10x", "batch_sex_category",
            ),
            "qc_coverage_tier": coverage_tier(*verdict[1:], "coverage_class"),
        }
    ).drop("_state")
