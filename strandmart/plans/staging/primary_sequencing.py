"""One primary-sequencing row per sample over the three platforms."""

from pyspark.sql import functions as F

from strandmart.functions.json_text import newest_of_list
from strandmart.functions.text import NO_LIBRARY, TRIAL_WORDS_ONT, clean_sample_id, is_trial, library_from_tags, regexp_or_null
from strandmart.operators.joins import anti_null_safe, anti_on, left_on
from strandmart.operators.ranking import latest_by
from strandmart.operators.shape import union_padded

SCHEMA = {
    "id_repository": "string", "id_library": "string", "sequencer": "string", "date_primary": "timestamp",
    "sum_of_total_passed_bases": "string", "sum_of_bam_size": "string", "id_index": "double",
}
# First day of the sheet system, and ids that are left out of the second MGI source.
FIRST_DAY = "2023-11-01"
SECOND_SOURCE_TRIALS = "(?i)test|AshkenazimTrio"


def _library_or_null():
    return F.nullif("id_library", F.lit(NO_LIBRARY)).alias("id_library")


def _kind(value, column):
    return F.max(F.when(F.col("fix_type") == value, F.col(column))).alias(column)


def _mgi_fixes(tables):
    fixes = tables["dynamodb_fix_samples"].filter(
        (F.col("sequencer") == "MGI") & ~F.col("id_requestor").rlike("(?i)test")
    )
    fixes = fixes.select(
        "id_repository", "id_library", "new_repository", "new_library", "new_index", "fix_type", "time_requested"
    )
    keys = ["id_repository", "new_repository", "new_library", "new_index", "fix_type"]
    newest = latest_by(fixes, keys, ["time_requested"])
    return newest.groupBy("id_repository", _library_or_null()).agg(
        _kind("id_repository", "new_repository"), _kind("id_library", "new_library"), _kind("id_zlims_index", "new_index")
    )


FIX_NAMES = {"new_repository": "_new_id", "new_library": "_new_library", "new_index": "_new_index"}


def _mgi_row(date):
    return [
        F.coalesce("_new_id", "id_repository").alias("id_repository"),
        F.coalesce("_new_library", "id_library").alias("id_library"),
        F.lit("MGI").alias("sequencer"), F.col(date).alias("date_primary"),
        F.coalesce(F.col("_new_index").try_cast("double"), F.col("id_index").try_cast("double")).alias("id_index"),
    ]


def _mgi(tables):
    fixes = _mgi_fixes(tables)
    sheet = tables["zlims_samples"].filter(F.col("date_create") >= FIRST_DAY).select(
        "id_repository", F.col("id_flowcell").alias("id_library"), "date_create", "id_index"
    )
    sheet = left_on(sheet, fixes, {"id_repository": "id_repository"}, FIX_NAMES).select(*_mgi_row("date_create"))

    second = tables["ztronpro_samples"]
    code = regexp_or_null("original_sample_id", "[^_]+")
    rebuilt = second.filter(
        F.col("original_sample_id").rlike("(?i)_hg38") & ~F.col("original_sample_id").ilike("Ashkenazim%")
    ).select(code.alias("code"))
    kept = second.filter(
        (F.col("sample_progress") == "Completed") & ~F.col("original_sample_id").rlike(SECOND_SOURCE_TRIALS)
    )
    kept = anti_null_safe(kept, rebuilt, "original_sample_id", "code").select(
        code.alias("id_repository"), F.col("flow_cell_id").alias("id_library"), "creation_time",
        F.nullif("barcode", F.lit("")).alias("id_index"),
    )
    kept = left_on(
        kept, fixes, {"id_repository": "id_repository", "id_library": "id_library"}, FIX_NAMES
    ).select(*_mgi_row("creation_time"))
    # The newest row per source and then over both is the newest over both.
    both = sheet.unionByName(kept)
    return latest_by(both, ["id_repository"], ["date_primary"])


def _illumina(tables):
    samples = tables["ica_samples"].filter(~is_trial("id_repository") & (F.col("status") != "DELETED"))
    samples = anti_on(samples, tables["ski_exclusion"], "id_repository", "origin_code_repository")
    samples = samples.select(
        clean_sample_id("id_repository").alias("clean_id"),
        library_from_tags("sample_list_technical_tags", "tag_user_tags").alias("id_library"),
        F.col("time_modified").alias("date_primary"),
    )
    fixes = tables["dynamodb_fix_samples"].filter(F.col("sequencer") == "Illumina").select(
        "id_repository", "id_library", "fix_type", "new_repository", "new_library", "time_requested"
    )
    newest = latest_by(fixes, ["id_repository", "id_library", "fix_type"], ["time_requested"])
    per_sample = newest.groupBy("id_repository", _library_or_null()).agg(
        _kind("id_repository", "new_repository"), _kind("id_library", "new_library")
    )
    rows = left_on(
        samples, per_sample, {"clean_id": "id_repository"},
        {"new_repository": "_new_id", "new_library": "_new_library"},
    ).select(
        "clean_id", "date_primary",
        F.coalesce("_new_id", "clean_id").alias("id_repository"),
        F.coalesce("_new_library", "id_library").alias("id_library"),
    )
    rows = latest_by(rows, ["clean_id"], ["date_primary"]).drop("clean_id")
    rows = left_on(
        rows, tables["staging_fix_ski_id_repo"], {"id_repository": "new_origin_code_repository"},
        {"code_repository": "_alias"},
    )
    return rows.select(
        F.coalesce("_alias", "id_repository").alias("id_repository"), "id_library",
        F.lit("Illumina").alias("sequencer"), "date_primary",
    )


def _ont(tables):
    samples = tables["wfhv_samples"].filter(~is_trial("id_repository", TRIAL_WORDS_ONT))
    samples = anti_on(samples, tables["samples_exclusion"], "id_repository", "id_repository")
    return samples.select(
        "id_repository", F.col("id_batch").alias("id_library"), F.lit("ONT").alias("sequencer"),
        newest_of_list("processing_stopped").alias("date_primary"),
        "sum_of_total_passed_bases", "sum_of_bam_size",
    )


def run(tables):
    return union_padded([_mgi(tables), _illumina(tables), _ont(tables)], SCHEMA)
