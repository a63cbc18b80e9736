"""Laboratory sheet rows with registry state and duplicate mark."""

from pyspark.sql import functions as F

from strandmart.functions.rules import registry_status
from strandmart.operators.joins import left_on
from strandmart.plans.steps import numbered

SHEET = (
    "platform extraction_status libprep_status sequencing_finish_date sequencing_status volume_remain "
    "delivery_date extraction_date"
).split()


def run(tables):
    rows = left_on(
        tables["sheets_sequencing"].select("code_repository", *SHEET), tables["staging_fix_ski_id_repo"],
        {"code_repository": "new_origin_code_repository"}, {"code_repository": "_alias"},
    )
    rows = rows.withColumn("code_repository", F.coalesce("_alias", "code_repository")).drop("_alias")
    rows = left_on(
        rows, tables["staging_simbiox_biosamples_patients"], {"code_repository": "code_repository"},
        ["id_subject", "origin_code_repository"],
    )
    for i, registry in enumerate(("regina_demography", "phenovar_participants")):
        rows = left_on(rows, tables[registry], {"id_subject": "id_subject"}, {"id_subject": f"_id{i}"})
    rows = rows.withColumn("registry_status", registry_status("_id0", "_id1")).drop("_id0", "_id1")

    # The first row of a code is a map-side combined minimum, ties by all columns and then by the row's number.
    columns = rows.columns
    rows = numbered(tables, "sheet_rows", rows)
    keys, order = ["platform", "origin_code_repository"], ["extraction_status", "extraction_date"]
    # Rows without an origin code are never duplicates, so they skip the ranking.
    coded = rows.filter(F.col("origin_code_repository").isNotNull())
    plain = rows.filter(F.col("origin_code_repository").isNull()).drop("_row")
    place = F.struct(*order, *[c for c in columns if c not in (*keys, *order)], "_row")
    firsts = coded.groupBy(*keys).agg(F.min(place).getField("_row").alias("_first")).select(F.col("_first"))
    out = coded.join(firsts, F.col("_row") == F.col("_first"), "left")
    out = out.withColumn("duplicate_origin_code_repo_status", F.when(F.col("_first").isNull(), "Duplicate"))
    out = out.drop("_row", "_first").unionByName(plain.withColumn("duplicate_origin_code_repo_status", F.lit(None).cast("string")))
    return out.select(
        "platform", "code_repository", *SHEET[1:], "registry_status", "id_subject", "origin_code_repository",
        "duplicate_origin_code_repo_status",
    )
