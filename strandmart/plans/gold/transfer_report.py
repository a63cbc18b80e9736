"""Transfers with visit category, age and a duplicate-free origin code."""

from pyspark.sql import functions as F

from strandmart.functions import rules
from strandmart.functions.dates import age_years, fix_birth_century, month_name
from strandmart.operators.joins import left_on, lookup
from strandmart.operators.shape import union_padded
from strandmart.plans.steps import once
from strandmart.plans.staging.biobank_samples import visit_categories
from strandmart.plans.staging.transfers import COLUMNS

DATES = ("formulir", "pengiriman", "penerimaan")
SCHEMA = {c: "string" for c in COLUMNS} | {
    "tanggal_formulir": "date", "tanggal_pengiriman": "date", "tanggal_penerimaan": "date",
    "tujuan_is_biobank": "int", "is_to_central_seq": "int",
    "code_repository": "string", "origin_code_repository": "string", "id_subject": "string",
    "patient_biobank": "string", "patient_categ": "string", "registry_sex": "string",
    "age_at_recruitment": "bigint",
    **{f"year_{d}": "int" for d in DATES}, **{f"month_{d}": "string" for d in DATES},
    "origin_code_repository_non_dup": "string",
}
# The form that stands for survey samples handed over before the transfer system.
SURVEY_DAY = "2025-05-19"
SURVEY_FORM = {
    "id": "backdoor_form_id_1", "nomor_formulir": "Backdoor_toCentral_SKI/2025/01",
    "biobank_asal": "Biobank Sentral (BB Binomika)", "biobank_tujuan": "Biobank Sentral (BB Binomika)",
    "keterangan_pengiriman": "OK", "status_pengiriman": "Dikirim", "petugas_pengirim": "Backdoor",
    "keterangan_penerimaan": "OK", "status_penerimaan": "OK", "petugas_penerima": "Backdoor",
    "status_transfer_name": "Dikirim",
}


TAKEN = ("id_subject", "patient_biobank", "registry_sex", "age_at_recruitment", "patient_categ")


def people(tables):
    """Sex and age at recruitment of both registries."""
    a = tables["decrypt_regina"].select(
        "id_subject", F.col("birthdate").cast("date").alias("birth_date"),
        rules.sex_from_word("gender").alias("registry_sex"), F.col("creationDate").alias("creation_date"),
    )
    b = tables["decrypted_phenovar_participants"].select(
        "id_subject", fix_birth_century("birth_date").alias("birth_date"), F.upper("sex").alias("registry_sex"),
        F.col("created_at").alias("creation_date"),
    )
    both = a.unionByName(b)
    return both.select("id_subject", "registry_sex", age_years("birth_date", "creation_date").alias("age_at_recruitment"))


def samples(tables):
    """Samples with patient, biobank, registry data and visit category: a step, as transfers and survey samples both read it.

    Samples are joined to their patients before the transfers, whose wide rows are then shuffled once for all of it.
    """
    rows = tables["simbiox_patients"].select(F.col("id_patient").alias("_patient"), "id_subject", F.col("id_biobank").alias("_biobank"))
    rows = lookup(rows, tables["master_biobank"], {"_biobank": "id_biobank"}, {"biobank_nama": "patient_biobank"})
    rows = left_on(rows, people(tables), {"id_subject": "id_subject"}, ["registry_sex", "age_at_recruitment"])
    rows = left_on(rows, visit_categories(tables), {"_patient": "px_id"}, ["patient_categ"])
    own = tables["simbiox_biosamples"].select("id", "code_repository", "origin_code_repository", "id_patient")
    return once(tables, "samples", left_on(own, rows, {"id_patient": "_patient"}, TAKEN).drop("id_patient"))


def transfers(tables):
    rows = tables["staging_simbiox_transfer"].filter(F.col("biobank_asal") != "Biobank Pusat")
    rows = left_on(rows, samples(tables), {"biosample_id": "id"}, ["code_repository", "origin_code_repository", *TAKEN])
    return rows.withColumns(
        {f"year_{d}": F.year(f"tanggal_{d}") for d in DATES}
        | {f"month_{d}": month_name(f"tanggal_{d}") for d in DATES}
    )


def first_origin(rows):
    """Origin code of sent central transfers, only where it is sent for the first time.

    Dense rank 1 means the smallest form date of the code, a missing date first:
    a map-side combined minimum instead of a window over the code.
    """
    sent = rows.filter((F.col("is_to_central_seq") == 1) & (F.col("status_transfer_name") == "Dikirim"))
    sent = sent.select("biosample_id", "id", "origin_code_repository", "tanggal_formulir")
    coded = sent.filter(F.col("origin_code_repository").isNotNull())
    firsts = coded.groupBy("origin_code_repository").agg(F.min(F.struct("tanggal_formulir")).alias("_first"))
    marked = left_on(sent, firsts, {"origin_code_repository": "origin_code_repository"}, ["_first"])
    is_first = F.struct("tanggal_formulir") == F.col("_first")
    return marked.select(
        "biosample_id", "id", F.when(is_first, F.col("origin_code_repository")).alias("origin_code_repository_non_dup")
    )


def survey_rows(tables):
    rows = samples(tables).filter(
        F.col("origin_code_repository").ilike("SKI%") | F.col("code_repository").ilike("SKI%")
    ).withColumnRenamed("id", "biosample_id")
    day = F.lit(SURVEY_DAY).cast("date")
    return rows.withColumns(
        {c: F.lit(v) for c, v in SURVEY_FORM.items()}
        | {f"tanggal_{d}": day for d in DATES}
        | {f"year_{d}": F.year(day) for d in DATES}
        | {f"month_{d}": month_name(day) for d in DATES}
        | {"tujuan_is_biobank": F.lit(1), "is_to_central_seq": F.lit(0), "patient_categ": F.lit("Control")}
    )


def run(tables):
    rows = once(tables, "transfers", transfers(tables))
    rows = left_on(
        rows, first_origin(rows), {"biosample_id": "biosample_id", "id": "id"}, ["origin_code_repository_non_dup"]
    )
    return union_padded([rows, survey_rows(tables)], SCHEMA)
