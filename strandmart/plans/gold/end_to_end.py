"""Participants from enrolment over biobank and sequencing to the pharmacogenomic report."""

from pyspark.sql import functions as F

from strandmart.functions import rules
from strandmart.functions.dates import calendar_years
from strandmart.functions.text import regexp_or_null
from strandmart.operators.aggregates import flagged_keys
from strandmart.operators.joins import left_on, lookup
from strandmart.plans.steps import once

PEOPLE = {
    "id_subject": "string", "age_at_recruitment": "bigint", "sex": "string", "hospital_name": "string",
    "nik_province": "string", "enrollment_date": "timestamp",
}


def biobank_samples(tables):
    """Specimen counts and flags per subject and visit category.

    A patient seen both as control and as patient counts in both categories.
    Samples without a subject would be one large group that matches nobody.
    """
    rows = left_on(
        tables["simbiox_biosamples"].select("id_patient", "code_repository", "biosample_specimen"),
        tables["simbiox_patients"], {"id_patient": "id_patient"}, {"id_subject": "id_subject", "id_patient": "_patient"},
    ).filter(F.col("id_subject").isNotNull())
    visits = tables["simbiox_log_visit_biospc"].select(
        "px_id", rules.visit_category("kode_icd").alias("patient_categ")
    ).distinct()
    rows = left_on(rows, visits, {"_patient": "px_id"}, ["patient_categ"])
    rows = lookup(rows, tables["master_specimen"], {"biosample_specimen": "id"}, ["specimen_type_name"])
    flags = {n: rules.specimen_flag("specimen_type_name", w) == 1 for n, w in rules.SPECIMENS.items()}
    keys = ["id_subject", "patient_categ"]
    counts = [F.count_if(flag).cast("bigint").alias(f"sum_{n}") for n, flag in flags.items()]
    grouped = rows.groupBy("id_subject", "patient_categ").agg(
        *counts, F.max("code_repository").alias("code_repository")
    )
    return flagged_keys(grouped, list(flags), "sum_")


def _registry_a(tables):
    people = tables["regina_demography_basic_info"].join(
        tables["decrypt_regina"].select(F.col("id_subject").alias("_id"), "nik"), F.col("id_subject") == F.col("_id")
    )
    sites = tables["simbiox_patients"].filter(~rules.missing_or_dash("id_subject")).select("id_subject", "id_biobank")
    sites = lookup(sites, tables["master_biobank"], {"id_biobank": "id_biobank"}, ["biobank_nama"]).select(
        "id_subject", rules.hospital_from_biobank("biobank_nama").alias("_site")
    ).distinct()
    people = left_on(people, sites, {"id_subject": "id_subject"}, ["_site"])
    people = people.withColumn("_code", regexp_or_null("nik", r"\d{2}"))
    people = lookup(people, tables["provinsi"], {"_code": "id"}, {"name": "nik_province"})
    hospital = F.coalesce(rules.hospital_from_upper("hospital_name"), F.col("_site"))
    return people.select(
        "id_subject", F.col("age_at_recruitment").cast("bigint").alias("age_at_recruitment"), "sex",
        hospital.alias("hospital_name"), "nik_province",
        F.col("demog_created_at").cast("timestamp").alias("enrollment_date"),
    ).filter("hospital_name IS NOT NULL")


def _registry_b(tables):
    births = tables["decrypted_phenovar_participants"].select(F.col("id_subject").alias("_id"), "birth_date")
    people = tables["phenovar_participants"].join(births, F.col("id_subject") == F.col("_id"))
    people = lookup(people, tables["provinsi"], {"province_code": "id"}, {"name": "nik_province"})
    age = calendar_years(F.col("birth_date").try_cast("date"), F.col("creation_date").cast("date"))
    return people.select(
        "id_subject", age.cast("bigint").alias("age_at_recruitment"), "sex", "hospital_name", "nik_province",
        F.col("creation_date").cast("timestamp").alias("enrollment_date"),
    )


def run(tables):
    # Both sides are small beside what they are made of; written, their sizes are known to the joins below.
    people = once(tables, "people", _registry_a(tables).unionByName(_registry_b(tables)))
    samples = ["code_repository", "patient_categ", "is_buffycoat", "is_plasma", "is_sputum", "is_whole_blood"]
    kept = once(tables, "samples", biobank_samples(tables).select("id_subject", *samples))
    out = left_on(people, kept, {"id_subject": "id_subject"}, samples)
    analysed = tables["gold_qc"].filter(F.col("id_subject").isNotNull()).select(
        "id_subject", "sequencer",
        F.when(F.col("qc_strict_status") == "Pass", 1).otherwise(0).alias("is_qc_secondary_analysed"),
    ).distinct()
    out = left_on(
        out, analysed, {"id_subject": "id_subject"},
        {"id_subject": "_analysed", "sequencer": "secondary_sequencer",
         "is_qc_secondary_analysed": "is_qc_secondary_analysed"},
    )
    reports = left_on(
        tables["staging_pgx_report_status"].select("id_repository"), tables["staging_simbiox_biosamples_patients"],
        {"id_repository": "code_repository"}, ["id_subject"],
    ).filter(F.col("id_subject").isNotNull())
    # A row per report, and the flag says that there is one, as in the report in use.
    out = left_on(out, reports, {"id_subject": "id_subject"}, {"id_subject": "_reported"})

    def known(c):
        return F.col(c).isNotNull().cast("int")

    return out.select(
        *PEOPLE, known("code_repository").alias("biobank_available"), *samples[1:],
        known("_analysed").alias("is_secondary_analysed"), "is_qc_secondary_analysed", "secondary_sequencer",
        known("_reported").alias("is_pgx_created"),
    )
