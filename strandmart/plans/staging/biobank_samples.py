"""Biobank samples with patient, newest visit category and registry sex."""

from pyspark.sql import functions as F

from strandmart.functions.rules import visit_category
from strandmart.functions.text import strip_quotes
from strandmart.operators.aggregates import distinct_text
from strandmart.operators.joins import left_on, lookup
from strandmart.operators.ranking import latest_by


def visit_categories(tables, order="create_time", **words):
    """Category of the newest visit per patient."""
    visits = tables["simbiox_log_visit_biospc"].select("px_id", "kode_icd", order)
    newest = latest_by(visits.filter(F.col("px_id").isNotNull()), ["px_id"], [order])
    return newest.select("px_id", visit_category("kode_icd", **words).alias("patient_categ"))


def run(tables):
    biobanks = tables["master_biobank"]
    named = lookup(
        tables["simbiox_biosamples"].select(
            "id", "id_patient", "code_repository", "origin_code_repository", "id_biobank"
        ),
        biobanks, {"id_biobank": "id_biobank"}, ["biobank_nama"],
    ).withColumn("biobank_nama", F.trim("biobank_nama"))
    # A code can have several rows; ungrouped values come from the row with the smallest id.
    samples = named.groupBy("id_patient", "code_repository").agg(
        distinct_text("biobank_nama", ";").alias("_sample_biobank"),
        F.min(F.struct("id", "origin_code_repository")).alias("_row"),
    )
    patients = lookup(tables["simbiox_patients"], biobanks, {"id_biobank": "id_biobank"}, {"biobank_nama": "_patient_biobank"})
    patients = left_on(patients, visit_categories(tables), {"id_patient": "px_id"}, ["patient_categ"])
    patients = patients.withColumns({c: strip_quotes(c) for c in ("id_mpi", "id_subject")})
    out = left_on(
        samples, patients, {"id_patient": "id_patient"},
        ["id_mpi", "id_subject", "patient_categ", "_patient_biobank"],
    )
    for i, registry in enumerate(("regina_demography", "phenovar_participants")):
        out = left_on(
            out, tables[registry], {"id_subject": "id_subject"}, {"id_subject": f"_id{i}", "sex": f"_sex{i}"}
        )
    return out.select(
        "id_patient", "code_repository", "id_mpi", "id_subject",
        F.coalesce("_patient_biobank", "_sample_biobank").alias("biobank_nama"),
        F.coalesce("_id0", "_id1").alias("registry_id_subject"),
        F.coalesce("_sex0", "_sex1").alias("registry_sex"),
        "patient_categ", F.col("_row.id").alias("biosample_id"),
        F.col("_row.origin_code_repository").alias("origin_code_repository"),
    ).distinct()
