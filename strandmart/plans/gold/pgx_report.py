"""Pharmacogenomic report state of passed samples."""

from pyspark.sql import functions as F

from strandmart.functions.rules import pgx_status
from strandmart.functions.text import nan_to_null, zero_date_to_null
from strandmart.operators.joins import left_on
from strandmart.operators.ranking import latest_by

REPORT = {
    "file_name": "file_name", "input_creation_date": "pgx_input_creation_date",
    "report_path_eng": "report_path_eng", "eng_report_creation_date": "eng_report_creation_date",
    "report_path_ind": "report_path_ind", "ind_report_creation_date": "ind_report_creation_date",
}


def run(tables, run_ts):
    reports = tables["staging_pgx_report_status"].select("id_repository", *REPORT)
    reports = reports.filter(F.col("id_repository").isNotNull())
    newest = latest_by(reports, ["id_repository"], ["input_creation_date", "report_path_ind"])
    passed = tables["gold_qc"].filter(F.col("qc_strict_status") == "Pass").select(
        "id_repository", "id_patient", "id_subject", "origin_biobank", "sex", "sequencer", "date_primary",
        "date_secondary", "run_name",
    )
    out = left_on(passed, newest, {"id_repository": "id_repository"}, REPORT)
    out = out.withColumns(
        {c: nan_to_null(c) for c in ("report_path_eng", "report_path_ind")}
        | {c: zero_date_to_null(c) for c in ("eng_report_creation_date", "ind_report_creation_date")}
    )
    out = left_on(out, tables["staging_demography"], {"id_subject": "id_subject"}, ["participant_type"])
    status = pgx_status("pgx_input_creation_date", "eng_report_creation_date", "ind_report_creation_date")
    return out.select(
        "id_repository", "id_patient", "id_subject", "file_name", "origin_biobank", "sex", "sequencer",
        "date_primary", "date_secondary", "run_name", "pgx_input_creation_date", "report_path_eng",
        "eng_report_creation_date", "report_path_ind", "ind_report_creation_date",
        F.lit(run_ts).cast("timestamp").alias("updated_at"), status.alias("pgx_status"), "participant_type",
    )
