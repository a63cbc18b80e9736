"""Keys of the 47 current tables: what identifies a row, what a match must not
overwrite, and how ``updated_at`` behaves (run time, incoming value or untouched)."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from strandmart.operators.merge import upsert

RUN, INCOMING, UNSET = "run", "incoming", "unset"


@dataclass(frozen=True)
class UpsertSpec:
    target: str
    keys: tuple[str, ...]
    keep: tuple[str, ...] = ()
    stamp: str = RUN


def _spec(target: str, keys: str, keep: str = "", stamp: str = RUN) -> UpsertSpec:
    return UpsertSpec(target, tuple(keys.split()), tuple(keep.split()), stamp)


# Fixed values.
SPECS = {
    "U01": _spec("gold_pgx_detail_report", "order_id drug_name gene_symbol", "order_id", UNSET),
    "U02": _spec("dynamodb_fix_analysis", "id", "", INCOMING),
    "U03": _spec("dynamodb_fix_samples", "id", "", INCOMING),
    "U04": _spec("ica_analysis", "id", "time_created"),
    "U05": _spec("ica_samples", "id", "time_created created_at"),
    "U06": _spec("illumina_bssh_biosamples", "session_id id_library id_repository", "created_at"),
    "U07": _spec("illumina_bssh_runs", "session_id", "created_at"),
    "U08": _spec("illumina_demux", "id_repository lane id_library reads", "created_at"),
    "U09": _spec("illumina_qc", "id_repository run_name", "created_at"),
    "U10": _spec("illumina_qs", "id_repository lane read_number yield", "created_at"),
    "U11": _spec("mgi_analysis", "id_repository run_name", "created_at"),
    "U12": _spec("mgi_qc", "id_repository run_name", "created_at"),
    "U13": _spec("phenovar_categories", "id", "created_by created_at", INCOMING),
    "U14": _spec("phenovar_data_sharing", "id", "created_at", INCOMING),
    "U15": _spec("phenovar_digital_consent", "id_subject", "created_by creation_date", UNSET),
    "U16": _spec("phenovar_diseases", "id", "", INCOMING),
    "U17": _spec("phenovar_documents", "participant_id institution_id document_type", "created_by", UNSET),
    "U18": _spec("phenovar_ethical_clearance", "id", "created_at", INCOMING),
    "U19": _spec("phenovar_form", "id", "", INCOMING),
    "U20": _spec("phenovar_group", "id", "", INCOMING),
    "U21": _spec("phenovar_hubs", "id", "", INCOMING),
    "U22": _spec("phenovar_institutions", "id", "created_at", INCOMING),
    "U23": _spec("phenovar_master_values", "id", "created_at", INCOMING),
    "U24": _spec("phenovar_participants", "id_subject", "created_by hospital_name created_at creation_date"),
    "U25": _spec("phenovar_projects", "id", "created_at", INCOMING),
    "U26": _spec("phenovar_section", "id", "", INCOMING),
    "U27": _spec("phenovar_variables", "id", "created_by created_at", INCOMING),
    "U28": _spec("regina_demography", "id_subject", "created_at creation_date"),
    "U29": _spec("regina_documents", "id_subject", "created_at", INCOMING),
    "U30": _spec("simbiox_biosamples", "id", "created_at"),
    "U31": _spec("simbiox_patients", "id_patient", "created_at"),
    "U32": _spec("simbiox_center_of_patient", "id", "created_at", INCOMING),
    "U33": _spec("simbiox_data_project", "id_project", "", INCOMING),
    "U34": _spec("simbiox_log_visit_biospc", "id", "created_at"),
    "U35": _spec("simbiox_master_status_proses", "id", "created_at", INCOMING),
    "U36": _spec("simbiox_master_status_transfer", "id", "created_at", INCOMING),
    "U37": _spec("simbiox_transfer_formulir", "id", "created_at"),
    "U38": _spec("simbiox_transfer", "transfer_id", "created_at"),
    "U39": _spec("staging_pgx_report_status", "file_name", "created_at"),
    "U40": _spec("wfhv_analysis", "id_repository run_name", "created_at"),
    "U41": _spec("wfhv_qc", "id_repository run_name", "created_at"),
    "U42": _spec("wfhv_samples", "id_repository", "created_at"),
    "U43": _spec("zlims_samples", "id_repository id_flowcell id_pool id_dnb id_index", "created_at"),
    "U44": _spec("ztronpro_analysis", "id_repository run_name", "created_at", INCOMING),
    "U45": _spec("ztronpro_qc", "id_repository run_name", "created_at", INCOMING),
    "U46": _spec("ztronpro_samples", "original_sample_id", "created_at", INCOMING),
    # The wide variant of U44, with the QC columns in the same row.
    "U47": _spec("ztronpro_analysis", "id_repository run_name", "created_at", INCOMING),
}


def match_rules(spec: UpsertSpec, columns: Collection[str], run_ts: Column) -> tuple[tuple[str, ...], tuple[str, Column] | None]:
    """What a match must not overwrite, and the stamp it sets, for a table of these columns."""
    has_stamp = "updated_at" in columns
    stamp = ("updated_at", run_ts) if spec.stamp == RUN and has_stamp else None
    keep = (*spec.keep, "updated_at") if spec.stamp == UNSET and has_stamp else spec.keep
    return keep, stamp


def apply_upsert(
    spec: UpsertSpec, target: DataFrame, source: DataFrame, run_ts: Column, order: tuple[str, ...]
) -> DataFrame:
    """The target after one batch, by its specification."""
    keep, stamp = match_rules(spec, target.columns, run_ts)
    return upsert(target, source, spec.keys, keep, order, stamp)
