"""Transfer facts with names of states and biobanks.  M09: newest transfer per sample."""

from pyspark.sql import functions as F

from strandmart.functions.rules import central_sequencing
from strandmart.operators.joins import left_on, lookup
from strandmart.operators.ranking import latest_by

FORM = {
    "id": "id", "nomor_formulir": "nomor_formulir", "tanggal_formulir": "tanggal_formulir",
    "tanggal_pengiriman": "tanggal_pengiriman", "waktu_pengiriman": "waktu_pengiriman",
    "suhu_pengiriman": "suhu_pengiriman", "keterangan": "keterangan_pengiriman",
    "petugas_pengirim": "petugas_pengirim", "tanggal_penerimaan": "tanggal_penerimaan",
    "waktu_penerimaan": "waktu_penerimaan", "suhu_penerimaan": "suhu_penerimaan",
    "keterangan_receive": "keterangan_penerimaan", "petugas_penerima": "petugas_penerima",
    "transfer_status": "_form_status", "tujuan_is_biobank": "tujuan_is_biobank",
    "non_biobank_nama": "non_biobank_nama", "triple_packaging": "triple_packaging",
}
COLUMNS = (
    "biosample_id id nomor_formulir tanggal_formulir biobank_asal biobank_tujuan tanggal_pengiriman "
    "waktu_pengiriman suhu_pengiriman keterangan_pengiriman status_pengiriman petugas_pengirim "
    "tanggal_penerimaan waktu_penerimaan suhu_penerimaan keterangan_penerimaan status_penerimaan "
    "petugas_penerima status_transfer_name tujuan_is_biobank non_biobank_nama triple_packaging is_to_central_seq"
).split()


def run(tables):
    target = F.when(F.col("id_biobank_tujuan") == "1.0", "1").otherwise(F.col("id_biobank_tujuan"))
    facts = tables["simbiox_transfer"].select(
        "biosample_id", "transfer_formulir_id", "id_biobank", "proses_status", "proses_receive_status",
        target.alias("id_biobank_tujuan"),
    ).distinct()
    states, biobanks = tables["simbiox_master_status_proses"], tables["master_biobank"]
    out = lookup(facts, states, {"proses_status": "id"}, {"status_proses_name": "status_pengiriman"})
    out = lookup(out, states, {"proses_receive_status": "id"}, {"status_proses_name": "status_penerimaan"})
    out = lookup(out, biobanks, {"id_biobank": "id_biobank"}, {"biobank_nama": "biobank_asal"})
    out = lookup(out, biobanks, {"id_biobank_tujuan": "id_biobank"}, {"biobank_nama": "biobank_tujuan"})
    out = left_on(out, tables["simbiox_transfer_formulir"], {"transfer_formulir_id": "id"}, FORM)
    out = lookup(
        out, tables["simbiox_master_status_transfer"], {"_form_status": "id"},
        {"status_transfer_name": "status_transfer_name"},
    )
    flag = central_sequencing("tujuan_is_biobank", "biobank_asal")
    return out.withColumn("is_to_central_seq", flag).select(*COLUMNS)


LATEST = (
    "nomor_formulir tanggal_formulir status_transfer_name biobank_asal biobank_tujuan tanggal_penerimaan "
    "status_penerimaan tujuan_is_biobank is_to_central_seq"
).split()


def run_latest(tables):
    transfers = tables["gold_simbiox_transfer"].select("biosample_id", *LATEST)
    # A transfer without a sample can match no sample; it would form one large group.
    transfers = transfers.filter(F.col("biosample_id").isNotNull())
    newest = latest_by(transfers, ["biosample_id"], ["tanggal_formulir"])
    out = lookup(
        tables["simbiox_biosamples"].select(
            F.col("id").alias("_id"), "id_patient", "origin_code_repository", "code_repository", "biosample_specimen"
        ),
        tables["master_specimen"], {"biosample_specimen": "id"}, ["specimen_type_name"],
    )
    out = left_on(out, tables["simbiox_patients"], {"id_patient": "id_patient"},
                  {"id_subject": "id_subject", "id_biobank": "_biobank"})
    out = lookup(out, tables["master_biobank"], {"_biobank": "id_biobank"}, ["biobank_nama"])
    out = left_on(out, newest, {"_id": "biosample_id"}, LATEST)
    return out.select(
        "id_subject", "origin_code_repository", "biobank_nama", "code_repository", "specimen_type_name", *LATEST
    ).distinct()
