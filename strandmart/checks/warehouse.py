"""A synthetic warehouse as SQL over the shared test tables.

The text runs unchanged on both engines, so a model and its oracle see the same
tables.  Every table grows with the test data.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame

from strandmart.functions import rules
from strandmart.plans.steps import Steps
from strandmart.session import shared_folder


def s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


O, C, L = s("o_orderkey"), s("o_custkey"), s("l_orderkey")
TEN = s("o_custkey * 10")
# One sample id in five forms, on orders and on lines.
O_SAMPLE = f"""CASE CAST(o_orderkey % 8 AS INT) WHEN 0 THEN 'SKI_' || {O} WHEN 1 THEN 'C' || {O} || '_250209_M' WHEN 2 THEN 'C' || {O} || '-DRAGEN-4'
  WHEN 3 THEN 'Ctest' || {O} ELSE 'C' || {O} END"""
L_SAMPLE = f"""CASE CAST(l_partkey % 8 AS INT) WHEN 0 THEN 'SKI_' || {L} WHEN 1 THEN 'C' || {L} || '_250209_M' WHEN 2 THEN 'C' || {L} || '-DRAGEN-4'
  WHEN 3 THEN 'Ctest' || {L} ELSE 'C' || {L} END"""
L_RUN = f"'C' || {L} || '_r' || {s('l_linenumber % 3')}"
L_TIME = "l_shipdate + (l_partkey * 100 + l_suppkey % 100) * INTERVAL '1' SECOND"
O_TIME = "o_orderdate + o_orderkey * INTERVAL '1' SECOND"
SUBJECT = "'AAA' || " + s("c_custkey")
SEX = "CASE WHEN c_custkey % 2 = 0 THEN 'FEMALE' ELSE 'MALE' END"

WAREHOUSE = {
    # biobank
    "master_biobank": f"""SELECT 'B' || {s('n_nationkey')} AS id_biobank, CASE n_nationkey WHEN 0 THEN 'Biobank RSPI Prof. Dr. Sulianti Saroso'
        WHEN 1 THEN 'Biobank RSUP Persahabatan' WHEN 2 THEN 'Biobank Pusat' WHEN 3 THEN 'Biobank Sentral (BB Binomika)' WHEN 4 THEN 'Biobank RSCM'
        ELSE 'Biobank ' || n_name END AS biobank_nama FROM nation""",
    "master_specimen": "SELECT " + s("n_nationkey") + " AS id, CASE n_nationkey % 12 "
    + " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(rules.SPECIMENS.values()))
    + " ELSE 'Other' END AS specimen_type_name FROM nation",
    "simbiox_master_status_proses": "SELECT n_nationkey AS id, 'state ' || n_name AS status_proses_name FROM nation",
    "simbiox_master_status_transfer": "SELECT n_nationkey AS id, CASE WHEN n_nationkey < 9 THEN 'Dikirim' ELSE 'Diterima' END AS status_transfer_name FROM nation",
    "simbiox_patients": f"""SELECT 'P' || {s('c_custkey')} AS id_patient, '"M' || {s('c_custkey')} || '" ' AS id_mpi,
        CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 17 = 1 THEN '-' ELSE {SUBJECT} END AS id_subject, {SEX} AS sex,
        CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 'B' || {s('c_nationkey')} END AS id_biobank FROM customer""",
    "simbiox_biosamples": f"""SELECT 'S' || {O} AS id, 'P' || {C} AS id_patient, 'C' || {O} AS code_repository,
        CASE CAST(o_orderkey % 7 AS INT) WHEN 0 THEN 'SKI-' || {O} WHEN 1 THEN NULL ELSE 'O' || {s('o_orderkey - o_orderkey % 3')} END AS origin_code_repository,
        'B' || {s('o_custkey % 25')} AS id_biobank, {s('o_orderkey % 25')} AS biosample_specimen FROM orders
      UNION ALL SELECT 'T' || {O}, 'P' || {C}, 'C' || {O}, 'O' || {O}, 'B' || {s('o_orderkey % 25')}, {s('o_orderkey % 11')} FROM orders WHERE o_orderstatus = 'P'""",
    "simbiox_log_visit_biospc": f"""SELECT 'P' || {s('user_id')} AS px_id, CASE event_type WHEN 'view' THEN 'Z00.0' WHEN 'error' THEN NULL WHEN 'click' THEN 'z001' ELSE 'A15' END AS kode_icd,
        ts AS create_time, ts - event_id % 7 * INTERVAL '1' HOUR AS datevisit FROM events""",
    "simbiox_transfer": f"""SELECT 'S' || {L} AS biosample_id, 'F' || {s('l_partkey')} AS transfer_formulir_id, 'B' || {s('l_suppkey % 7')} AS id_biobank,
        CASE WHEN l_suppkey % 4 = 0 THEN '1.0' ELSE 'B' || {s('l_partkey % 9')} END AS id_biobank_tujuan,
        CAST(l_linenumber AS INT) AS proses_status, CAST(l_partkey % 30 AS INT) AS proses_receive_status FROM lineitem""",
    "simbiox_transfer_formulir": f"""SELECT 'F' || {s('p_partkey')} AS id, 'No' || {s('p_partkey')} AS nomor_formulir,
        CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE CAST(TIMESTAMP '2024-01-01 00:00:00' + p_size * INTERVAL '1' DAY AS DATE) END AS tanggal_formulir,
        CAST(TIMESTAMP '2024-02-01 00:00:00' + p_size * INTERVAL '1' DAY AS DATE) AS tanggal_pengiriman, CAST(TIMESTAMP '2024-03-01 00:00:00' + p_size * INTERVAL '1' DAY AS DATE) AS tanggal_penerimaan,
        '08:00' AS waktu_pengiriman, '09:00' AS waktu_penerimaan, '4' AS suhu_pengiriman, '5' AS suhu_penerimaan, p_brand AS petugas_pengirim, p_type AS petugas_penerima,
        'k' AS keterangan, 'r' AS keterangan_receive, CAST(p_partkey % 27 AS INT) AS transfer_status, CAST(p_partkey % 2 AS INT) AS tujuan_is_biobank, 'n' AS non_biobank_nama, 't' AS triple_packaging FROM part""",
    # registries
    "regina_demography": f"SELECT {SUBJECT} AS id_subject, {SEX} AS sex FROM customer WHERE c_custkey % 3 = 0",
    "phenovar_participants": f"""SELECT {SUBJECT} AS id_subject, lower({SEX}) AS sex, {s('c_nationkey')} AS province_code, TIMESTAMP '2024-01-01 00:00:00' + c_nationkey * INTERVAL '1' DAY AS creation_date,
        CASE CAST(c_custkey % 5 AS INT) WHEN 0 THEN 'RSUP Persahabatan' WHEN 1 THEN 'RSPI Prof. Dr. Sulianti Saroso' WHEN 2 THEN 'RSUP Dr. Sardjito' WHEN 3 THEN 'Central Hub' ELSE 'RS Kanker Dharmais' END AS hospital_name
        FROM customer WHERE c_custkey % 3 <> 0""",
    "decrypt_regina": f"""SELECT {SUBJECT} AS id_subject, {s('c_nationkey + 10')} || {s('c_custkey')} AS nik, TIMESTAMP '1960-01-01 00:00:00' + c_custkey % 9000 * INTERVAL '1' DAY AS birthdate,
        CASE WHEN c_custkey % 2 = 0 THEN 'Perempuan' ELSE 'Laki-laki' END AS gender, TIMESTAMP '2023-01-01 00:00:00' + c_nationkey * INTERVAL '1' DAY AS creationDate
        FROM customer WHERE c_custkey % 3 = 0 UNION ALL
        SELECT {SUBJECT}, {s('c_nationkey + 10')} || {s('c_custkey')}, TIMESTAMP '1990-01-01 00:00:00', 'x', TIMESTAMP '2025-01-01 00:00:00' FROM customer WHERE c_custkey % 6 = 0""",
    "decrypted_phenovar_participants": f"""SELECT {SUBJECT} AS id_subject, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE {s('c_custkey % 40')} END AS nik, 'name ' || {s('c_custkey % 20')} AS full_name,
        CASE WHEN c_custkey % 31 = 1 THEN '0976-05-19' ELSE '1980-01-' || lpad({s('c_custkey % 28 + 1')}, 2, '0') END AS birth_date, lower({SEX}) AS sex,
        CASE CAST(c_nationkey % 5 AS INT) WHEN 0 THEN 'Yogyakarta' WHEN 1 THEN '-' WHEN 2 THEN 'Riau' ELSE 'Nation_' || {s('c_nationkey')} END AS province,
        TIMESTAMP '2024-05-01 00:00:00' + c_custkey % 300 * INTERVAL '1' DAY AS created_at FROM customer WHERE c_custkey % 3 <> 0""",
    "regina_migration": f"""SELECT {SUBJECT} AS id_subject_regina, CASE WHEN c_custkey % 2 = 0 THEN 'AAA' || {s('c_custkey + 1')} END AS phenovar_id_subject, 'nation_' || {s('c_nationkey')} AS provinsi
        FROM customer WHERE c_custkey % 6 < 4 AND c_custkey % 3 = 0""",
    "regina_demography_basic_info": f"""SELECT {SUBJECT} AS id_subject, CAST(c_custkey % 90 AS INT) AS age_at_recruitment, {SEX} AS sex,
        CASE CAST(c_custkey % 4 AS INT) WHEN 0 THEN 'RS KANKER DHARMAIS' WHEN 1 THEN 'RSUP DR. SARDJITO' ELSE NULL END AS hospital_name,
        TIMESTAMP '2023-01-01 00:00:00' + c_nationkey * INTERVAL '1' DAY AS demog_created_at FROM customer WHERE c_custkey % 3 = 0""",
    "provinsi": f"""SELECT {s('n_nationkey')} AS id, CASE n_nationkey WHEN 0 THEN 'Daerah Istimewa Yogyakarta' WHEN 1 THEN 'Kepulauan Riau' ELSE 'Nation_' || {s('n_nationkey')} END AS name,
        CASE CAST(n_nationkey % 6 AS INT) WHEN 0 THEN 'ID-PD' WHEN 3 THEN 'ID-PE' ELSE 'ID-' || {s('n_nationkey')} END AS iso_name FROM nation""",
    "demography_exclusion": f"SELECT {SUBJECT} AS id_subject, 'withdrawn ' || c_mktsegment AS reason FROM customer WHERE c_nationkey = 7",
    "demography_corrected_participant_type": f"SELECT {SUBJECT} AS id_subject, CASE WHEN c_custkey % 2 = 0 THEN 'Patient' ELSE 'Populasi Umum' END AS corrected_participant_type FROM customer WHERE c_nationkey = 9",
    "phenovar_digital_consent": f"SELECT {SUBJECT} AS id_subject FROM customer WHERE c_custkey % 2 = 1",
    "phenovar_docs_rekrutmen_registrasi": f"""SELECT {SUBJECT} AS id_subject, 'Nomor EC' AS path, 'EC' || {s('c_nationkey')} AS value FROM customer UNION ALL
        SELECT {SUBJECT}, 'Koleksi Sampel|Tipe Partisipan', CASE WHEN c_custkey % 3 = 1 THEN 'Kontrol' ELSE ' Pasien' END FROM customer UNION ALL SELECT {SUBJECT}, 'Nomor EC', 'EC1' FROM customer WHERE c_nationkey % 4 = 0""",
    "phenovar_docs_rekrutmen_basic": f"SELECT {SUBJECT} AS id_subject, 'Admisi Partisipan|Tipe Partisipan' AS path, 'Populasi Umum' AS value FROM customer WHERE c_nationkey = 5",
    "phenovar_ethical_clearance": f"SELECT 'EC' || {s('n_nationkey')} AS ec_number, CASE n_nationkey WHEN 2 THEN 'Survei Kesehatan Indonesia (SKI) 2023' WHEN 3 THEN 'x (AMI) Polygenic Risk Score (PRS) y' ELSE 'Study ' || n_name END AS research_title FROM nation",
    "phenovar_documents": f"""SELECT 'AAA' || {s('c_custkey')} AS participant_id, CASE WHEN c_custkey % 4 = 0 THEN 'system' ELSE 'other' END AS institution_name,
        '{{''Nomor EC'': ''X' || {s('c_nationkey')} || ''', ''Judul Penelitian'': ''Title ' || {s('c_nationkey')} || '''}}' AS question_answer FROM customer""",
    "regina_log": f"""SELECT 'AAA' || {s('user_id - user_id % 3')} AS ehr_id, ts AS logged_at,
        CASE event_type WHEN 'click' THEN 'ethical-clearance-v1' WHEN 'view' THEN 'genetic-disorders-pah-registrasi-v2' WHEN 'signup' THEN 'demography-v2' ELSE 'other' END AS template_id,
        CASE CAST(user_id % 8 AS INT) WHEN 0 THEN 'RS_KANKER_DHARMAIS' WHEN 1 THEN 'RS_PERSAHABATAN' WHEN 2 THEN 'RS_PON' WHEN 3 THEN 'RS_SULIANTI_SAROSO' WHEN 4 THEN 'RSCM' ELSE 'XX' END AS hospital,
        CASE event_type WHEN 'click' THEN '{{"composition": {{"ethical-clearance-v1/episode_of_care_-_institution/nomor_ethical_clearance": "' ||
            CASE CAST(event_id % 4 AS INT) WHEN 0 THEN '  x KEPK/XII/2022' WHEN 1 THEN 'KET-1203/UN2.F1/ETIK/PPM.00.02' ELSE 'N' || {s('user_id')} END ||
            '", "ethical-clearance-v1/episode_of_care_-_institution/judul_penelitian": "' || CASE CAST(event_id % 3 AS INT) WHEN 0 THEN 'Manusia dan Mycobacterium' ELSE ' J' || {s('user_id')} END ||
            '", "ethical-clearance-v1/episode_of_care_-_institution/nama_peneliti_pi": "PI"}}}}'
          WHEN 'view' THEN '{{"composition": {{"genetic-disorders-pah-registrasi-v2/registrasi/identitas/tipe_pasien:0|value": "' || CASE WHEN user_id % 2 = 0 THEN 'Patient' ELSE 'Control' END || '"}}}}'
          ELSE '{{}}' END AS composition FROM events""",
    # sequencing
    "illumina_bssh_biosamples": f"SELECT 'C' || {L} AS id_repository, 'X' || {s('l_suppkey')} AS session_id, 'LP' || {s('l_orderkey % 50')} AS id_library FROM lineitem",
    "illumina_bssh_runs": f"""SELECT 'X' || {s('s_suppkey')} AS session_id, 'LPX' || {s('s_nationkey')} AS id_library, s_name AS session_name, 'd' AS date_created, 'm' AS date_modified, 'Complete' AS execution_status,
        'w' AS workflow_reference, 'i' AS run_id, 'r' AS run_name, 'q' AS percent_gt_q30, 'f' AS flowcell_barcode, 's' AS status, 'c' AS run_date_created, 'y' AS total_flowcell_yield_Gbps FROM supplier""",
    "illumina_demux": f"SELECT 'C' || {L} AS id_repository, 'LP' || {s('l_orderkey % 50')} AS id_library, {s('l_partkey')} AS reads, CASE WHEN l_suppkey % 5 = 0 THEN 'nan' ELSE {s('l_suppkey')} END AS percent_reads FROM lineitem",
    "illumina_qs": f"SELECT 'C' || {L} AS id_repository, 'LP' || {s('l_orderkey % 50')} AS id_library, l_partkey AS yield, l_suppkey AS yield_q30 FROM lineitem",
    "ica_analysis": f"""SELECT concat_ws('-', {L}, {s('l_linenumber')}, {s('l_partkey')}, {s('l_suppkey')}) AS id, {L_SAMPLE} AS id_repository, {L_RUN} AS run_name, l_shipdate AS date_start, {L_TIME} AS date_end,
        CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCEEDED' END AS run_status, 'DRAGEN ' || l_linestatus AS pipeline_name, 'cram' || {s('l_partkey')} AS cram, l_partkey AS cram_size,
        'vcf' || {s('l_partkey')} AS vcf, l_suppkey AS vcf_size, '[''x'', ''LP' || {s('l_orderkey % 50')} || ''']' AS tag_user_tags FROM lineitem""",
    "illumina_qc": f"""SELECT 'C' || {L} AS id_repository, {L_RUN} AS run_name, l_discount AS percent_dups, l_extendedprice AS percent_q30_bases, l_partkey AS total_seqs, l_quantity AS median_coverage, l_tax AS contam,
        l_quantity + 40 AS at_least_10x, l_quantity + 20 AS at_least_20x, CASE WHEN l_orderkey % 2 = 0 THEN 'XX' ELSE 'XY' END AS ploidy_estimation, 1.0 AS snp, 2.0 AS indel, 3.0 AS ts_tv FROM lineitem""",
    "dynamodb_fix_samples": f"""SELECT {O} AS id, 'C' || {TEN} AS id_repository, CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'EMPTY' WHEN 1 THEN 'LP1' ELSE 'LP' || {s('o_orderkey % 9')} END AS id_library,
        CASE CAST(o_orderkey % 3 AS INT) WHEN 0 THEN 'Illumina' WHEN 1 THEN 'MGI' ELSE 'ONT' END AS sequencer, CASE WHEN o_orderkey % 13 = 0 THEN 'Tester' ELSE 'user' END AS id_requestor, {O_TIME} AS time_requested,
        CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN 'id_repository' WHEN 1 THEN 'id_library' WHEN 2 THEN 'id_zlims_index' WHEN 3 THEN 'cram' ELSE 'vcf' END AS fix_type,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'N' || {s('o_orderkey % 40')} END AS new_repository, 'NL' || {s('o_orderkey % 6')} AS new_library, {s('o_orderkey % 90')} AS new_index FROM orders""",
    "dynamodb_fix_analysis": f"""SELECT {O} AS id, 'C' || {TEN} || '_r' || {s('o_orderkey % 3')} AS run_name, CASE CAST(o_custkey % 3 AS INT) WHEN 0 THEN 'Illumina' WHEN 1 THEN 'MGI' ELSE 'ONT' END AS sequencer,
        CASE WHEN o_orderkey % 13 = 0 THEN 'a test' ELSE 'user' END AS id_requestor, {O_TIME} AS time_requested, CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'id_repository' WHEN 1 THEN 'cram' ELSE 'vcf' END AS fix_type,
        'R' || {O} AS new_repository, 'oc' || {O} AS cram, 'nc' || {O} AS new_cram, o_orderkey AS cram_size, CASE WHEN o_orderkey % 6 = 1 THEN NULL ELSE o_orderkey + 1 END AS new_cram_size,
        'ov' || {O} AS vcf, 'nv' || {O} AS new_vcf, o_orderkey + 2 AS vcf_size, o_orderkey + 3 AS new_vcf_size FROM orders""",
    "staging_fix_ski_id_repo": f"SELECT 'C' || {O} AS code_repository, 'SKI-' || {O} AS origin_code_repository, 'SKI_' || {O} AS new_origin_code_repository FROM orders WHERE o_orderkey % 7 = 0",
    "mgi_analysis": f"""SELECT {L_SAMPLE} AS id_repository, {L_RUN} AS run_name, {L_TIME} AS date_start, CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCEEDED' END AS run_status, 'CITUS' AS pipeline_name,
        'F' || {s('l_suppkey')} AS id_flowcell, 'cram' || {s('l_partkey')} AS cram, l_partkey AS cram_size, 'vcf' || {s('l_partkey')} AS vcf, l_suppkey AS vcf_size FROM lineitem""",
    "mgi_qc": f"""SELECT 'C' || {L} AS id_repository, l_extendedprice AS at_least_50x, l_discount AS percent_dups, l_quantity + 40 AS at_least_10x, l_quantity AS at_least_20x, CASE WHEN l_orderkey % 3 = 0 THEN 'female'
        WHEN l_orderkey % 3 = 1 THEN 'Male' ELSE 'unknown' END AS ploidy_estimation, l_tax AS snp, 2.0 AS indel, 3.0 AS ts_tv, l_quantity + 5 AS depth, l_partkey AS total_seqs, l_quantity AS median_coverage FROM lineitem""",
    "ztronpro_analysis": f"""SELECT 'C' || {TEN} AS id_repository, 'C' || {TEN} || '_r' || {s('o_orderkey % 3')} AS run_name, {O_TIME} AS date_secondary, 'zc' || {O} AS cram, o_orderkey AS cram_size, 'zv' || {O} AS vcf, o_orderkey + 1 AS vcf_size FROM orders""",
    "ztronpro_qc": f"""SELECT 'C' || {s('c_custkey * 10')} AS id_repository, 'C' || {s('c_custkey * 10')} || '_r' || {s('c_nationkey % 3')} AS run_name, 1.5 AS percent_dups, 90.0 AS at_least_10x, 80.0 AS at_least_20x,
        lower({SEX}) AS ploidy_estimation, 4.0 AS snp, 5.0 AS indel, 6.0 AS ts_tv, CAST(c_nationkey AS DOUBLE) AS depth FROM customer""",
    "wfhv_analysis": f"""SELECT {L_SAMPLE} AS id_repository, {L_RUN} AS run_name, {L_TIME} AS date_start, 'wf' AS pipeline_name, 'cram' || {s('l_partkey')} AS cram, l_partkey AS cram_size, 'vcf' || {s('l_partkey')} AS vcf, l_suppkey AS vcf_size FROM lineitem""",
    "wfhv_qc": f"""SELECT 'C' || {O} || '_r' || {s('o_custkey % 3')} AS run_name, o_orderkey AS total_seqs, CAST(30.5 AS DOUBLE) AS total_depth, CAST(0.5 AS DOUBLE) AS contaminated, CAST(91 AS DOUBLE) AS at_least_10x, CAST(82 AS DOUBLE) AS at_least_20x, 'XY' AS ploidy_estimation,
        o_custkey AS indel, CAST(2.5 AS DOUBLE) AS ts_tv, o_orderkey * 7 AS yield FROM orders""",
    "zlims_samples": f"""SELECT 'C' || {TEN} AS id_repository, 'F' || {s('o_orderkey % 100')} AS id_flowcell, TIMESTAMP '2023-10-25 00:00:00' + o_orderkey * INTERVAL '100' SECOND AS date_create, o_orderkey % 90 AS id_index FROM orders""",
    "ztronpro_samples": f"""SELECT CASE CAST(o_orderkey % 9 AS INT) WHEN 0 THEN 'C' || {O} || '_hg38' WHEN 1 THEN 'AshkenazimTrio_hg38' WHEN 2 THEN 'Test' || {O} WHEN 3 THEN 'C' || {s('o_orderkey - 3')} ELSE 'C' || {TEN} || '_x' END AS original_sample_id,
        CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'LP1' ELSE 'LP' || {s('o_orderkey % 9')} END AS flow_cell_id, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE {s('o_orderkey % 70')} END AS barcode,
        CASE WHEN o_orderstatus = 'P' THEN 'Running' ELSE 'Completed' END AS sample_progress, {O_TIME} AS creation_time FROM orders""",
    "ica_samples": f"""SELECT {O} AS id, {O_SAMPLE} AS id_repository, CASE WHEN o_orderstatus = 'P' THEN 'DELETED' ELSE 'AVAILABLE' END AS status, {O_TIME} AS time_modified,
        CASE WHEN o_orderkey % 3 = 0 THEN '[''a'', ''bssh.run.name:LP' || {C} || ' '']' ELSE NULL END AS sample_list_technical_tags, '[''x'', ''LP' || {O} || ''']' AS tag_user_tags FROM orders""",
    "ski_exclusion": f"SELECT 'C' || {s('c_custkey * 10')} AS origin_code_repository FROM customer WHERE c_nationkey = 3",
    "wfhv_samples": f"""SELECT CASE WHEN o_orderkey % 16 = 3 THEN 'barcode' || {O} ELSE 'W' || {O} END AS id_repository, 'ONT' || {s('o_orderkey % 30')} AS id_batch,
        '[''' || {s('o_orderdate')} || ''', ''' || {s("o_orderdate - o_custkey * INTERVAL '1' DAY")} || ''', '''']' AS processing_stopped, {s('o_orderkey * 1000000')} AS sum_of_total_passed_bases, {O} AS sum_of_bam_size FROM orders""",
    "samples_exclusion": f"SELECT 'W' || {s('c_custkey * 10')} AS id_repository FROM customer WHERE c_nationkey = 4",
    # inputs of the report models
    "staging_seq": f"""SELECT CASE WHEN o_orderkey % 50 = 7 THEN 'Control' || {O} ELSE 'C' || {O} END AS id_repository, CASE CAST(o_orderkey % 9 AS INT) WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'L' || {s('o_orderkey % 70')} END AS id_library,
        CASE CAST(o_orderkey % 3 AS INT) WHEN 0 THEN 'Illumina' WHEN 1 THEN 'MGI' ELSE 'ONT' END AS sequencer, o_orderdate AS date_primary, CASE WHEN o_orderkey % 3 = 2 THEN {s('o_custkey * 900000000')} END AS sum_of_total_passed_bases,
        {O} AS sum_of_bam_size, CAST(o_orderkey % 90 AS DOUBLE) AS id_index FROM orders""",
    "staging_simbiox_biosamples_patients": f"""SELECT 'P' || {C} AS id_patient, 'C' || {O} AS code_repository, 'M' || {C} AS id_mpi, CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE 'AAA' || {C} END AS id_subject, 'Biobank ' || {s('o_custkey % 9')} AS biobank_nama,
        CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'FEMALE' ELSE 'male' END AS registry_sex, 'Patient' AS patient_categ, 'S' || {O} AS biosample_id, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'O' || {s('o_orderkey - o_orderkey % 3')} END AS origin_code_repository FROM orders""",
    "staging_demography": f"""SELECT {SUBJECT} AS id_subject, CASE WHEN c_custkey % 5 = 0 THEN 1 = 1 ELSE 1 = 0 END AS is_excluded, CASE WHEN c_custkey % 2 = 0 THEN 'PASIEN' ELSE 'KONTROL' END AS participant_type,
        'NATION_' || {s('c_nationkey')} AS province, 'Hospital ' || {s('c_nationkey % 6')} AS hospital_name FROM customer""",
    "staging_illumina_sec": f"""SELECT 'C' || {L} AS id_repository, {L_TIME} AS date_start, {L_RUN} AS run_name, 'DRAGEN' AS pipeline_name, 'c' || {s('l_partkey')} AS cram, l_partkey AS cram_size, 'v' AS vcf, l_suppkey AS vcf_size,
        CASE WHEN l_suppkey % 6 = 0 THEN '' ELSE 'B' || {s('l_suppkey % 20')} END AS id_batch, l_quantity AS median_coverage, l_quantity + 45 AS at_least_10x, l_quantity AS at_least_20x, l_tax AS contamination, l_discount AS percent_q30_bases,
        l_partkey AS yield, l_suppkey AS yield_q30, CASE WHEN l_orderkey % 41 = 0 THEN 'xy' WHEN l_orderkey % 2 = 0 THEN 'xx' ELSE 'XY' END AS ploidy_estimation FROM lineitem""",
    "staging_mgi_sec": f"""SELECT 'C' || {L} AS id_repository, {L_TIME} AS date_start, {L_RUN} AS run_name, 'CITUS' AS pipeline_name, 'c' || {s('l_partkey')} AS cram, l_partkey AS cram_size, 'v' AS vcf, l_suppkey AS vcf_size,
        'B' || {s('l_suppkey % 20')} AS id_batch, CASE WHEN l_suppkey % 4 = 0 THEN 0 ELSE l_quantity END AS median_coverage, l_quantity + 45 AS at_least_10x, l_quantity AS at_least_20x, CASE WHEN l_orderkey % 2 = 0 THEN 'XX' ELSE NULL END AS ploidy_estimation FROM lineitem""",
    "staging_ont_sec": f"""SELECT 'C' || {L} AS id_repository, {L_TIME} AS date_start, {L_RUN} AS run_name, 'wf' AS pipeline_name, 'c' || {s('l_partkey')} AS cram, l_partkey AS cram_size, 'v' AS vcf, l_suppkey AS vcf_size,
        CAST(NULL AS STRING) AS id_batch, l_quantity AS median_coverage, l_quantity + 45 AS at_least_10x, l_quantity AS at_least_20x, l_tax AS contamination, CAST(NULL AS STRING) AS percent_q30_bases, l_partkey AS yield,
        CASE WHEN l_orderkey % 2 = 0 THEN 'XX' ELSE 'XY' END AS ploidy_estimation FROM lineitem""",
    "gold_qc": f"""SELECT 'C' || {O} AS id_repository, 'P' || {C} AS id_patient, CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE 'AAA' || {C} END AS id_subject, 'bb' AS origin_biobank, 'FEMALE' AS sex, CASE WHEN o_orderkey % 3 = 0 THEN 'Illumina' ELSE 'ONT' END AS sequencer,
        o_orderdate AS date_primary, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS date_secondary, 'run' || {O} AS run_name, CASE WHEN o_orderkey % 4 = 0 THEN 'Fail' ELSE 'Pass' END AS qc_strict_status, o_orderpriority AS qc_strict_diagnosis FROM orders""",
    "staging_pgx_report_status": f"""SELECT 'F' || {L} || '-' || {s('l_linenumber')} AS file_name, 'C' || {L} AS id_repository, CASE WHEN l_linenumber = 7 THEN NULL ELSE {L_TIME} END AS input_creation_date, CASE WHEN l_partkey % 5 = 0 THEN 'nan' ELSE 'e' || {s('l_partkey')} END AS report_path_eng,
        CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_shipdate END AS eng_report_creation_date, 'i' || {s('l_partkey')} AS report_path_ind, CASE WHEN l_suppkey % 2 = 0 THEN NULL ELSE l_shipdate END AS ind_report_creation_date FROM lineitem""",
    "gold_pgx_report": f"""SELECT 'C' || {O} AS id_repository, 'AAA' || {C} AS id_subject, 'F' || {O} AS file_name, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE {O_TIME} END AS ind_report_creation_date, CASE WHEN o_orderkey % 6 < 2 THEN NULL ELSE o_orderdate END AS eng_report_creation_date FROM orders""",
    "staging_simbiox_transfer": f"""SELECT 'S' || {L} AS biosample_id, 'F' || {s('l_partkey')} || '.' || {s('l_linenumber')} AS id, 'No' AS nomor_formulir, CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS tanggal_formulir, CASE WHEN l_suppkey % 5 = 0 THEN 'Biobank Pusat' ELSE 'Biobank X' END AS biobank_asal,
        'Biobank Y' AS biobank_tujuan, CAST(l_shipdate AS DATE) AS tanggal_pengiriman, '08' AS waktu_pengiriman, '4' AS suhu_pengiriman, 'k' AS keterangan_pengiriman, 's' AS status_pengiriman, 'p' AS petugas_pengirim, CAST(l_shipdate AS DATE) AS tanggal_penerimaan, '09' AS waktu_penerimaan, '5' AS suhu_penerimaan,
        'r' AS keterangan_penerimaan, 'q' AS status_penerimaan, 'o' AS petugas_penerima, CASE WHEN l_returnflag = 'R' THEN 'Diterima' ELSE 'Dikirim' END AS status_transfer_name, CAST(l_linenumber % 2 AS INT) AS tujuan_is_biobank, 'n' AS non_biobank_nama, 't' AS triple_packaging, CASE WHEN l_partkey % 2 = 0 THEN 1 ELSE 0 END AS is_to_central_seq FROM lineitem""",
    "gold_simbiox_transfer": f"""SELECT CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE 'S' || {L} END AS biosample_id, 'No' || {s('l_partkey')} AS nomor_formulir, CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE {L_TIME} END AS tanggal_formulir, 'st' AS status_transfer_name, 'a' AS biobank_asal, 'b' AS biobank_tujuan,
        l_shipdate AS tanggal_penerimaan, 'sp' AS status_penerimaan, 1 AS tujuan_is_biobank, 0 AS is_to_central_seq FROM lineitem""",
    "sheets_sequencing": f"""SELECT CASE WHEN o_orderkey % 14 = 0 THEN 'SKI_' || {O} ELSE 'C' || {O} END AS code_repository, CASE CAST(o_orderkey % 2 AS INT) WHEN 0 THEN 'ILLUMINA' ELSE 'ONT' END AS platform, o_orderstatus AS extraction_status, 'lib' AS libprep_status, o_orderdate AS sequencing_finish_date,
        o_orderpriority AS sequencing_status, o_totalprice AS volume_remain, o_orderdate AS delivery_date, {O_TIME} AS extraction_date FROM orders""",
    "staging_report_fix_simbiox": "SELECT CAST(ts AS DATE) AS date_time, count(*) AS ct FROM events GROUP BY 1",
}


def _details() -> str:
    from strandmart.plans.gold.top_genes import PAIRS

    names = ", ".join(f"({i}, '{g}', '{d}')" for i, (g, d, _) in enumerate(PAIRS))
    return f"""SELECT 'F' || {L} AS order_id, coalesce(gene, 'OTHER') AS gene_symbol, coalesce(drug, 'Aspirin') AS drug_name,
        CASE WHEN l_suppkey % 2 = 0 THEN 'Antituberculosis' ELSE 'Other' END AS drug_classification, CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE 'phenotype ' || l_returnflag END AS phenotype_text, CAST(l_linenumber AS INT) AS rec_category
        FROM lineitem LEFT JOIN (SELECT * FROM (VALUES {names}) v(i, gene, drug)) names ON l_partkey % 33 = i"""


WAREHOUSE["gold_pgx_detail_report"] = _details()


class DerivedTables(Mapping[str, DataFrame]):
    """The warehouse as DataFrames, each built on first use."""

    def __init__(self, inputs):
        self._inputs = inputs
        self._frames: dict[str, DataFrame] = {}
        self.steps = Steps(inputs.spark, f"{shared_folder(inputs.spark)}/steps-{uuid.uuid4().hex}")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._inputs.sql(WAREHOUSE[name])
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(WAREHOUSE)

    def __len__(self) -> int:
        return len(WAREHOUSE)


def ctes(*names: str) -> str:
    """The named tables as leading CTEs of an oracle."""
    return ", ".join(f"{n} AS ({WAREHOUSE[n]})" for n in names)
