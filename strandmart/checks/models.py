"""Staging and report models on the derived warehouse."""

from datetime import datetime

from pyspark.sql import functions as F

from strandmart.checks.registry import cents, check, day, flag, stamp
from strandmart.checks.rule_checks import QC_STEPS, cases, q
from strandmart.checks.warehouse import DerivedTables, ctes
from strandmart.functions import clearance, rules
from strandmart.plans.gold import (
    end_to_end,
    lims_report,
    pgx_report,
    sample_qc,
    sheets_report,
    top_genes,
    transfer_report,
)
from strandmart.plans.staging import (
    biobank_samples,
    demography,
    fix_report,
    illumina_primary,
    illumina_secondary,
    mgi_secondary,
    ont_secondary,
    primary_sequencing,
    survey_alias,
    transfers,
)
from strandmart.session import fit_tasks
from strandmart.settings import Settings

RUN_TS = datetime(2025, 9, 9, 1, 30)
SETTINGS = Settings(run_ts=RUN_TS)
TRIAL = "regexp_matches(id_repository, '(?i)demo|test|benchmark|dev')"


def ranked(source, keys, order, where="true", columns="*"):
    """Newest row per key."""
    return f"(SELECT * FROM (SELECT {columns}, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source} WHERE {where}) WHERE rn = 1)"


CLEAN = "CASE WHEN id_repository ILIKE '%dragen%' THEN regexp_extract(id_repository, '[A-Za-z0-9_]+') WHEN id_repository ILIKE '%_m' OR id_repository ILIKE '%_t' THEN regexp_extract(id_repository, '[A-Za-z0-9]+') ELSE id_repository END"


def sample_fixes(platform):
    return ranked(
        "dynamodb_fix_samples", "id_repository", "time_requested DESC",
        f"sequencer = '{platform}' AND fix_type = 'id_repository' AND new_repository IS NOT NULL",
    )


def run_fixes(platform):
    newest = ranked(
        "dynamodb_fix_analysis", "run_name, fix_type", "time_requested DESC",
        f"sequencer = '{platform}' AND NOT regexp_matches(id_requestor, '(?i)test')",
    )
    picked = ", ".join(
        f"max({c}) FILTER (fix_type = '{k}') AS {c}"
        for k, cs in (("id_repository", ["new_repository"]), ("cram", ["cram", "new_cram", "cram_size", "new_cram_size"]), ("vcf", ["vcf", "new_vcf", "vcf_size", "new_vcf_size"]))
        for c in cs
    )
    return f"(SELECT run_name, {picked} FROM {newest} GROUP BY run_name)"


# --- staging --------------------------------------------------------------


@check("staging_survey_alias", f"""
WITH {ctes('simbiox_biosamples')}
SELECT code_repository, origin_code_repository, 'SKI_' || regexp_extract(origin_code_repository, '[0-9]+') AS new_origin_code_repository
FROM simbiox_biosamples WHERE origin_code_repository LIKE '%SKI%'
""")
def _m01(t):
    return survey_alias.run(DerivedTables(t))


@check("staging_illumina_primary", f"""
WITH {ctes('illumina_bssh_biosamples', 'illumina_bssh_runs', 'illumina_demux', 'illumina_qs')}
SELECT b.id_repository, r.id_library, r.session_id, r.session_name, r.run_name, d.total_reads, d.percent_reads, s.yield, s.yield_q30
FROM illumina_bssh_biosamples b LEFT JOIN illumina_bssh_runs r ON b.session_id = r.session_id
LEFT JOIN (SELECT id_repository, id_library, sum(CAST(reads AS DOUBLE)) AS total_reads, sum(CASE WHEN percent_reads <> 'nan' THEN CAST(percent_reads AS DOUBLE) END) AS percent_reads FROM illumina_demux GROUP BY 1, 2) d
  ON b.id_repository = d.id_repository AND b.id_library = d.id_library
LEFT JOIN (SELECT id_repository, id_library, CAST(sum(yield) AS DOUBLE) AS yield, CAST(sum(yield_q30) AS DOUBLE) AS yield_q30 FROM illumina_qs GROUP BY 1, 2) s
  ON b.id_repository = s.id_repository AND b.id_library = s.id_library
""")
def _m02(t):
    out = illumina_primary.run(DerivedTables(t))
    return out.select("id_repository", "id_library", "session_id", "session_name", "run_name", "total_reads", "percent_reads", "yield", "yield_q30")


@check("staging_illumina_secondary", f"""
WITH {ctes('ica_analysis', 'illumina_qc', 'illumina_qs', 'dynamodb_fix_samples', 'dynamodb_fix_analysis', 'staging_fix_ski_id_repo')},
a AS (SELECT *, {CLEAN} AS clean_id FROM ica_analysis WHERE NOT {TRIAL} AND run_status = 'SUCCEEDED'),
c AS (SELECT *, {CLEAN} AS clean_id FROM illumina_qc WHERE NOT {TRIAL}),
y AS (SELECT id_repository, CAST(sum(yield) AS BIGINT) AS yield, CAST(sum(yield_q30) AS BIGINT) AS yield_q30 FROM illumina_qs WHERE NOT {TRIAL} GROUP BY 1)
SELECT strftime(n.date_start, '%Y-%m-%d') AS date_start, coalesce(k.code_repository, f.new_repository, g.new_repository, n.clean_id) AS id_repository,
  regexp_extract(n.tag_user_tags, '(LP[0-9]+)', 1) AS id_batch, n.pipeline_name, n.run_name,
  coalesce(g.new_cram, n.cram) AS cram, coalesce(g.new_cram_size, n.cram_size) AS cram_size, coalesce(g.new_vcf, n.vcf) AS vcf, coalesce(g.new_vcf_size, n.vcf_size) AS vcf_size,
  b.percent_q30_bases, b.median_coverage, b.contam AS contamination, b.ploidy_estimation, y.yield, y.yield_q30
FROM {ranked('a', 'clean_id, run_name', 'date_end DESC, id')} n
LEFT JOIN {ranked('c', 'clean_id, run_name', 'percent_q30_bases DESC')} b ON n.run_name = b.run_name
LEFT JOIN y ON n.id_repository = y.id_repository
LEFT JOIN {sample_fixes('Illumina')} f ON n.id_repository = f.id_repository
LEFT JOIN {run_fixes('Illumina')} g ON n.run_name = g.run_name
LEFT JOIN staging_fix_ski_id_repo k ON n.id_repository = k.new_origin_code_repository
""")
def _m03(t):
    out = illumina_secondary.run(DerivedTables(t))
    return out.select(
        day("date_start").alias("date_start"), "id_repository", "id_batch", "pipeline_name", "run_name", "cram", "cram_size", "vcf", "vcf_size",
        "percent_q30_bases", "median_coverage", "contamination", "ploidy_estimation", "yield", "yield_q30",
    )


@check("staging_mgi_secondary", f"""
WITH {ctes('mgi_analysis', 'mgi_qc', 'ztronpro_analysis', 'ztronpro_qc', 'dynamodb_fix_samples', 'dynamodb_fix_analysis')},
first_source AS (
  SELECT a.date_start, coalesce(g.new_repository, f.new_repository, a.id_repository) AS id_repository, a.id_flowcell AS id_batch, a.pipeline_name, a.run_name,
    coalesce(g.new_cram, a.cram) AS cram, coalesce(g.new_cram_size, a.cram_size) AS cram_size, coalesce(g.new_vcf, a.vcf) AS vcf, coalesce(g.new_vcf_size, a.vcf_size) AS vcf_size,
    c.ploidy_estimation, c.depth, c.median_coverage
  FROM {ranked('mgi_analysis', 'id_repository', 'date_start DESC, run_name', f"run_status = 'SUCCEEDED' AND NOT {TRIAL}")} a
  LEFT JOIN {ranked('mgi_qc', 'id_repository', 'at_least_50x DESC')} c ON a.id_repository = c.id_repository
  LEFT JOIN {sample_fixes('MGI')} f ON a.id_repository = f.id_repository LEFT JOIN {run_fixes('MGI')} g ON a.run_name = g.run_name),
second_source AS (
  SELECT a.date_secondary AS date_start, coalesce(g.new_repository, f.new_repository, a.id_repository) AS id_repository, NULL AS id_batch, 'ZTRONPRO-MEGABOLT' AS pipeline_name, a.run_name,
    coalesce(g.cram, a.cram) AS cram, coalesce(g.new_cram_size, a.cram_size) AS cram_size, coalesce(g.vcf, a.vcf) AS vcf, coalesce(g.vcf_size, a.vcf_size) AS vcf_size,
    c.ploidy_estimation, c.depth, c.depth AS median_coverage
  FROM {ranked('ztronpro_analysis', 'id_repository', 'date_secondary DESC')} a
  LEFT JOIN ztronpro_qc c ON a.id_repository = c.id_repository AND a.run_name = c.run_name
  LEFT JOIN {sample_fixes('MGI')} f ON a.id_repository = f.id_repository LEFT JOIN {run_fixes('MGI')} g ON a.run_name = g.run_name),
everything AS (SELECT * FROM first_source UNION ALL SELECT * FROM second_source)
SELECT strftime(date_start, '%Y-%m-%d %H:%M:%S') AS date_start, id_repository, id_batch, pipeline_name, run_name, cram, cram_size, vcf, vcf_size,
  CASE lower(ploidy_estimation) WHEN 'female' THEN 'XX' WHEN 'male' THEN 'XY' END AS ploidy_estimation, depth, median_coverage
FROM {ranked('everything', 'id_repository', 'date_start DESC, id_batch NULLS FIRST, pipeline_name, run_name')}
""")
def _m04(t):
    out = mgi_secondary.run(DerivedTables(t))
    return out.select(
        stamp("date_start").alias("date_start"), "id_repository", "id_batch", "pipeline_name", "run_name", "cram", "cram_size", "vcf", "vcf_size",
        "ploidy_estimation", "depth", "median_coverage",
    )


@check("staging_ont_secondary", f"""
WITH {ctes('wfhv_analysis', 'wfhv_qc', 'dynamodb_fix_analysis')}
SELECT strftime(a.date_start, '%Y-%m-%d %H:%M:%S') AS date_start, coalesce(g.new_repository, a.id_repository) AS id_repository, a.run_name, a.pipeline_name,
  coalesce(g.new_cram, a.cram) AS cram, coalesce(g.new_cram_size, a.cram_size) AS cram_size, coalesce(g.new_vcf, a.vcf) AS vcf, coalesce(g.new_vcf_size, a.vcf_size) AS vcf_size,
  c.total_depth AS median_coverage, c.contaminated AS contamination, c.yield, c.indel
FROM {ranked('wfhv_analysis', 'id_repository', 'date_start DESC, run_name')} a
LEFT JOIN wfhv_qc c ON a.run_name = c.run_name LEFT JOIN {run_fixes('ONT')} g ON a.run_name = g.run_name
WHERE NOT regexp_matches(a.id_repository || ' ' || a.run_name, '(?i)demo|test|benchmark|dev')
""")
def _m05(t):
    out = ont_secondary.run(DerivedTables(t))
    return out.select(
        stamp("date_start").alias("date_start"), "id_repository", "run_name", "pipeline_name", "cram", "cram_size", "vcf", "vcf_size",
        "median_coverage", "contamination", "yield", "indel",
    )


MGI_FIX = ranked(
    "dynamodb_fix_samples", "id_repository, new_repository, new_library, new_index, fix_type", "time_requested DESC",
    "sequencer = 'MGI' AND NOT regexp_matches(id_requestor, '(?i)test')",
)


@check("staging_primary_sequencing", f"""
WITH {ctes('zlims_samples', 'ztronpro_samples', 'ica_samples', 'wfhv_samples', 'ski_exclusion', 'samples_exclusion', 'dynamodb_fix_samples', 'staging_fix_ski_id_repo')},
mgi_fix AS (SELECT id_repository, nullif(id_library, 'EMPTY') AS id_library, max(new_repository) FILTER (fix_type = 'id_repository') AS new_id, max(new_library) FILTER (fix_type = 'id_library') AS new_library,
    max(new_index) FILTER (fix_type = 'id_zlims_index') AS new_index FROM {MGI_FIX} GROUP BY 1, 2),
ill_fix AS (SELECT id_repository, nullif(id_library, 'EMPTY') AS id_library, max(new_repository) FILTER (fix_type = 'id_repository') AS new_id, max(new_library) FILTER (fix_type = 'id_library') AS new_library
    FROM {ranked('dynamodb_fix_samples', 'id_repository, id_library, fix_type', 'time_requested DESC', "sequencer = 'Illumina'")} GROUP BY 1, 2),
z AS (SELECT *, regexp_extract(original_sample_id, '[^_]+') AS code FROM ztronpro_samples),
mgi AS (
  SELECT coalesce(f.new_id, s.id_repository) AS id_repository, coalesce(f.new_library, s.id_flowcell) AS id_library, s.date_create AS d, coalesce(CAST(f.new_index AS DOUBLE), s.id_index) AS id_index
  FROM zlims_samples s LEFT JOIN mgi_fix f ON s.id_repository = f.id_repository WHERE s.date_create >= TIMESTAMP '2023-11-01 00:00:00'
  UNION ALL
  SELECT coalesce(f.new_id, z.code), coalesce(f.new_library, z.flow_cell_id), z.creation_time, coalesce(CAST(f.new_index AS DOUBLE), TRY_CAST(nullif(z.barcode, '') AS DOUBLE))
  FROM z LEFT JOIN mgi_fix f ON z.code = f.id_repository AND z.flow_cell_id = f.id_library
  WHERE NOT regexp_matches(original_sample_id, '(?i)test|AshkenazimTrio') AND sample_progress = 'Completed'
    AND original_sample_id NOT IN (SELECT code FROM z WHERE regexp_matches(original_sample_id, '(?i)_hg38') AND original_sample_id NOT ILIKE 'ashkenazim%')),
ill AS (
  SELECT c.clean_id, coalesce(f.new_id, c.clean_id) AS id_repository, coalesce(f.new_library, c.lib) AS id_library, c.d
  FROM (SELECT {CLEAN} AS clean_id, time_modified AS d,
      CASE WHEN sample_list_technical_tags IS NOT NULL THEN 'LP' || regexp_extract(sample_list_technical_tags, 'LP([0-9]+)', 1) ELSE 'LP' || regexp_extract(tag_user_tags, 'LP([0-9]+)', 1) END AS lib
    FROM ica_samples WHERE NOT {TRIAL} AND status <> 'DELETED' AND id_repository NOT IN (SELECT origin_code_repository FROM ski_exclusion)) c
  LEFT JOIN ill_fix f ON c.clean_id = f.id_repository)
SELECT id_repository, id_library, 'MGI' AS sequencer, strftime(d, '%Y-%m-%d %H:%M:%S') AS date_primary, NULL AS sum_of_total_passed_bases, id_index
FROM {ranked('mgi', 'id_repository', 'd DESC, id_library NULLS FIRST, id_index NULLS FIRST')}
UNION ALL
SELECT coalesce(k.code_repository, i.id_repository), trim(i.id_library), 'Illumina', strftime(i.d, '%Y-%m-%d %H:%M:%S'), NULL, NULL
FROM {ranked('ill', 'clean_id', 'd DESC, id_repository, id_library NULLS FIRST')} i LEFT JOIN staging_fix_ski_id_repo k ON i.id_repository = k.new_origin_code_repository
UNION ALL
SELECT id_repository, id_batch, 'ONT', split_part(processing_stopped, '''', 2), sum_of_total_passed_bases, NULL
FROM wfhv_samples WHERE id_repository NOT IN (SELECT id_repository FROM samples_exclusion) AND NOT regexp_matches(id_repository, '(?i)demo|test|benchmark|dev|barcode')
""")
def _m06(t):
    out = primary_sequencing.run(DerivedTables(t))
    return out.select(
        "id_repository", F.trim("id_library").alias("id_library"), "sequencer", stamp("date_primary").alias("date_primary"), "sum_of_total_passed_bases", "id_index"
    )


VISITS = ranked("simbiox_log_visit_biospc", "px_id", "create_time DESC, kode_icd NULLS FIRST", columns="px_id, CASE WHEN kode_icd ILIKE 'z00%' THEN 'Control' ELSE 'Patient' END AS categ, create_time, kode_icd")


@check("staging_biobank_samples", f"""
WITH {ctes('simbiox_biosamples', 'master_biobank', 'simbiox_patients', 'simbiox_log_visit_biospc', 'regina_demography', 'phenovar_participants')},
b AS (SELECT s.id_patient, s.code_repository, string_agg(DISTINCT trim(m.biobank_nama), ';' ORDER BY trim(m.biobank_nama)) AS names, min(s.id) AS biosample_id, arg_min(coalesce(s.origin_code_repository, ''), s.id) AS origin
  FROM simbiox_biosamples s LEFT JOIN master_biobank m ON s.id_biobank = m.id_biobank GROUP BY 1, 2),
p AS (SELECT x.id_patient, trim(replace(x.id_mpi, '"', '')) AS id_mpi, x.id_subject, m.biobank_nama FROM simbiox_patients x LEFT JOIN master_biobank m ON x.id_biobank = m.id_biobank)
SELECT DISTINCT b.id_patient, b.code_repository, p.id_mpi, p.id_subject, coalesce(p.biobank_nama, b.names) AS biobank_nama, coalesce(r.id_subject, h.id_subject) AS registry_id_subject,
  coalesce(r.sex, h.sex) AS registry_sex, v.categ AS patient_categ, b.biosample_id, nullif(b.origin, '') AS origin_code_repository
FROM b LEFT JOIN p ON b.id_patient = p.id_patient LEFT JOIN {VISITS} v ON p.id_patient = v.px_id
LEFT JOIN regina_demography r ON p.id_subject = r.id_subject LEFT JOIN phenovar_participants h ON p.id_subject = h.id_subject
""")
def _m07(t):
    return biobank_samples.run(DerivedTables(t))


@check("staging_transfers", f"""
WITH {ctes('simbiox_transfer', 'simbiox_master_status_proses', 'simbiox_master_status_transfer', 'master_biobank', 'simbiox_transfer_formulir')},
t AS (SELECT DISTINCT biosample_id, transfer_formulir_id, id_biobank, proses_status, proses_receive_status, replace(id_biobank_tujuan, '1.0', '1') AS goal FROM simbiox_transfer)
SELECT t.biosample_id, f.id, f.nomor_formulir, strftime(f.tanggal_formulir, '%Y-%m-%d') AS tanggal_formulir, b1.biobank_nama AS biobank_asal, b2.biobank_nama AS biobank_tujuan, p1.status_proses_name AS status_pengiriman,
  p2.status_proses_name AS status_penerimaan, s.status_transfer_name, CASE WHEN f.tujuan_is_biobank = 0 AND b1.biobank_nama IN ('Biobank Sentral (BB Binomika)', 'Biobank Pusat') THEN 1 ELSE 0 END AS is_to_central_seq
FROM t LEFT JOIN simbiox_master_status_proses p1 ON t.proses_status = p1.id LEFT JOIN simbiox_master_status_proses p2 ON t.proses_receive_status = p2.id
LEFT JOIN master_biobank b1 ON t.id_biobank = b1.id_biobank LEFT JOIN master_biobank b2 ON t.goal = b2.id_biobank
LEFT JOIN simbiox_transfer_formulir f ON t.transfer_formulir_id = f.id LEFT JOIN simbiox_master_status_transfer s ON f.transfer_status = s.id
""")
def _m08(t):
    out = transfers.run(DerivedTables(t)).withColumn("tanggal_formulir", day("tanggal_formulir"))
    return out.select(
        "biosample_id", "id", "nomor_formulir", "tanggal_formulir", "biobank_asal", "biobank_tujuan", "status_pengiriman", "status_penerimaan", "status_transfer_name", "is_to_central_seq"
    )


@check("staging_latest_transfer", f"""
WITH {ctes('gold_simbiox_transfer', 'simbiox_biosamples', 'master_specimen', 'simbiox_patients', 'master_biobank')}
SELECT DISTINCT p.id_subject, b.origin_code_repository, m.biobank_nama, b.code_repository, s.specimen_type_name, g.nomor_formulir, strftime(g.tanggal_formulir, '%Y-%m-%d') AS tanggal_formulir,
  strftime(g.tanggal_penerimaan, '%Y-%m-%d') AS tanggal_penerimaan
FROM simbiox_biosamples b LEFT JOIN master_specimen s ON b.biosample_specimen = s.id LEFT JOIN simbiox_patients p ON b.id_patient = p.id_patient LEFT JOIN master_biobank m ON p.id_biobank = m.id_biobank
LEFT JOIN {ranked('gold_simbiox_transfer', 'biosample_id', 'tanggal_formulir DESC NULLS LAST, nomor_formulir, tanggal_penerimaan', 'biosample_id IS NOT NULL')} g ON b.id = g.biosample_id
""")
def _m09(t):
    out = transfers.run_latest(DerivedTables(t))
    return out.select(
        "id_subject", "origin_code_repository", "biobank_nama", "code_repository", "specimen_type_name", "nomor_formulir", day("tanggal_formulir").alias("tanggal_formulir"),
        day("tanggal_penerimaan").alias("tanggal_penerimaan"),
    )


@check("staging_fix_report", f"""
WITH {ctes('staging_report_fix_simbiox', 'staging_simbiox_biosamples_patients')}
SELECT strftime(date_time, '%Y-%m-%d') AS date_time, ct FROM staging_report_fix_simbiox
UNION ALL SELECT '2025-09-09', count(*) FROM staging_simbiox_biosamples_patients WHERE registry_sex IS NULL
""")
def _m11(t):
    out = fix_report.run(DerivedTables(t), RUN_TS)
    return out.select(day("date_time").alias("date_time"), "ct")


# --- demography -----------------------------------------------------------

AGE = "greatest(CAST(floor(date_diff('day', CAST(birth AS DATE), CAST(created AS DATE)) / 365.25) AS BIGINT), 0)"
SPECIMEN_SUMS = ", ".join(f"count(*) FILTER (specimen_type_name = {q(w)}) AS n_{n}" for n, w in rules.SPECIMENS.items())
SURVEY = q(rules.SURVEY_TITLE)
CENTRE = q(SETTINGS.central_site)
RECORD_NUMBER = cases([("n LIKE '%KEPK/XII/2022'", q(clearance.CANCER.number)), ("n LIKE 'KET-1203%'", q(clearance.DIABETES_ADULT.number)), ("j LIKE '%dan Mycobacterium%'", q(clearance.TB_2024.number))], "n")
RECORD_TITLE = cases([("n LIKE '%KEPK/XII/2022'", q(clearance.CANCER.title)), ("n LIKE 'KET-1203%'", q(clearance.DIABETES_ADULT.title)), ("j LIKE '%dan Mycobacterium%'", q(clearance.TB_2024.title))], "j")
TITLE_GROUPS = cases([(f"title ILIKE {q(p)} AND title NOT LIKE '%;%'", q(n)) for p, n in clearance.TITLE_GROUPS], "title")
DEMOGRAPHY_TABLES = (
    "regina_log", "phenovar_docs_rekrutmen_registrasi", "phenovar_docs_rekrutmen_basic", "phenovar_ethical_clearance", "phenovar_documents", "demography_corrected_participant_type",
    "decrypt_regina", "regina_migration", "decrypted_phenovar_participants", "demography_exclusion", "simbiox_biosamples", "simbiox_patients", "master_biobank", "master_specimen",
    "simbiox_log_visit_biospc", "phenovar_digital_consent", "phenovar_participants", "gold_qc", "provinsi",
)
DEMOGRAPHY = f"""
WITH {ctes(*DEMOGRAPHY_TABLES)},
records AS (SELECT id, {RECORD_NUMBER} AS number, {RECORD_TITLE} AS title FROM (
  SELECT ehr_id AS id, ltrim(json_extract_string(composition, '$.composition."ethical-clearance-v1/episode_of_care_-_institution/nomor_ethical_clearance"')) AS n,
    ltrim(json_extract_string(composition, '$.composition."ethical-clearance-v1/episode_of_care_-_institution/judul_penelitian"')) AS j FROM regina_log WHERE template_id = 'ethical-clearance-v1')),
ec_a AS (SELECT id, string_agg(DISTINCT number, ': ' ORDER BY number) AS ec, string_agg(DISTINCT title, ': ' ORDER BY title) AS title FROM records GROUP BY 1),
ec_b AS (
  SELECT d.id_subject AS id, string_agg(DISTINCT d.value, '; ' ORDER BY d.value) AS ec, string_agg(DISTINCT e.research_title, '; ' ORDER BY e.research_title) AS title
  FROM phenovar_docs_rekrutmen_registrasi d LEFT JOIN phenovar_ethical_clearance e ON d.value = e.ec_number WHERE d.path = 'Nomor EC' GROUP BY 1
  UNION SELECT participant_id, regexp_extract(question_answer, 'EC'': ''([^'']+)', 1), regexp_extract(question_answer, 'Penelitian'': ''([^'']+)', 1) FROM phenovar_documents
  WHERE institution_name = 'system' AND participant_id NOT IN ({", ".join(q(x) for x in demography.TRIAL_SUBJECTS)})),
type_a AS (SELECT l.ehr_id AS id, max(CASE WHEN upper(coalesce(c.corrected_participant_type, json_extract_string(composition, '$.composition."genetic-disorders-pah-registrasi-v2/registrasi/identitas/tipe_pasien:0|value"'))) = 'PATIENT' THEN 'PASIEN' END) AS kind
  FROM regina_log l LEFT JOIN demography_corrected_participant_type c ON l.ehr_id = c.id_subject WHERE template_id = 'genetic-disorders-pah-registrasi-v2' GROUP BY 1),
type_b AS (SELECT id, string_agg(DISTINCT kind, ',' ORDER BY kind) AS kind FROM (
  SELECT x.id_subject AS id, upper(coalesce(c.corrected_participant_type, x.v)) AS kind FROM (
    SELECT id_subject, value AS v FROM phenovar_docs_rekrutmen_registrasi WHERE path LIKE 'Koleksi%' UNION ALL SELECT id_subject, value FROM phenovar_docs_rekrutmen_basic
    UNION ALL SELECT id_subject, corrected_participant_type FROM demography_corrected_participant_type) x LEFT JOIN demography_corrected_participant_type c ON x.id_subject = c.id_subject) GROUP BY 1),
a AS (SELECT d.id_subject AS a_id, m.phenovar_id_subject AS b_id, d.birthdate AS birth, CASE d.gender WHEN 'Perempuan' THEN 'FEMALE' WHEN 'Laki-laki' THEN 'MALE' END AS sex, upper(m.provinsi) AS province, d.creationDate AS created, e.ec, e.title
  FROM {ranked('decrypt_regina', 'id_subject, nik', 'creationDate')} d LEFT JOIN regina_migration m ON d.id_subject = m.id_subject_regina LEFT JOIN ec_a e ON d.id_subject = e.id),
b AS (SELECT p.nik, p.full_name, p.id_subject AS b_id, CASE WHEN p.birth_date = '0976-05-19' THEN '1976-05-19' ELSE p.birth_date END AS birth, upper(p.sex) AS sex, upper(p.province) AS province, p.created_at AS created, e.ec, e.title
  FROM decrypted_phenovar_participants p LEFT JOIN ec_b e ON p.id_subject = e.id),
only_b AS (SELECT b.*, t.kind FROM b LEFT JOIN type_b t ON b.b_id = t.id WHERE b.b_id NOT IN (SELECT b_id FROM a WHERE b_id IS NOT NULL)),
twins AS (SELECT full_name, nik, string_agg(b_id, ',' ORDER BY b_id) AS ids FROM only_b WHERE nik IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1),
persons AS (
  SELECT a.a_id, a.b_id, CAST(a.birth AS DATE) AS birth, a.sex, a.province, a.created, coalesce(a.ec, b.ec) AS ec, coalesce(a.title, b.title) AS title, t.kind, NULL AS twin
  FROM a LEFT JOIN b ON a.b_id = b.b_id LEFT JOIN type_a t ON a.a_id = t.id
  UNION SELECT NULL, o.b_id, CAST(o.birth AS DATE), o.sex, o.province, o.created, o.ec, o.title, o.kind, w.ids FROM only_b o LEFT JOIN twins w ON o.nik = w.nik AND o.full_name = w.full_name),
why AS (SELECT id_subject, min(reason) AS reason FROM demography_exclusion GROUP BY 1),
subjects AS (SELECT coalesce(a_id, b_id) AS id, a_id, b_id, sex, province, {AGE} AS age, created, kind, (w1.id_subject IS NOT NULL OR w2.id_subject IS NOT NULL) AS out_a, min(least(w1.reason, w2.reason)) AS reason, min(twin) AS twin,
    string_agg(DISTINCT ec, '; ' ORDER BY ec) AS ec, string_agg(DISTINCT title, '; ' ORDER BY title) AS title
  FROM persons LEFT JOIN why w1 ON a_id = w1.id_subject LEFT JOIN why w2 ON b_id = w2.id_subject GROUP BY ALL),
samples AS (SELECT p.id_subject AS id, m.biobank_nama, c.specimen_type_name, s.origin_code_repository FROM simbiox_biosamples s JOIN simbiox_patients p ON s.id_patient = p.id_patient
  LEFT JOIN master_biobank m ON s.id_biobank = m.id_biobank LEFT JOIN master_specimen c ON s.biosample_specimen = c.id),
counts AS (SELECT id, {SPECIMEN_SUMS}, string_agg(DISTINCT origin_code_repository, '; ' ORDER BY origin_code_repository) AS codes FROM samples GROUP BY 1),
tb AS (SELECT id, replace(min(biobank_nama), 'Biobank ', '') AS site FROM samples WHERE biobank_nama IN ({", ".join(q(x) for x in rules.TB_BIOBANKS)}) AND id <> {q(demography.OTHER_SITE_SUBJECT)}
  GROUP BY 1 HAVING count(*) FILTER (specimen_type_name IN ('Plasma EDTA', 'Whole Blood', 'Buffycoat')) > 0),
sites AS (
  SELECT ehr_id AS id, {cases([(f"hospital = {q(k)}", q(v)) for k, v in rules.HOSPITAL_CODES.items()])} AS site, false AS consent, hospital IN ('RS_PERSAHABATAN', 'RS_SULIANTI_SAROSO') AS out_s
  FROM {ranked('regina_log', 'ehr_id', 'logged_at', "template_id = 'demography-v2' AND ehr_id NOT IN (SELECT id FROM tb)")}
  UNION ALL SELECT id, site, false, false FROM tb
  UNION ALL SELECT p.id_subject, p.hospital_name, p.id_subject IN (SELECT id_subject FROM phenovar_digital_consent), p.hospital_name IN ('RSUP Persahabatan', 'RSPI Prof. Dr. Sulianti Saroso')
  FROM phenovar_participants p WHERE p.id_subject NOT IN (SELECT id FROM tb)),
bb AS (SELECT p.id_subject AS id, CASE WHEN v.kode_icd ILIKE 'z00%' THEN 'KONTROL' ELSE 'PASIEN' END AS kind
  FROM {ranked('simbiox_log_visit_biospc', 'px_id', 'datevisit DESC, kode_icd NULLS FIRST')} v JOIN simbiox_patients p ON v.px_id = p.id_patient WHERE p.id_subject IS NOT NULL),
qc AS (SELECT id_subject AS id, count(date_primary) > 0 AS sequenced, count(date_secondary) > 0 AS analysed FROM gold_qc WHERE id_subject IS NOT NULL GROUP BY 1),
targets AS (SELECT * FROM (VALUES {", ".join(f"({q(n or SETTINGS.central_site)}, {v})" for n, v in rules.TARGETS)}) v(name, target)),
wide AS (SELECT s.*, x.site, x.consent, x.out_s, bb.kind AS bb_kind, trim(coalesce(s.kind, bb.kind)) AS own, coalesce(n_buffycoat, 0) AS buffycoat, coalesce(n_plasma, 0) AS plasma, coalesce(n_whole_blood, 0) AS whole_blood,
    coalesce(n_serum, 0) AS serum, coalesce(n_sputum, 0) AS sputum, c.codes, coalesce(qc.sequenced, false) AS sequenced, coalesce(qc.analysed, false) AS analysed, t.target,
    CASE s.province WHEN 'YOGYAKARTA' THEN 'DAERAH ISTIMEWA YOGYAKARTA' WHEN 'RIAU' THEN 'KEPULAUAN RIAU' WHEN '-' THEN NULL ELSE s.province END AS place
  FROM subjects s LEFT JOIN sites x ON s.id = x.id LEFT JOIN bb ON s.id = bb.id LEFT JOIN counts c ON s.id = c.id LEFT JOIN qc ON s.id = qc.id LEFT JOIN targets t ON x.site = t.name)
SELECT w.id AS id_subject, w.a_id AS regina_id_subject, w.b_id AS phenovar_id_subject, w.twin AS duplicate_name_nik_id_subject, w.site AS hospital_name, w.sex, w.place AS province, w.age AS age_at_recruitment,
  w.kind AS registry_participant_type, w.bb_kind AS biobank_participant_type,
  CASE WHEN title = {SURVEY} AND own <> 'POPULASI UMUM' THEN 'POPULASI UMUM' WHEN coalesce(title, '') <> {SURVEY} AND site = {CENTRE} AND bb_kind = 'KONTROL' THEN 'POPULASI UMUM'
       WHEN coalesce(title, '') <> {SURVEY} AND own = 'POPULASI UMUM' THEN 'KONTROL' ELSE own END AS participant_type,
  w.ec AS nomor_ec, w.title AS judul_penelitian, CAST(w.consent AS INTEGER) AS has_tiered_digital_consent, CAST(coalesce(w.out_s, false) OR w.out_a AS INTEGER) AS is_excluded,
  CASE WHEN w.out_s THEN 'TB Exclusion due to not having BC/Plasma' ELSE w.reason END AS exclusion_reason, {TITLE_GROUPS} AS corrected_judul_penelitian,
  w.buffycoat AS count_buffycoat, w.plasma AS count_plasma, w.whole_blood AS count_whole_blood, w.serum AS count_serum, w.sputum AS count_sputum,
  CAST(w.sequenced AS INTEGER) AS is_wgs_sequenced, CAST(w.analysed AS INTEGER) AS is_wgs_secondary_analysed, w.codes AS origin_code_repository, w.target AS hub_target,
  CASE p.iso_name WHEN 'ID-PD' THEN 'ID-PB' WHEN 'ID-PE' THEN 'ID-PA' ELSE p.iso_name END AS province_iso_code
FROM {ranked('wide', 'id, site, ec', 'created, age')} w LEFT JOIN provinsi p ON w.place = upper(p.name)
"""


@check("staging_demography", DEMOGRAPHY)
def _m10(t):
    out = demography.run(DerivedTables(t), SETTINGS).drop("creation_date")
    flags = ("has_tiered_digital_consent", "is_excluded", "is_wgs_sequenced", "is_wgs_secondary_analysed")
    return out.withColumns({c: flag(c) for c in flags})


# --- reports --------------------------------------------------------------

SECONDARY = " UNION ALL ".join(
    f"SELECT '{p}' AS platform, id_repository AS rid, run_name, pipeline_name, cram, cram_size, vcf, vcf_size, id_batch, median_coverage, at_least_10x, ploidy_estimation AS ploidy, date_start, {y} AS yield FROM "
    + ranked(n, "id_repository", "date_start DESC, run_name")
    for p, n, y in (("Illumina", "staging_illumina_sec", "yield"), ("MGI", "staging_mgi_sec", "NULL"), ("ONT", "staging_ont_sec", "yield"))
)
# The label steps of the rule check, on the report's samples.
LABEL_STEPS = QC_STEPS[QC_STEPS.index("paired AS"):]


@check("gold_sample_qc", f"""
WITH {ctes('staging_seq', 'staging_simbiox_biosamples_patients', 'staging_demography', 'staging_illumina_sec', 'staging_mgi_sec', 'staging_ont_sec')},
secondary AS ({SECONDARY}),
samples AS (SELECT s.id_repository, p.id_subject, CAST(d.is_excluded AS INTEGER) AS is_excluded, p.biobank_nama AS origin_biobank, p.registry_sex AS sex, s.sequencer, s.sum_of_total_passed_bases,
    coalesce(nullif(s.id_library, ''), CASE WHEN s.sequencer = 'Illumina' THEN x.id_batch END) AS id_library,
    coalesce(CASE WHEN s.sequencer <> 'ONT' THEN nullif(x.id_batch, '') END, s.id_library) AS id_batch,
    x.run_name, x.pipeline_name, x.cram, x.cram_size, x.vcf, x.median_coverage AS coverage, x.at_least_10x, x.yield, upper(x.ploidy) AS ploidy_estimation, strftime(x.date_start, '%Y-%m-%d %H:%M:%S') AS date_secondary
  FROM staging_seq s LEFT JOIN staging_simbiox_biosamples_patients p ON s.id_repository = p.code_repository LEFT JOIN staging_demography d ON p.id_subject = d.id_subject
  LEFT JOIN secondary x ON s.id_repository = x.rid AND s.sequencer = x.platform
  WHERE NOT regexp_matches(lower(s.id_repository), 'test|pro|mla|sp500|gk-p5|gk-p3|control|t011')),
{LABEL_STEPS}
SELECT id_repository, id_subject, is_excluded, origin_biobank, sex, sequencer, id_library, id_batch, run_name, pipeline_name, cram, cram_size, coverage, CAST(yield AS DOUBLE) AS yield, ploidy_estimation, date_secondary,
  pair AS sex_ploidy_category, batch AS batch_sex_category, cov AS coverage_category, cls AS coverage_class, yields AS ont_yield_status,
  (SELECT arg_min(reason, ord) FROM reasons WHERE r_cov IN ('*', cov) AND r_batch IN ('*', batch) AND r_pair IN ('*', pair)
      AND r_sex IN ('*', CAST(CAST(no_sex AS INTEGER) AS VARCHAR)) AND r_ploidy IN ('*', CAST(CAST(no_ploidy AS INTEGER) AS VARCHAR))) AS qc_strict_reason,
  CASE WHEN pair = 'Mismatch' OR batch = 'Fail' OR cov = 'Fail' THEN 'Fail' WHEN cov = 'Pass' AND batch = 'Pass' AND pair = 'Match' THEN 'Pass' ELSE 'Incomplete Data' END AS qc_strict_status
FROM covered
""")
def _m12(t):
    # samples and biobank rows both come from the orders
    fit_tasks(t.spark, 2 * t.size("orders"))
    out = sample_qc.run(DerivedTables(t), RUN_TS)
    return out.select(
        "id_repository", "id_subject", flag("is_excluded").alias("is_excluded"), "origin_biobank", "sex", "sequencer", "id_library", "id_batch", "run_name", "pipeline_name", "cram", "cram_size", "coverage", "yield",
        "ploidy_estimation", stamp("date_secondary").alias("date_secondary"), "sex_ploidy_category", "batch_sex_category", "coverage_category", "coverage_class", "ont_yield_status", "qc_strict_reason", "qc_strict_status",
    )


@check("gold_pgx_report", f"""
WITH {ctes('gold_qc', 'staging_pgx_report_status', 'staging_demography')}
SELECT g.id_repository, g.id_subject, p.file_name, strftime(p.input_creation_date, '%Y-%m-%d %H:%M:%S') AS pgx_input_creation_date, nullif(p.report_path_eng, 'nan') AS report_path_eng, p.report_path_ind,
  strftime(p.eng_report_creation_date, '%Y-%m-%d') AS eng_report_creation_date, strftime(p.ind_report_creation_date, '%Y-%m-%d') AS ind_report_creation_date, d.participant_type,
  CASE WHEN p.input_creation_date IS NOT NULL AND coalesce(p.eng_report_creation_date, p.ind_report_creation_date) IS NULL THEN 'Failed Run' WHEN p.input_creation_date IS NOT NULL THEN 'Successful Run'
       WHEN coalesce(p.eng_report_creation_date, p.ind_report_creation_date) IS NULL THEN 'Uncompleted Run' END AS pgx_status
FROM gold_qc g LEFT JOIN {ranked('staging_pgx_report_status', 'id_repository', 'input_creation_date DESC NULLS LAST, report_path_ind DESC, file_name')} p ON g.id_repository = p.id_repository
LEFT JOIN staging_demography d ON g.id_subject = d.id_subject WHERE g.qc_strict_status = 'Pass'
""")
def _m13(t):
    out = pgx_report.run(DerivedTables(t), RUN_TS)
    return out.select(
        "id_repository", "id_subject", "file_name", stamp("pgx_input_creation_date").alias("pgx_input_creation_date"), "report_path_eng", "report_path_ind",
        day("eng_report_creation_date").alias("eng_report_creation_date"), day("ind_report_creation_date").alias("ind_report_creation_date"), "participant_type", "pgx_status",
    )


PAIR_ROWS = ", ".join(f"({i}, {q(g)}, {q(d)}, {q(c)})" for i, (g, d, c) in enumerate(top_genes.PAIRS))


@check("gold_top_genes", f"""
WITH {ctes('gold_pgx_report', 'staging_demography', 'gold_pgx_detail_report', 'provinsi')},
pairs AS (SELECT * FROM (VALUES {PAIR_ROWS}) v(i, gene, drug, kind)),
people AS {ranked('gold_pgx_report', 'id_subject', 'ind_report_creation_date DESC NULLS LAST, file_name', 'ind_report_creation_date IS NOT NULL OR eng_report_creation_date IS NOT NULL')}
SELECT DISTINCT p.id_subject, d.province, n.iso_name, coalesce(r.phenotype_text, v.gene || ' Tidak Dapat Ditentukan') AS phenotype_text, v.gene AS gene_symbol,
  CASE r.rec_category WHEN 1 THEN 'Change Prescription' WHEN 2 THEN 'Increase Starting Dose' WHEN 3 THEN 'Decrease Starting Dose' WHEN 4 THEN 'Increase Monitoring' WHEN 5 THEN 'Follow Standard Dosing' END AS recommendation,
  v.drug AS drug_name, v.gene || ' - ' || v.drug AS gene_drug, d.hospital_name
FROM people p CROSS JOIN pairs v LEFT JOIN gold_pgx_detail_report r ON p.file_name = r.order_id AND r.gene_symbol = v.gene AND r.drug_name = v.drug AND (v.kind IS NULL OR v.kind = r.drug_classification) AND r.phenotype_text IS NOT NULL
LEFT JOIN staging_demography d ON p.id_subject = d.id_subject LEFT JOIN provinsi n ON d.province = upper(n.name)
""")
def _m14(t):
    return top_genes.run(DerivedTables(t))


@check("gold_transfer_report", f"""
WITH {ctes('staging_simbiox_transfer', 'simbiox_biosamples', 'simbiox_patients', 'master_biobank', 'simbiox_log_visit_biospc', 'decrypt_regina', 'decrypted_phenovar_participants')},
people AS MATERIALIZED (SELECT id, sex, {AGE} AS age FROM (
  SELECT id_subject AS id, CASE gender WHEN 'Perempuan' THEN 'FEMALE' WHEN 'Laki-laki' THEN 'MALE' END AS sex, CAST(birthdate AS DATE) AS birth, creationDate AS created FROM decrypt_regina
  UNION ALL SELECT id_subject, upper(sex), CAST(replace(birth_date, '0976-', '1976-') AS DATE), created_at FROM decrypted_phenovar_participants)),
rows_ AS MATERIALIZED (SELECT t.*, b.code_repository, b.origin_code_repository, p.id_subject, m.biobank_nama AS patient_biobank, v.categ AS patient_categ, d.sex AS registry_sex, d.age
  FROM staging_simbiox_transfer t LEFT JOIN simbiox_biosamples b ON t.biosample_id = b.id LEFT JOIN simbiox_patients p ON b.id_patient = p.id_patient LEFT JOIN master_biobank m ON p.id_biobank = m.id_biobank
  LEFT JOIN {VISITS} v ON p.id_patient = v.px_id LEFT JOIN people d ON p.id_subject = d.id WHERE t.biobank_asal <> 'Biobank Pusat'),
sent AS (SELECT biosample_id, id, origin_code_repository, dense_rank() OVER (PARTITION BY origin_code_repository ORDER BY tanggal_formulir NULLS FIRST) AS dr FROM rows_ WHERE is_to_central_seq = 1 AND status_transfer_name = 'Dikirim')
SELECT r.biosample_id, r.id, strftime(r.tanggal_formulir, '%Y-%m-%d') AS tanggal_formulir, r.code_repository, r.origin_code_repository, r.id_subject, r.patient_biobank, r.patient_categ, r.registry_sex, r.age AS age_at_recruitment,
  CAST(year(r.tanggal_formulir) AS INTEGER) AS year_formulir, monthname(r.tanggal_penerimaan) AS month_penerimaan, CASE WHEN s.dr = 1 THEN s.origin_code_repository END AS origin_code_repository_non_dup, r.is_to_central_seq
FROM rows_ r LEFT JOIN sent s ON r.biosample_id = s.biosample_id AND r.id = s.id
UNION ALL
SELECT b.id, 'backdoor_form_id_1', '2025-05-19', b.code_repository, b.origin_code_repository, p.id_subject, m.biobank_nama, 'Control', d.sex, d.age, 2025, 'May', NULL, 0
FROM simbiox_biosamples b LEFT JOIN simbiox_patients p ON b.id_patient = p.id_patient LEFT JOIN master_biobank m ON p.id_biobank = m.id_biobank LEFT JOIN people d ON p.id_subject = d.id
WHERE b.origin_code_repository LIKE 'SKI%' OR b.code_repository LIKE 'SKI%'
""")
def _m15(t):
    out = transfer_report.run(DerivedTables(t))
    return out.select(
        "biosample_id", "id", day("tanggal_formulir").alias("tanggal_formulir"), "code_repository", "origin_code_repository", "id_subject", "patient_biobank", "patient_categ", "registry_sex", "age_at_recruitment",
        "year_formulir", "month_penerimaan", "origin_code_repository_non_dup", "is_to_central_seq",
    )


@check("gold_sheets_report", f"""
WITH {ctes('sheets_sequencing', 'staging_fix_ski_id_repo', 'staging_simbiox_biosamples_patients', 'regina_demography', 'phenovar_participants')},
x AS (SELECT coalesce(k.code_repository, s.code_repository) AS code, s.* EXCLUDE (code_repository) FROM sheets_sequencing s LEFT JOIN staging_fix_ski_id_repo k ON s.code_repository = k.new_origin_code_repository)
SELECT x.platform, x.code AS code_repository, x.extraction_status, x.sequencing_status, round(x.volume_remain, 2) AS volume_remain, strftime(x.extraction_date, '%Y-%m-%d %H:%M:%S') AS extraction_date,
  CASE WHEN r.id_subject IS NULL AND h.id_subject IS NULL THEN 'Not In Registry' ELSE 'In Registry' END AS registry_status, b.id_subject, b.origin_code_repository,
  CASE WHEN b.origin_code_repository IS NOT NULL AND row_number() OVER (PARTITION BY x.platform, b.origin_code_repository ORDER BY x.extraction_status, x.extraction_date) > 1 THEN 'Duplicate' END AS duplicate_origin_code_repo_status
FROM x LEFT JOIN staging_simbiox_biosamples_patients b ON x.code = b.code_repository LEFT JOIN regina_demography r ON b.id_subject = r.id_subject LEFT JOIN phenovar_participants h ON b.id_subject = h.id_subject
""")
def _m16(t):
    out = sheets_report.run(DerivedTables(t))
    return out.select(
        "platform", "code_repository", "extraction_status", "sequencing_status", cents("volume_remain").alias("volume_remain"), stamp("extraction_date").alias("extraction_date"), "registry_status", "id_subject",
        "origin_code_repository", "duplicate_origin_code_repo_status",
    )


@check("gold_lims_report", f"""
WITH {ctes('gold_qc', 'gold_pgx_report')}
SELECT g.id_repository, g.sequencer, CASE WHEN g.date_secondary IS NULL THEN 0 ELSE 1 END AS is_secondary_analysed, g.qc_strict_diagnosis AS qc_category,
  CASE WHEN coalesce(p.eng_report_creation_date, p.ind_report_creation_date) IS NULL THEN 0 ELSE 1 END AS is_tertiary_pgx_analysed
FROM gold_qc g LEFT JOIN gold_pgx_report p ON g.id_repository = p.id_repository
""")
def _m17(t):
    out = lims_report.run(DerivedTables(t))
    return out.withColumns({c: flag(c) for c in ("is_secondary_analysed", "is_tertiary_pgx_analysed")})


@check("gold_end_to_end", f"""
WITH {ctes('regina_demography_basic_info', 'decrypt_regina', 'simbiox_patients', 'master_biobank', 'provinsi', 'phenovar_participants', 'decrypted_phenovar_participants', 'simbiox_biosamples', 'simbiox_log_visit_biospc',
    'master_specimen', 'gold_qc', 'staging_pgx_report_status', 'staging_simbiox_biosamples_patients')},
homes AS (SELECT DISTINCT p.id_subject, {cases([(f"m.biobank_nama ILIKE {q('%' + k + '%')}", q(v)) for k, v in rules.BIOBANK_SITES], "m.biobank_nama")} AS home
  FROM simbiox_patients p LEFT JOIN master_biobank m ON p.id_biobank = m.id_biobank WHERE p.id_subject NOT IN ('', '-')),
people AS (
  SELECT i.id_subject, CAST(i.age_at_recruitment AS BIGINT) AS age, i.sex, coalesce({cases([(f"i.hospital_name = {q(h.upper())}", q(h)) for h in rules.UPPER_HOSPITALS])}, homes.home) AS hospital, v.name AS nik_province, i.demog_created_at AS enrolled
  FROM regina_demography_basic_info i JOIN decrypt_regina d ON i.id_subject = d.id_subject LEFT JOIN homes ON i.id_subject = homes.id_subject LEFT JOIN provinsi v ON substr(d.nik, 1, 2) = v.id
  WHERE hospital IS NOT NULL
  UNION ALL
  SELECT p.id_subject, date_sub('year', CAST(d.birth_date AS DATE), CAST(p.creation_date AS DATE)), p.sex, p.hospital_name, v.name, p.creation_date
  FROM phenovar_participants p JOIN decrypted_phenovar_participants d ON p.id_subject = d.id_subject LEFT JOIN provinsi v ON p.province_code = v.id),
visits AS (SELECT DISTINCT px_id, CASE WHEN kode_icd ILIKE 'z00%' THEN 'Control' ELSE 'Patient' END AS categ FROM simbiox_log_visit_biospc),
bank AS (SELECT p.id_subject, v.categ, count(b.code_repository) > 0 AS has_code, bool_or(c.specimen_type_name = 'Buffycoat') AS buffy, bool_or(c.specimen_type_name = 'Plasma EDTA') AS plasma, bool_or(c.specimen_type_name = 'Sputum') AS sputum, bool_or(c.specimen_type_name = 'Whole Blood') AS blood
  FROM simbiox_biosamples b LEFT JOIN simbiox_patients p ON b.id_patient = p.id_patient LEFT JOIN visits v ON p.id_patient = v.px_id LEFT JOIN master_specimen c ON b.biosample_specimen = c.id GROUP BY 1, 2),
qc AS (SELECT DISTINCT id_subject, sequencer, CASE WHEN qc_strict_status = 'Pass' THEN 1 ELSE 0 END AS passed FROM gold_qc),
reports AS (SELECT b.id_subject FROM staging_pgx_report_status s LEFT JOIN staging_simbiox_biosamples_patients b ON s.id_repository = b.code_repository)
SELECT p.id_subject, p.age AS age_at_recruitment, p.sex, p.hospital AS hospital_name, p.nik_province, strftime(p.enrolled, '%Y-%m-%d') AS enrollment_date, CAST(coalesce(k.has_code, false) AS INTEGER) AS biobank_available, k.categ AS patient_categ,
  CAST(k.buffy AS INTEGER) AS is_buffycoat, CAST(k.plasma AS INTEGER) AS is_plasma, CAST(k.sputum AS INTEGER) AS is_sputum, CAST(k.blood AS INTEGER) AS is_whole_blood,
  CASE WHEN c.id_subject IS NULL THEN 0 ELSE 1 END AS is_secondary_analysed, c.passed AS is_qc_secondary_analysed, c.sequencer AS secondary_sequencer, CASE WHEN r.id_subject IS NULL THEN 0 ELSE 1 END AS is_pgx_created
FROM people p LEFT JOIN bank k ON p.id_subject = k.id_subject LEFT JOIN qc c ON p.id_subject = c.id_subject LEFT JOIN reports r ON p.id_subject = r.id_subject
""")
def _m18(t):
    return end_to_end.run(DerivedTables(t)).withColumn("enrollment_date", day("enrollment_date"))
