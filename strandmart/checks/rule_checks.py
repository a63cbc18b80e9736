"""Classification rules, on columns made from the test tables."""

from pyspark.sql import functions as F

from strandmart.checks.registry import check, flag
from strandmart.functions import clearance, qc_rules, rules
from strandmart.operators.aggregates import flag_counts, group_totals
from strandmart.settings import Buckets, Settings


def q(value):
    """SQL text literal."""
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def cases(pairs, default="NULL"):
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {default} END"


# --- sample quality -------------------------------------------------------

SAMPLES = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_suppkey AS id_library,
  CASE CAST(l_linenumber % 3 AS INT) WHEN 0 THEN 'ONT' WHEN 1 THEN 'Illumina' ELSE 'MGI' END AS sequencer,
  CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 11 = 1 THEN 0 ELSE l_quantity END AS coverage,
  CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 13 = 1 THEN 0 ELSE 75 + l_orderkey % 22 END AS at_least_10x,
  CASE WHEN l_partkey % 5 = 0 THEN NULL WHEN l_partkey % 5 = 1 THEN 'nan' ELSE 'c.cram' END AS cram,
  CASE WHEN l_partkey % 4 = 0 THEN 500 ELSE 2000000000 END AS cram_size,
  CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE 'v.vcf' END AS vcf,
  CASE WHEN l_suppkey % 3 = 0 AND l_orderkey % 199 <> 0 THEN 'XX' WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_orderkey % 17 = 1 THEN '' WHEN l_orderkey % 17 = 2 THEN 'NAN'
       WHEN l_orderkey % 2 = 0 THEN 'XX' ELSE 'XY' END AS ploidy_estimation,
  CASE WHEN l_suppkey % 3 = 0 AND l_orderkey % 199 <> 1 THEN 'Female' WHEN l_orderkey % 19 = 0 THEN NULL WHEN l_suppkey % 7 = 1 AND l_orderkey % 2 = 1 THEN 'FEMALE'
       WHEN l_orderkey % 2 = 0 THEN 'Female' ELSE 'male' END AS sex,
  CASE WHEN l_partkey % 8 = 0 THEN NULL WHEN l_partkey % 8 = 1 THEN '0' ELSE CAST(CAST(l_quantity AS BIGINT) * 2000000000 AS STRING) END AS sum_of_total_passed_bases,
  CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE 'run' END AS run_name
FROM lineitem
"""
REASON_ROWS = ", ".join(
    f"({i}, {', '.join(q('*' if v == '*' else int(v) if isinstance(v, bool) else v) for v in row)})"
    for i, row in enumerate(qc_rules.REASONS)
)
QC_STEPS = f"""
samples AS ({SAMPLES}),
paired AS (SELECT *, CASE
    WHEN sex IS NULL AND NOT coalesce(false, false) THEN 'No Data'
    WHEN ploidy_estimation = 'XX' AND lower(sex) = 'female' THEN 'Match'
    WHEN ploidy_estimation = 'XY' AND lower(sex) = 'male' THEN 'Match'
    WHEN coalesce(ploidy_estimation, '') IN ('', 'NAN') THEN 'No Data' ELSE 'Mismatch' END AS pair FROM samples),
batched AS (SELECT *, CASE WHEN m > 2 THEN 'Fail' WHEN m + n <= 2 THEN 'Pass' ELSE 'Incomplete Data' END AS batch FROM (
  SELECT *, count(*) FILTER (pair = 'Mismatch') OVER (PARTITION BY id_library) AS m,
            count(*) FILTER (pair = 'No Data') OVER (PARTITION BY id_library) AS n FROM paired)),
covered AS (SELECT *,
  CASE WHEN coverage >= 30 AND at_least_10x >= 85 THEN 'Pass'
       WHEN coverage = 0 AND cram_size < 1000000000 AND cram <> 'nan' AND vcf <> 'nan' THEN 'Fail' ELSE 'No Data' END AS cov,
  CASE WHEN coverage >= 30 AND at_least_10x >= 85 THEN 'High Coverage' WHEN coverage >= 30 AND at_least_10x >= 80 THEN 'Mid Coverage'
       WHEN coverage >= 20 AND at_least_10x >= 80 THEN 'Mid Coverage' WHEN coverage > 0 THEN 'Low Coverage'
       WHEN at_least_10x > 0 THEN 'Low Coverage' ELSE 'No Data' END AS cls,
  coalesce(coverage, 0) = 0 AND coalesce(at_least_10x, 0) = 0 AS no_cov,
  coalesce(sex, '') = '' AS no_sex, coalesce(ploidy_estimation, '') = '' AS no_ploidy,
  CASE WHEN sequencer <> 'ONT' THEN '' WHEN coalesce(CAST(sum_of_total_passed_bases AS DOUBLE), 0) = 0 THEN 'No Yield'
       WHEN CAST(sum_of_total_passed_bases AS DOUBLE) < 6e10 THEN 'Yield < 60GB'
       WHEN CAST(sum_of_total_passed_bases AS DOUBLE) < 9e10 THEN '60GB ≤ Yield < 90GB' ELSE 'High Yield' END AS yields
  FROM batched),
reasons AS (SELECT * FROM (VALUES {REASON_ROWS}) v(ord, r_cov, r_batch, r_pair, r_sex, r_ploidy, reason))
"""


@check("qc_rules", f"""
WITH {QC_STEPS}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, pair AS sex_ploidy_category, batch AS batch_sex_category,
  cov AS coverage_category, cls AS coverage_class, CAST(no_cov AS INTEGER) AS coverage_missing,
  CAST(no_sex AS INTEGER) AS sex_missing, CAST(no_ploidy AS INTEGER) AS ploidy_missing, yields AS ont_yield_status,
  CASE WHEN pair = 'Mismatch' OR batch = 'Fail' OR cov = 'Fail' THEN 'Fail'
       WHEN cov = 'Pass' AND batch = 'Pass' AND pair = 'Match' THEN 'Pass' ELSE 'Incomplete Data' END AS qc_strict_status,
  CASE WHEN pair = 'Mismatch' OR batch = 'Fail' OR cov = 'Fail' THEN 'Fail'
       WHEN cov = 'Pass' AND batch = 'Pass' AND pair = 'Match' THEN 'Pass'
       WHEN (no_cov OR no_ploidy) AND no_sex THEN 'Stalled: Registry/Analysis'
       WHEN no_cov OR no_ploidy THEN 'Stalled: Analysis' WHEN no_sex THEN 'Stalled: Registry'
       ELSE 'Stalled: Batch Analysis' END AS qc_strict_progress,
  CASE WHEN pair = 'Mismatch' OR batch = 'Fail' THEN 'Blacklisted'
       WHEN cov = 'Pass' AND batch = 'Pass' AND pair = 'Match' THEN 'Whitelisted' WHEN cov = 'Pass' THEN 'Graylisted'
       WHEN yields LIKE '60GB%' THEN 'Top Up List' WHEN yields LIKE 'Yield%' THEN 'Blacklisted'
       WHEN cov = 'Fail' AND batch = 'Pass' AND pair = 'Match' AND sequencer = 'Illumina' AND coverage < 20 THEN 'Blacklisted'
       WHEN cov = 'Fail' AND batch = 'Pass' AND pair = 'Match' THEN 'Top Up List' ELSE 'Graylisted' END AS qc_strict_color,
  (SELECT arg_min(reason, ord) FROM reasons WHERE r_cov IN ('*', cov) AND r_batch IN ('*', batch) AND r_pair IN ('*', pair)
      AND r_sex IN ('*', CAST(CAST(no_sex AS INTEGER) AS VARCHAR)) AND r_ploidy IN ('*', CAST(CAST(no_ploidy AS INTEGER) AS VARCHAR))) AS qc_strict_reason,
  CASE WHEN cov = 'Pass' AND batch = 'Pass' AND pair = 'Match' THEN 'Pass'
       WHEN cov = 'Fail' AND pair = 'Mismatch' THEN 'Fail (Coverage and Sex Check)'
       WHEN cov = 'Fail' AND pair = 'Match' AND batch = 'Fail' THEN 'Fail (Coverage and Batch Sex Check)'
       WHEN cov = 'Fail' THEN 'Fail (Coverage QC)' WHEN pair = 'Mismatch' THEN 'Fail (Sex Check)'
       WHEN batch = 'Fail' THEN 'Fail (Batch Sex Check)' WHEN cov = 'Pass' THEN 'Incomplete Data'
       WHEN no_cov OR no_sex OR no_ploidy THEN 'Incomplete Data' ELSE 'Undefined' END AS qc_strict_diagnosis,
  CASE WHEN sequencer = 'ONT' AND CAST(sum_of_total_passed_bases AS DOUBLE) < 9e10 THEN 'Primary Analyzed - Top Up'
       WHEN run_name IS NULL THEN 'Primary Analyzed'
       WHEN batch = 'Pass' AND (coverage < 30 OR at_least_10x < 90) THEN 'Secondary Analyzed - Top Up'
       ELSE 'Secondary Analyzed' END AS progress,
  CASE WHEN batch = 'Pass' AND pair = 'Match' AND cls <> 'No Data' THEN split_part(cls, ' ', 1) || ' Pass'
       WHEN pair = 'Mismatch' OR batch = 'Fail' THEN 'Fail' ELSE 'No Data' END AS qc_coverage_tier
FROM covered
""")
def _qc(t):
    rows = t.sql(SAMPLES).withColumn("sex_ploidy_category", qc_rules.pair_category("ploidy_estimation", "sex"))
    totals = {
        "m": F.count_if(F.col("sex_ploidy_category") == "Mismatch"),
        "n": F.count_if(F.col("sex_ploidy_category") == "No Data"),
    }
    rows = group_totals(rows, ["id_library"], totals)
    rows = qc_rules.add_qc_labels(rows.withColumn("batch_sex_category", qc_rules.batch_category("m", "n")))
    flags = ("coverage_missing", "sex_missing", "ploidy_missing")
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "sex_ploidy_category", "batch_sex_category",
        "coverage_category", "coverage_class", *[flag(f).alias(f) for f in flags], "ont_yield_status",
        "qc_strict_status", "qc_strict_progress", "qc_strict_color", "qc_strict_reason", "qc_strict_diagnosis",
        "progress", "qc_coverage_tier",
    )


# --- clearances and titles ------------------------------------------------

CLEARANCES = """
SELECT p_partkey, TIMESTAMP '2022-01-01 00:00:00' + p_size * INTERVAL '30' DAY AS logged_at,
  CASE CAST(p_partkey % 15 AS INT)
    WHEN 0 THEN 'No. 1/un14.2.2.vii.14/lt/2024' WHEN 1 THEN 'x VII.14/LT/2022' WHEN 2 THEN 'a KEPK/XII/2022 b'
    WHEN 3 THEN 'KE/FK/0017/EC/2023' WHEN 4 THEN 'KET-1203/UN2.F1/ETIK/PPM.00.02' WHEN 5 THEN ' KET-42/UN2.F1/ETIK/PPM.00.02/2023 '
    WHEN 6 THEN 'KET-872/UN2.F1/ETIK/PPM.00.02/2022' WHEN 7 THEN 'LB.02.01/KEP/042/2022.' WHEN 8 THEN 'S-252/UN2.F1/ETIK/PPM.00.02/2024'
    WHEN 9 THEN 'Studi Genomik pada Pasien Diabetes Melitus Awitan Usia Muda' WHEN 10 THEN NULL ELSE 'other ' || p_name END AS number,
  CASE CAST(p_size % 7 AS INT)
    WHEN 0 THEN 'Analisis Genomik pada Psoriasis ' || p_type WHEN 1 THEN 'Manusia dan Mycobacterium'
    WHEN 2 THEN 'Studi Genomik pada Pasien Diabetes Melitus Dewasa'
    WHEN 3 THEN 'GERCEP (Genomik Kanker untuk Pencegahan dan Terapi Presisi) BGSI Rumah Sakit Kanker Dharmais 2022 - 2023'
    WHEN 4 THEN 'Clopidogrel Resistance Study in Ischemic Stroke of Indonesian Population; ' || p_type
    WHEN 5 THEN '(AMI) Polygenic Risk Score (PRS) ' || p_type ELSE p_type END AS title,
  CASE WHEN p_partkey % 4 = 0 THEN 'KET-872/UN2.F1/ETIK/PPM.00.02/2022' ELSE p_brand END AS investigator
FROM part
"""


def _clearance_case(column):
    """The rule tables as one CASE per column."""
    pairs = [(f"number ILIKE {q(p)}", q(getattr(s, column))) for p, s in clearance.NUMBER_RULES]
    pattern, study = clearance.PI_RULE
    pairs.append((f"investigator ILIKE {q(pattern)}", q(getattr(study, column))))
    for pattern, before, since in clearance.SERIES_RULES:
        like = f"title ILIKE {q(pattern)} AND year(logged_at)"
        pairs.append((f"{like} < {clearance.SERIES_YEAR}", q(getattr(before, column))))
        pairs.append((f"{like} >= {clearance.SERIES_YEAR}", q(getattr(since, column))))
    for pattern, other, missing, study, columns in clearance.TITLE_RULES:
        if column in columns:
            null = f"number IS NULL OR" if missing else "number IS NOT NULL AND"
            pairs.append((f"title ILIKE {q(pattern)} AND ({null} NOT number ILIKE {q(other)})", q(getattr(study, column))))
    return cases(pairs, column)


TITLE_CASE = cases([(f"title ILIKE {q(p)} AND title NOT LIKE '%;%'", q(n)) for p, n in clearance.TITLE_GROUPS], "title")


@check("normalise_rules", f"""
SELECT p_partkey, {_clearance_case('number')} AS number, {_clearance_case('title')} AS title,
       {_clearance_case('investigator')} AS investigator, {TITLE_CASE} AS title_group
FROM ({CLEARANCES})
""")
def _clearance(t):
    rows = t.sql(CLEARANCES)
    out = clearance.normalise_clearance("number", "title", "investigator", "logged_at")
    return rows.select(
        "p_partkey", *[c.alias(n) for n, c in out.items()], clearance.title_group("title").alias("title_group")
    )


# --- hospitals, participants, places --------------------------------------

SITE = Settings().central_site
PEOPLE = """
SELECT c_custkey,
  CASE CAST(c_custkey % 13 AS INT) WHEN 0 THEN 'a@rspon.id' WHEN 1 THEN 'b@sardjitohospital.id' WHEN 2 THEN 'rscm' WHEN 3 THEN 'x.rsabhk'
    WHEN 4 THEN 'dharmais' WHEN 5 THEN 'pjnhk' WHEN 6 THEN 'admin@x' WHEN 7 THEN 'profngoerahhospitalbali' WHEN 8 THEN 'rspisuliantisaroso'
    WHEN 9 THEN 'rsuppersahabatan' WHEN 10 THEN 'sintayunita' ELSE c_name END AS email,
  CASE CAST(c_custkey % 8 AS INT) WHEN 0 THEN 'RS_KANKER_DHARMAIS' WHEN 1 THEN 'RS_PERSAHABATAN' WHEN 2 THEN 'RS_PON' WHEN 3 THEN 'RS_SANGLAH'
    WHEN 4 THEN 'RS_SARDJITO' WHEN 5 THEN 'RS_SULIANTI_SAROSO' WHEN 6 THEN 'RSCM' ELSE c_mktsegment END AS code,
  CASE CAST(c_custkey % 9 AS INT) WHEN 0 THEN 'Biobank RSCM' WHEN 1 THEN 'Biobank RSPI Prof. Dr. Sulianti Saroso; other' WHEN 2 THEN 'RSUP Dr. Sardjito'
    WHEN 3 THEN 'RS PON Prof. Dr. dr. Mahar Mardjono' WHEN 4 THEN 'Biobank RSUP Persahabatan' WHEN 5 THEN 'Biobank RS Kanker Dharmais'
    WHEN 6 THEN 'Biobank RSUP Prof. Dr. IGNG Ngoerah Denpasar' ELSE c_mktsegment END AS biobank,
  CASE WHEN c_custkey % 3 = 0 THEN 'RS KANKER DHARMAIS' ELSE c_mktsegment END AS upper_name,
  CASE CAST(c_custkey % 4 AS INT) WHEN 0 THEN 'Survei Kesehatan Indonesia (SKI) 2023' WHEN 1 THEN NULL ELSE c_mktsegment END AS title,
  CASE CAST(c_custkey % 5 AS INT) WHEN 0 THEN 'POPULASI UMUM' WHEN 1 THEN NULL WHEN 2 THEN ' PASIEN ' ELSE 'KONTROL' END AS registry,
  CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN 'KONTROL' WHEN 1 THEN 'PASIEN' ELSE NULL END AS biobank_type,
  CASE CAST(c_nationkey % 6 AS INT) WHEN 0 THEN 'YOGYAKARTA' WHEN 1 THEN 'RIAU' WHEN 2 THEN 'KEP. BANGKA BELITUNG' WHEN 3 THEN '-' WHEN 4 THEN '' ELSE 'BALI' END AS province,
  CASE CAST(c_nationkey % 6 AS INT) WHEN 0 THEN 'ID-PD' WHEN 1 THEN 'ID-PS' WHEN 2 THEN 'ID-PT' WHEN 3 THEN 'ID-PE' WHEN 4 THEN NULL ELSE 'ID-BA' END AS iso,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 2 = 0 END AS site_excluded,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey % 3 = 0 END AS subject_excluded
FROM customer
"""


# Golden values, by the forms that PEOPLE gives to a customer's number; not from the engine's tables.
@check("hospital_rules", f"""
SELECT c_custkey,
  CASE CAST(c_custkey % 13 AS INT) WHEN 0 THEN 'RS PON Prof. Dr. dr. Mahar Mardjono' WHEN 1 THEN 'RSUP Dr. Sardjito' WHEN 2 THEN 'RS Dr. Cipto Mangunkusumo'
    WHEN 3 THEN 'PKIAN RSAB Harapan Kita' WHEN 4 THEN 'RS Kanker Dharmais' WHEN 5 THEN 'RSPJD Harapan Kita' WHEN 6 THEN {q(SITE)} WHEN 7 THEN 'RSUP Prof. Dr. IGNG Ngoerah Denpasar'
    WHEN 8 THEN 'RSPI Prof. Dr. Sulianti Saroso' WHEN 9 THEN 'RSUP Persahabatan' WHEN 10 THEN {q(SITE)} ELSE 'Unknown' END AS by_email,
  CASE CAST(c_custkey % 8 AS INT) WHEN 0 THEN 'RS Kanker Dharmais' WHEN 1 THEN 'RSUP Persahabatan' WHEN 2 THEN 'RS PON Prof. Dr. dr. Mahar Mardjono'
    WHEN 3 THEN 'RSUP Prof. Dr. IGNG Ngoerah Denpasar' WHEN 4 THEN 'RSUP Dr. Sardjito' WHEN 5 THEN 'RSPI Prof. Dr. Sulianti Saroso' WHEN 6 THEN 'RS Dr. Cipto Mangunkusumo' END AS by_code,
  CASE CAST(c_custkey % 9 AS INT) WHEN 0 THEN 'RS Dr. Cipto Mangunkusumo' WHEN 1 THEN 'RSPI Prof. Dr. Sulianti Saroso' WHEN 2 THEN 'RSUP Dr. Sardjito'
    WHEN 3 THEN 'RS PON Prof. Dr. dr. Mahar Mardjono' WHEN 4 THEN 'RSUP Persahabatan' WHEN 5 THEN 'RS Kanker Dharmais' WHEN 6 THEN 'RSUP Prof. Dr. IGNG Ngoerah Denpasar'
    ELSE biobank END AS by_biobank,
  CASE WHEN c_custkey % 3 = 0 THEN 'RS Kanker Dharmais' END AS by_name,
  regexp_replace(regexp_replace(biobank, 'Biobank ', ''), '; .+', '') AS first_site
FROM ({PEOPLE})
""")
def _hospitals(t):
    return t.sql(PEOPLE).select(
        "c_custkey", rules.hospital_from_email("email", SITE).alias("by_email"),
        rules.hospital_from_code("code").alias("by_code"), rules.hospital_from_biobank("biobank").alias("by_biobank"),
        rules.hospital_from_upper("upper_name").alias("by_name"), rules.first_biobank_site("biobank").alias("first_site"),
    )


@check("participant_rules", f"""
SELECT c_custkey,
  CASE WHEN title = 'Survei Kesehatan Indonesia (SKI) 2023' AND own <> 'POPULASI UMUM' THEN 'POPULASI UMUM'
       WHEN coalesce(title, '') <> 'Survei Kesehatan Indonesia (SKI) 2023' AND site = {q(SITE)} AND biobank_type = 'KONTROL' THEN 'POPULASI UMUM'
       WHEN coalesce(title, '') <> 'Survei Kesehatan Indonesia (SKI) 2023' AND own = 'POPULASI UMUM' THEN 'KONTROL' ELSE own END AS kind,
  CASE province WHEN 'YOGYAKARTA' THEN 'DAERAH ISTIMEWA YOGYAKARTA' WHEN 'RIAU' THEN 'KEPULAUAN RIAU'
       WHEN 'KEP. BANGKA BELITUNG' THEN 'KEPULAUAN BANGKA BELITUNG' WHEN '-' THEN NULL WHEN '' THEN NULL ELSE province END AS province,
  CASE WHEN iso = 'ID-PD' THEN 'ID-PB' WHEN iso LIKE 'ID-P_' THEN 'ID-PA' ELSE iso END AS iso,
  CAST(coalesce(site_excluded, false) OR coalesce(subject_excluded, false) AS INTEGER) AS excluded,
  CASE WHEN coalesce(site_excluded, false) THEN 'TB Exclusion due to not having BC/Plasma' ELSE title END AS reason
FROM (SELECT *, trim(coalesce(registry, biobank_type)) AS own, CASE WHEN c_custkey % 13 IN (6, 10) THEN {q(SITE)} ELSE 'else' END AS site FROM ({PEOPLE}))
""")
def _participants(t):
    rows = t.sql(PEOPLE).withColumn("site", rules.hospital_from_email("email", SITE))
    return rows.select(
        "c_custkey", rules.participant_type("title", "registry", "biobank_type", "site", SITE).alias("kind"),
        rules.province_name("province").alias("province"), rules.province_iso("iso").alias("iso"),
        flag(rules.exclusion("site_excluded", "subject_excluded")).alias("excluded"),
        rules.exclusion_reason("site_excluded", "title").alias("reason"),
    )


@check("recruitment_targets", """
SELECT c_custkey, CASE CAST(c_custkey % 13 AS INT) WHEN 0 THEN 1950 WHEN 1 THEN 900 WHEN 2 THEN 3800 WHEN 3 THEN 1500 WHEN 4 THEN 4800 WHEN 5 THEN 1000
  WHEN 6 THEN 2468 WHEN 7 THEN 1400 WHEN 8 THEN 1250 WHEN 9 THEN 1250 WHEN 10 THEN 2468 END AS target
FROM customer
""")
def _targets(t):
    from strandmart.plans.staging.demography import with_target

    rows = t.sql(PEOPLE).select("c_custkey", rules.hospital_from_email("email", SITE).alias("hospital_name"))
    return with_target(rows, SITE).select("c_custkey", F.col("hub_target").alias("target"))


# --- small rules ----------------------------------------------------------

STATES = """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END AS requested,
  CASE WHEN o_orderkey % 5 < 2 THEN NULL ELSE o_orderdate END AS english,
  CASE WHEN o_orderkey % 7 < 3 THEN NULL ELSE o_orderdate END AS local,
  CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'Z00.1' WHEN 1 THEN 'z001' WHEN 2 THEN NULL ELSE 'A15' END AS icd,
  CAST(o_orderkey % 7 AS INT) AS category,
  CAST(o_custkey % 2 AS INT) AS is_biobank,
  CASE CAST(o_custkey % 5 AS INT) WHEN 0 THEN 'Biobank Pusat' WHEN 1 THEN 'Biobank Sentral (BB Binomika)' ELSE 'Biobank X' END AS origin,
  CASE CAST(o_orderkey % 6 AS INT) WHEN 0 THEN 'ctl-Control' WHEN 1 THEN 'GK-P5 x' WHEN 2 THEN 'T011' ELSE 'S' || CAST(o_orderkey AS STRING) END AS sample,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Perempuan' WHEN o_orderkey % 3 = 0 THEN 'Laki-laki' ELSE 'x' END AS word
FROM orders
"""


@check("small_rules", f"""
SELECT o_orderkey,
  CASE WHEN requested IS NULL AND english IS NULL AND local IS NULL THEN 'Uncompleted Run' WHEN requested IS NULL THEN NULL
       WHEN english IS NULL AND local IS NULL THEN 'Failed Run' ELSE 'Successful Run' END AS pgx_status,
  CASE WHEN lower(icd) LIKE 'z00%' THEN 'Control' ELSE 'Patient' END AS visit,
  CASE WHEN english IS NULL AND local IS NULL THEN 'Not In Registry' ELSE 'In Registry' END AS registry,
  CASE category WHEN 1 THEN 'Change Prescription' WHEN 2 THEN 'Increase Starting Dose' WHEN 3 THEN 'Decrease Starting Dose'
       WHEN 4 THEN 'Increase Monitoring' WHEN 5 THEN 'Follow Standard Dosing' END AS dose,
  CASE WHEN is_biobank = 0 AND origin <> 'Biobank X' THEN 1 ELSE 0 END AS to_central,
  CASE WHEN o_orderkey % 6 < 3 THEN 1 ELSE 0 END AS control_sample,
  CASE word WHEN 'Perempuan' THEN 'FEMALE' WHEN 'Laki-laki' THEN 'MALE' END AS sex
FROM ({STATES})
""")
def _small(t):
    return t.sql(STATES).select(
        "o_orderkey", rules.pgx_status("requested", "english", "local").alias("pgx_status"),
        rules.visit_category("icd").alias("visit"), rules.registry_status("english", "local").alias("registry"),
        rules.dose_text("category").alias("dose"), rules.central_sequencing("is_biobank", "origin").alias("to_central"),
        flag(rules.is_control_sample("sample")).alias("control_sample"), rules.sex_from_word("word").alias("sex"),
    )


SPECIMEN_ROWS = "SELECT o_custkey, o_orderkey, " + cases(
    [(f"o_orderkey % 12 = {i}", q(w)) for i, w in enumerate(rules.SPECIMENS.values())], "'Other'"
) + " AS specimen FROM orders"


@check("specimen_flags", "SELECT o_custkey, " + ", ".join(
    f"count(*) FILTER (specimen = {q(w)}) AS count_{n}" for n, w in rules.SPECIMENS.items()
) + f" FROM ({SPECIMEN_ROWS}) GROUP BY o_custkey")
def _specimens(t):
    flags = {n: rules.specimen_flag("specimen", w) == 1 for n, w in rules.SPECIMENS.items()}
    return flag_counts(t.sql(SPECIMEN_ROWS), ["o_custkey"], flags)


# --- names of samples and runs -------------------------------------------

HEX = "'2dd6b9ea-9e2b-4a69-8b54-6a4980054643'"
RUNS = f"""
SELECT o_orderkey, 'C' || lpad(CAST(o_orderkey AS STRING), 11, '0') AS code,
  CASE CAST(o_orderkey % 4 AS INT)
    WHEN 0 THEN 'C' || lpad(CAST(o_orderkey AS STRING), 11, '0') || '_5d61bff4_rerun_2024-08-13_013035-DRAGEN_Germline_WGS_4-2-7_sw-mode-JK-' || {HEX}
    WHEN 1 THEN 'C' || lpad(CAST(o_orderkey AS STRING), 11, '0') || '-1-DRAGEN-4-2-6-Germline-All-Callers-DRAGEN_Germline_WGS_4-2-6-v2_sw'
    WHEN 2 THEN 'C' || lpad(CAST(o_orderkey AS STRING), 11, '0') || '_fe14319c_rerun_2025-02-26_043012-' || {HEX}
    ELSE 'C' || lpad(CAST(o_orderkey AS STRING), 11, '0') || '_aa-bb-cc' END AS folder,
  CASE CAST(o_orderkey % 4 AS INT)
    WHEN 0 THEN 'SKI_' || CAST(o_orderkey AS STRING) || '_9efb681c' WHEN 1 THEN 'C' || CAST(o_orderkey AS STRING) || '_250209_M_1a75a295'
    WHEN 2 THEN 'C' || CAST(o_orderkey AS STRING) || '-1-DRAGEN-4-2-6-Germline-All' ELSE 'C' || CAST(o_orderkey AS STRING) || '_8b688247' END AS run,
  CASE CAST(o_orderkey % 4 AS INT)
    WHEN 0 THEN 'SKI_' || CAST(o_orderkey AS STRING) || '_9efb' WHEN 1 THEN 'C' || CAST(o_orderkey AS STRING) || '_250205_M'
    WHEN 2 THEN 'DRAGEN' || CAST(o_orderkey AS STRING) || '-x' ELSE 'C' || CAST(o_orderkey AS STRING) || '_8b' END AS reference
FROM orders
"""


@check("run_names", f"""
SELECT o_orderkey,
  CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN code || '_5d61bff4_rerun_2024-08-13_013035' WHEN 1 THEN code || '-1-DRAGEN-4-2-6-Germline-All-Callers'
       WHEN 2 THEN code || '_fe14319c_rerun_2025-02-26_043012' ELSE code || '_aa' END AS run_of_folder,
  CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'SKI_' || CAST(o_orderkey AS VARCHAR) WHEN 1 THEN 'C' || CAST(o_orderkey AS VARCHAR) || '_250209_M'
       ELSE 'C' || CAST(o_orderkey AS VARCHAR) END AS sample_of_run,
  CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'SKI_' || CAST(o_orderkey AS VARCHAR) WHEN 1 THEN reference
       WHEN 2 THEN 'DRAGEN' || CAST(o_orderkey AS VARCHAR) ELSE 'C' || CAST(o_orderkey AS VARCHAR) END AS sample_of_reference
FROM ({RUNS})
""")
def _runs(t):
    return t.sql(RUNS).select(
        "o_orderkey", rules.run_from_folder("folder").alias("run_of_folder"),
        rules.sample_from_run("run").alias("sample_of_run"), rules.sample_from_reference("reference").alias("sample_of_reference"),
    )


B = Buckets()
PATHS = f"""
SELECT o_orderkey, CASE CAST(o_orderkey % 7 AS INT)
  WHEN 0 THEN 's3://{B.citus_liquid}/C' || CAST(o_orderkey AS STRING) || '_9fb9-x/C.cram'
  WHEN 1 THEN 's3://{B.dragen_liquid}/pro/analysis/C' || CAST(o_orderkey AS STRING) || '_9fb9-y/C/C.cram'
  WHEN 2 THEN 's3://{B.dragen_liquid}/C' || CAST(o_orderkey AS STRING) || '_9fb9-z/C.cram'
  WHEN 3 THEN 's3://{B.citus}/C' || CAST(o_orderkey AS STRING) || '_a-b/C.cram'
  WHEN 4 THEN 's3://{B.ont_output}/C' || CAST(o_orderkey AS STRING) || '_a-b/C.cram'
  WHEN 5 THEN 's3://{B.illumina}/pro/analysis/C' || CAST(o_orderkey AS STRING) || '_9fb9-w/C/C.cram'
  ELSE '/tmp/C.cram' END AS path
FROM orders
"""


@check("path_ids", f"""
SELECT o_orderkey,
  CASE WHEN o_orderkey % 7 = 6 THEN '' ELSE 'C' || CAST(o_orderkey AS VARCHAR) END AS id_repository,
  CASE WHEN o_orderkey % 7 = 6 THEN '' WHEN o_orderkey % 7 IN (3, 4) THEN 'C' || CAST(o_orderkey AS VARCHAR) || '_a-b'
       ELSE 'C' || CAST(o_orderkey AS VARCHAR) || '_9fb9' END AS run_name
FROM ({PATHS})
""")
def _paths(t):
    rows = t.sql(PATHS).withColumn("ids", rules.sample_and_run_from_path("path", B))
    return rows.select("o_orderkey", "ids.*")
