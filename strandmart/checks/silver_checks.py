"""Silver clean-ups, on raw frames derived from the test tables."""

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from strandmart.checks.registry import check, day, stamp
from strandmart.checks.rule_checks import RUNS
from strandmart.plans import silver
from strandmart.plans.silver import SPECS
from strandmart.session import shared_folder
from strandmart.settings import Buckets

B = Buckets()


def run_ts():
    return F.lit("2025-03-02 00:00:00").cast("timestamp")


def clean(df, name):
    return silver.silver(df, SPECS[name], run_ts())


def text(c):
    return F.col(c).cast("string")


@check("silver_common", """
SELECT DISTINCT o_custkey, o_orderstatus, '2025-03-02 00:00:00' AS created_at, '2025-03-02 00:00:00' AS updated_at FROM orders
""")
def _common(t):
    out = clean(t["orders"].select("o_custkey", "o_orderstatus"), "plain")
    return out.withColumns({c: stamp(c) for c in silver.AUDIT})


@check("silver_as_text", """
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS o_custkey, coalesce(nullif(o_orderstatus, 'P'), '') AS status, 'x' AS created_at, 'x' AS updated_at FROM orders
""")
def _text(t):
    rows = t["orders"].select("o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.lit("x").alias("created_at"), F.lit("x").alias("updated_at"))
    return silver.as_text(clean(rows, "plain"))


@check("silver_runs", """
SELECT o_orderkey AS session_id, 'LP' || CAST(o_custkey AS VARCHAR) AS id_library, o_orderstatus AS id_repository FROM orders
""")
def _bssh(t):
    rows = t["orders"].select(
        F.col("o_orderkey").alias("session_id"), F.concat(F.lit("LP"), text("o_custkey")).alias("experiment_name"),
        F.col("o_orderstatus").alias("biosample_name"),
    )
    return clean(rows, "bssh").select("session_id", "id_library", "id_repository")


@check("silver_lane_quality", """
SELECT DISTINCT l_orderkey AS id_repository, l_linenumber AS lane, l_returnflag AS "index", l_linestatus AS index2, 1 AS read_number,
  l_partkey AS yield, l_suppkey AS yield_q30, l_quantity AS quality_score_sum, l_tax AS mean_quality_score_pf, l_discount AS percent_q30,
  'LP' AS id_library FROM lineitem
""")
def _quality(t):
    c = F.col
    rows = t["lineitem"].select(
        c("l_discount").alias("% Q30"), c("l_orderkey").alias("SampleID"), c("l_linenumber").alias("Lane"),
        c("l_returnflag").alias("index"), c("l_linestatus").alias("index2"), F.lit(1).alias("ReadNumber"),
        c("l_partkey").alias("Yield"), c("l_suppkey").alias("YieldQ30"), c("l_quantity").alias("QualityScoreSum"),
        c("l_tax").alias("Mean Quality Score (PF)"), F.lit("LP").alias("id_library"),
    )
    return clean(rows, "illumina_quality").drop(*silver.AUDIT)


@check("silver_demultiplex", """
SELECT DISTINCT l_orderkey AS id_repository, l_linenumber AS lane, l_returnflag AS "index", l_partkey AS reads, l_suppkey AS perfect_index_reads,
  l_quantity AS one_mismatch_index_reads, 0 AS two_mismatch_index_reads, l_tax AS percent_reads, l_discount AS percent_perfect_index_reads,
  CAST(0.5 AS DOUBLE) AS percent_one_mismatch_index_reads, CAST(0.25 AS DOUBLE) AS percent_two_mismatch_index_reads, 'LP' AS id_library FROM lineitem
""")
def _demux(t):
    c = F.col
    rows = t["lineitem"].select(
        c("l_orderkey").alias("SampleID"), c("l_linenumber").alias("Lane"), c("l_returnflag").alias("Index"), c("l_partkey").alias("# Reads"),
        c("l_suppkey").alias("# Perfect Index Reads"), c("l_quantity").alias("# One Mismatch Index Reads"),
        F.lit(0).alias("# Two Mismatch Index Reads"), c("l_tax").alias("% Reads"), c("l_discount").alias("% Perfect Index Reads"),
        F.lit(0.5).alias("% One Mismatch Index Reads"), F.lit(0.25).alias("% Two Mismatch Index Reads"), F.lit("LP").alias("id_library"),
    )
    return clean(rows, "illumina_demultiplex").drop(*silver.AUDIT)


def _filled(rows, names, known):
    """Report columns of a wide QC file; unknown ones are zero."""
    return rows.withColumns({raw: known.get(raw, F.lit(0.0)) for raw in names})


@check("silver_illumina_qc", f"""
SELECT code AS id_repository, CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN code || '_5d61bff4_rerun_2024-08-13_013035'
    WHEN 1 THEN code || '-1-DRAGEN-4-2-6-Germline-All-Callers' WHEN 2 THEN code || '_fe14319c_rerun_2025-02-26_043012' ELSE code || '_aa' END AS run_name,
  CAST(o_orderkey AS DOUBLE) AS median_coverage, 'XX' AS ploidy_estimation
FROM ({RUNS})
""")
def _iqc(t):
    sample = F.concat(F.lit("/ | tmp | "), "folder", F.lit(" | "), "code", F.lit(" |  "), "code", F.lit(" "))
    rows = t.sql(RUNS).withColumn("Sample", sample)
    known = {
        "dragen_coverage-wgs_median_autosomal_coverage_over_genome": F.col("o_orderkey").cast("double"),
        "dragen_ploidy_estimation-Ploidy_estimation": F.lit("XX"),
    }
    rows = _filled(rows.select("Sample", "o_orderkey"), silver.ILLUMINA_QC, known)
    return clean(rows, "illumina_qc").select("id_repository", "run_name", "median_coverage", "ploidy_estimation")


@check("silver_mgi_qc", """
SELECT 'C' || CAST(o_orderkey AS VARCHAR) AS id_repository, 'run' || CAST(o_custkey AS VARCHAR) AS run_name, CAST(o_custkey AS DOUBLE) AS depth
FROM orders WHERE o_orderkey % 3 = 0
""")
def _mqc(t):
    ending = F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.concat(F.lit(" R"), (F.col("o_orderkey") % 3).cast("string")))
    sample = F.concat(F.lit("a | run"), text("o_custkey"), F.lit(" | C"), text("o_orderkey"), ending)
    rows = _filled(t["orders"].select(sample.alias("Sample"), "o_custkey"), silver.MGI_QC, {"mosdepth-mean_coverage": F.col("o_custkey").cast("double")})
    return clean(rows, "mgi_qc").select("id_repository", "run_name", "depth")


@check("silver_second_mgi", "SELECT DISTINCT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS date_secondary, o_orderstatus FROM orders")
def _second(t):
    """First column (a row number) dropped, then day-first dates."""
    rows = t["orders"].select(
        F.monotonically_increasing_id().alias("row"), F.col("o_orderkey").alias("id"),
        F.date_format("o_orderdate", "dd-MM-yyyy").alias("date_secondary"), "o_orderstatus",
    )
    out = clean(silver.drop_first_column(rows), "ztron_analysis")
    return out.select("id", day("date_secondary").alias("date_secondary"), "o_orderstatus")


@check("silver_sheet_samples", """
SELECT DISTINCT 'C' || CAST(o_orderkey AS VARCHAR) AS id_repository, 'F' AS id_flowcell, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_custkey END AS id_index
FROM orders WHERE o_orderkey % 5 > 1
""")
def _zlims(t):
    key = F.col("o_orderkey") % 5
    ident = F.when(key == 0, F.concat(F.lit("x-Tes"), text("o_orderkey"))).when(key == 1, F.concat(F.lit("dnb"), text("o_orderkey"))).otherwise(
        F.concat(F.lit("C"), text("o_orderkey"), F.when(key == 2, "-2").otherwise("_3"))
    )
    rows = t["orders"].select(
        ident.alias("Sample ID(*)"), F.lit("F").alias("Flowcell ID"), F.lit("L").alias("Library ID"), F.lit("D").alias("DNB ID(*)"),
        F.when(F.col("o_orderstatus") == "O", "n/a").otherwise(text("o_custkey")).alias("Index(*)"), F.lit("2024").alias("Create Time"),
    )
    return silver.clean_zlims(rows, run_ts()).select("id_repository", "id_flowcell", "id_index")


@check("silver_ont_analysis", """
SELECT id_repository, run_name, strftime(d, '%Y-%m-%d') AS date_start FROM (
  SELECT l_orderkey AS id_repository, concat_ws('-', l_linenumber, l_partkey, l_suppkey) AS run_name, l_shipdate AS d,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, concat_ws('-', l_linenumber, l_partkey, l_suppkey)) AS rn FROM lineitem)
WHERE rn = 1
""")
def _ont_analysis(t):
    rows = t["lineitem"].select(
        F.col("l_orderkey").alias("id_repository"), F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey").alias("run_name"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date_start"),
    )
    return clean(rows, "ont_analysis").select("id_repository", "run_name", day("date_start").alias("date_start"))


@check("silver_ont_qc", """
SELECT 'C' || CAST(o_orderkey AS VARCHAR) AS id_repository, CAST(o_custkey AS VARCHAR) AS n50, round(floor(o_totalprice) / 10000, 6) AS at_least_10x FROM orders
""")
def _ont_qc(t):
    plain = {raw: F.lit("0") for raw in silver.ONT_QC} | {
        "id_repository": F.concat(F.lit("C"), text("o_orderkey")), "run_name": F.lit("r"), "N50": text("o_custkey"),
    }
    folds = {f"Bases with >={n}-fold coverage": (F.floor("o_totalprice") * 3200).cast("string") for n in silver.ONT_FOLDS}
    rows = t["orders"].select(*[c.alias(n) for n, c in (plain | folds).items()])
    return clean(rows, "ont_qc").select("id_repository", "n50", F.round("at_least_10x", 6).alias("at_least_10x"))


@check("silver_ont_samples", """
WITH f AS (
  SELECT CASE WHEN l_orderkey % 11 = 3 THEN 'N' ELSE 'C' END || CAST(l_orderkey AS VARCHAR) AS id_repository,
    CASE WHEN l_orderkey % 7 = 2 AND l_returnflag = 'A' THEN 'FIXED' ELSE l_returnflag END AS id_library,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(floor(l_extendedprice) AS BIGINT)) AS bam_folder,
    CASE WHEN l_linestatus = 'F' THEN CAST(l_partkey AS VARCHAR) ELSE '' END AS bases,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%fZ') AS started FROM lineitem)
SELECT id_repository, '[' || string_agg('"' || bam_folder || '"', ',' ORDER BY bam_folder) || ']' AS bam_folder,
  '[' || string_agg('"' || bases || '"', ',' ORDER BY bam_folder) || ']' AS total_passed_bases,
  '[' || string_agg('"' || started || '"', ',' ORDER BY bam_folder) || ']' AS started_at,
  CAST(CAST(sum(coalesce(TRY_CAST(bases AS BIGINT), 0)) AS BIGINT) AS VARCHAR) AS sum_of_total_passed_bases, arg_min(id_library, bam_folder) AS id_batch
FROM f GROUP BY 1
""")
def _ont_samples(t):
    """Two rows per folder, the poorer one must go; then corrections and lists."""
    key = F.col("l_orderkey")
    sample = F.concat(F.lit("C"), key.cast("string"))
    columns = {
        "id_repository": sample, "alias": F.col("l_linestatus"), "id_library": F.col("l_returnflag"),
        "bam_folder": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.floor("l_extendedprice")),
        "total_passed_bases": F.when(F.col("l_linestatus") == "F", F.col("l_partkey").cast("string")),
        "started_at": F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    }
    rest = [c for c in silver.ONT_LISTS if c not in columns]
    full = t["lineitem"].select(*[c.alias(n) for n, c in columns.items()], *[F.lit("1").alias(c) for c in rest])
    poor = full.withColumn("total_passed_bases", F.lit(None).cast("string")).withColumns({c: F.lit(None).cast("string") for c in rest})
    keys = t["orders"].select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("time_requested"))
    ident = F.concat(F.lit("C"), F.col("k").cast("string"))
    libraries = keys.filter("k % 7 = 2").select(ident.alias("id_repository"), F.lit("A").alias("id_library"), F.lit("FIXED").alias("new_library"), "time_requested")
    ids = keys.filter("k % 11 = 3").select(ident.alias("id_repository"), F.concat(F.lit("N"), F.col("k").cast("string")).alias("new_repository"), "time_requested")
    out = silver.ont_samples(full.unionByName(poor), libraries, ids, run_ts())
    return out.select("id_repository", "bam_folder", "total_passed_bases", "started_at", "sum_of_total_passed_bases", "id_batch")


@check("silver_illumina_samples", """
SELECT id, id_repository, id_library, application_id, tag_user_tags, strftime(m, '%Y-%m-%d %H:%M:%S') AS time_modified FROM (
  SELECT user_id AS id, event_type AS id_repository, 'L' || CAST(user_id AS VARCHAR) AS id_library, 'a' || CAST(event_id AS VARCHAR) AS application_id,
    '[''u' || CAST(event_id AS VARCHAR) || ''', ''v'']' AS tag_user_tags, date_trunc('second', ts) AS m,
    row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('second', ts) DESC, event_id DESC) AS rn
  FROM events WHERE date_trunc('second', ts) BETWEEN TIMESTAMP '2024-01-14 00:00:00' AND TIMESTAMP '2024-01-15 00:00:00')
WHERE rn = 1
""")
def _isamples(t):
    number = text("event_id")
    moment = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = t["events"].select(
        F.col("user_id").alias("id"), F.col("event_type").alias("name"), moment.alias("timeModified"), F.lit("2020-01-01T00:00:00Z").alias("timeCreated"),
        F.lit("o").alias("ownerId"), F.lit("t").alias("tenantId"), F.lit("n").alias("tenantName"), F.lit("AVAILABLE").alias("status"),
        F.concat(F.lit("{'id': 'a"), number, F.lit("', 'name': 'app'}")).alias("application"),
        F.concat(F.lit("{'technicalTags': [], 'userTags': ['u"), number, F.lit("', 'v'], 'connectorTags': [], 'runInTags': []}")).alias("tags"),
    )
    tags = t["events"].select(F.col("user_id").alias("id")).distinct().withColumn("id_library", F.concat(F.lit("L"), text("id")))
    out = silver.illumina_samples(rows, tags, datetime(2024, 1, 15), run_ts())
    return out.select("id", "id_repository", "id_library", "application_id", "tag_user_tags", stamp("time_modified").alias("time_modified"))


@check("silver_illumina_analyses", f"""
SELECT o_orderkey AS id, 'C' || CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderkey % 2 = 0 THEN '_250209_M' ELSE '' END AS id_repository,
  'LP' || CAST(o_custkey AS VARCHAR) || '-P1' AS id_batch, o_orderpriority AS pipeline_name,
  's3://{B.illumina}/pro/analysis/C' || CAST(o_orderkey AS VARCHAR) || '_8b-x/C' || CAST(o_orderkey AS VARCHAR) || '/C' || CAST(o_orderkey AS VARCHAR) || '.cram' AS cram,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS cram_size
FROM orders
""")
def _ianalyses(t):
    key, batch = text("o_orderkey"), text("o_custkey")
    code = F.concat(F.lit("C"), key)
    reference = F.concat(code, F.lit("_8b-x"))
    user = F.concat(code, F.when(F.col("o_orderkey") % 2 == 0, "_250209_M").otherwise("_8b"))
    moment = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = t["orders"].select(
        F.col("o_orderkey").alias("id"), reference.alias("reference"), user.alias("userReference"), F.lit("SUCCEEDED").alias("status"),
        *[moment.alias(c) for c in ("timeCreated", "timeModified", "startDate", "endDate")],
        F.concat(F.lit("{'code': '"), "o_orderpriority", F.lit("', 'x': None}")).alias("pipeline"),
        F.concat(F.lit("{'technicalTags': [], 'userTags': ['z', 'LP"), batch, F.lit("-P1'], 'referenceTags': []}")).alias("tags"),
    )
    objects = t["orders"].filter(F.col("o_orderstatus") != "P").select(
        F.lit(B.illumina).alias("bucket"), F.concat(F.lit("pro/analysis/"), reference, F.lit("/"), code, F.lit("/"), code, F.lit(".cram")).alias("key"),
        F.col("o_custkey").alias("size"),
    )
    out = silver.illumina_analyses(rows, objects, run_ts())
    return out.select("id", "id_repository", "id_batch", "pipeline_name", "cram", "cram_size")


@check("silver_pgx_log", """
SELECT o_orderkey AS file_name, strftime(o_orderdate, '%Y-%m-%d') AS input_creation_date, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS ind_report_creation_date FROM orders
""")
def _pgx(t):
    moment = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    known = {
        "file_name": F.col("o_orderkey"), "input_creation_date": moment,
        "ind_report_creation_date": F.when(F.col("o_orderstatus") == "P", "").otherwise(moment), "eng_report_creation_date": F.lit("nan"),
    }
    rows = t["orders"].select(*[known.get(c, F.lit("-")).alias(c) for c in silver.PGX_LOG_COLUMNS[:-2]])
    out = silver.pgx_log(rows, run_ts())
    return out.select("file_name", *[day(c).alias(c) for c in ("input_creation_date", "ind_report_creation_date")])


@check("silver_corrections", """
SELECT id, new_repository, new_library FROM (
  SELECT CAST(o_custkey AS VARCHAR) AS id, o_orderstatus AS new_repository, '' AS new_library,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderstatus) AS rn FROM orders)
WHERE rn = 1
""")
def _fixes(t):
    rows = t["orders"].select(
        F.col("o_custkey").alias("id"), stamp("o_orderdate").alias("time_requested"), F.col("o_orderstatus").alias("new_repository")
    )
    return silver.fix_records(rows, silver.FIX_SAMPLE_COLUMNS).select("id", "new_repository", "new_library")


@check("silver_registry_a", """
SELECT id_subject, age, sex, strftime(d, '%Y-%m-%d') AS creation_date FROM (
  SELECT 'E' || CAST(o_custkey AS VARCHAR) AS id_subject, o_orderkey % 90 AS age, CASE o_orderstatus WHEN 'F' THEN 'FEMALE' WHEN 'O' THEN 'MALE' ELSE 'P' END AS sex, o_orderdate AS d,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey % 90, CASE o_orderstatus WHEN 'F' THEN 'FEMALE' WHEN 'O' THEN 'MALE' ELSE 'P' END) AS rn FROM orders)
WHERE rn = 1
""")
def _registry_a(t):
    status = F.col("o_orderstatus")
    rows = t["orders"].select(
        F.concat(F.lit("E"), text("o_custkey")).alias("ehr_id"), (F.col("o_orderkey") % 90).cast("string").alias("age"),
        F.when(status == "F", "Perempuan").when(status == "O", "Laki-laki").otherwise("P").alias("gender"), stamp("o_orderdate").alias("creationDate"),
    )
    return clean(rows, "registry_a_demography").select("id_subject", "age", "sex", day("creation_date").alias("creation_date"))


@check("silver_registry_b", """
SELECT id_subject, sex, hospital_name, updation_date FROM (
  SELECT 'P' || CAST(o_custkey AS VARCHAR) AS id_subject, CASE WHEN o_orderkey % 2 = 0 THEN 'FEMALE' ELSE 'MALE' END AS sex,
    CASE WHEN o_orderkey % 3 = 0 THEN 'RSUP Dr. Sardjito' WHEN o_orderkey % 3 = 1 THEN 'Central Hub' ELSE 'Unknown' END AS hospital_name,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS updation_date, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders)
WHERE rn = 1
""")
def _registry_b(t):
    third = F.col("o_orderkey") % 3
    moment = stamp("o_orderdate")
    known = {
        "id": F.concat(F.lit("P"), text("o_custkey")), "gender": F.when(F.col("o_orderkey") % 2 == 0, "female").otherwise("male"),
        "created_by": F.when(third == 0, "a@sardjitohospital").when(third == 1, "admin@x").otherwise("z"), "created_at": moment, "updated_at": moment,
        # The first plain column breaks ties in the order of the raw rows.
        "full_name": F.format_string("%09d", "o_orderkey"),
    }
    plain = "nik dob ihs_number source province_code province district_code district subdistrict_code subdistrict village_code village use_nik_ibu updated_by".split()
    rows = t["orders"].select(*[c.alias(n) for n, c in known.items()], *[F.lit("-").alias(c) for c in plain])
    out = silver.registry_b_demography(rows, run_ts(), "Central Hub")
    return out.select("id_subject", "sex", "hospital_name", "updation_date")


@check("silver_sharing", "SELECT DISTINCT o_orderkey AS id, o_custkey AS id_subject, o_orderstatus AS gender FROM orders")
def _sharing(t):
    columns = [c for c in silver.SHARING_COLUMNS if c not in ("id", "id_subject", "gender", *silver.AUDIT)]
    rows = t["orders"].select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("participant_id"), F.col("o_orderstatus").alias("gender"), *[F.lit("-").alias(c) for c in columns]
    )
    return clean(rows, "data_sharing").select("id", "id_subject", "gender")


@check("silver_clearances", "SELECT o_orderkey AS id, o_orderstatus AS creation_date, o_orderpriority AS updation_date, '2025-03-02 00:00:00' AS created_at FROM orders")
def _clearances(t):
    rows = t["orders"].select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("created_at"), F.col("o_orderpriority").alias("updated_at")
    )
    return clean(rows, "clearances").select("id", "creation_date", "updation_date", stamp("created_at").alias("created_at"))


@check("silver_diseases", "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id, o_orderstatus AS diseases_name, o_orderpriority AS hub_name FROM orders")
def _diseases(t):
    rows = t["orders"].select(
        F.concat(F.lit("{'id': '"), text("o_custkey"), F.lit("', 'diseases_name': '"), "o_orderstatus", F.lit("'}")).alias("diseases"),
        F.concat(F.lit("{'hub_name': '"), "o_orderpriority", F.lit("'}")).alias("hub"),
    )
    return silver.diseases(rows, "id string, diseases_name string", "hub_name string")


@check("silver_master_values", """
SELECT o_orderkey AS id, '{"options": ["a", "' || o_orderstatus || '"]}' AS answer FROM orders
""")
def _master(t):
    raw = F.concat(F.lit("{'options': ['a', '"), "o_orderstatus", F.lit("']}"))
    rows = t["orders"].select(F.col("o_orderkey").alias("id"), raw.alias("answer"))
    return clean(rows, "master_values").select("id", "answer")


@check("silver_documents_json", """
SELECT o_orderkey AS id_subject, '"{''k'': ''' || o_orderstatus || '''}"' AS entry FROM orders
""")
def _documents(t):
    raw = F.concat(F.lit("{'k': '"), "o_orderstatus", F.lit("'}"))
    rows = t["orders"].select("o_orderkey", F.lit("c").alias("composition"), F.lit("n").alias("n"), raw.alias("e"))
    return silver.registry_a_documents(rows, run_ts()).select("id_subject", "entry")


GROUP_A, GROUP_B = "Formulir-Rekrutmen_Registrasi", "Spesifik-Penyakit-Examination--x"


FLATTENED = """
WITH base AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, 'AAA' || CAST(o_custkey AS VARCHAR) AS id_subject,
    CASE WHEN o_orderkey % 2 = 0 THEN 'phenovar_docs_rekrutmen_registrasi_s' ELSE 'phenovar_docs_exam-x_s' END AS form_table FROM orders WHERE o_orderkey % 10 <> 9)
SELECT form_table, id_subject, CAST(o_orderkey AS VARCHAR) AS version, 'Section|' || 'Variable ' || CAST(o_orderkey % 25 AS VARCHAR) AS path, o_orderstatus AS value FROM base
UNION ALL SELECT form_table, id_subject, CAST(o_orderkey AS VARCHAR), 'Koleksi.Tipe', o_orderpriority FROM base
UNION ALL SELECT form_table, id_subject, CAST(o_orderkey AS VARCHAR), 'Nomor EC', 'EC1' FROM base WHERE o_orderkey % 2 = 0
"""


def _flattened(t):
    """Questionnaires as Python-literal text: ids become names, help texts go, registry answers stay in one group."""
    uuid = F.format_string("%08d-aaaa-bbbb-cccc-ddddeeeeffff", F.col("o_orderkey") % 25)
    group = F.when(F.col("o_orderkey") % 2 == 0, GROUP_A).otherwise(GROUP_B)
    kind = F.when(F.col("o_orderkey") % 10 == 9, "other").otherwise(
        F.concat(F.lit("AAA1/00000000-aaaa-bbbb-cccc-ddddeeeeffff/"), group, F.lit("|S"))
    )
    answer = F.concat(
        F.lit("{'form': {'answers': {'Section|"), uuid, F.lit("': '"), F.col("o_orderstatus"), F.lit("'}, 'continue_values': {'"), uuid,
        F.lit("': 'help'}}, 'Koleksi': {'Tipe': '"), F.col("o_orderpriority"), F.lit("'}, 'Nomor EC': 'EC1'}"),
    )
    rows = t["orders"].select(
        F.concat(F.lit("AAA"), text("o_custkey")).alias("participant_id"), F.lit("b").alias("institution_name"), text("o_orderkey").alias("version"),
        F.col("o_orderdate").alias("created_at"), kind.alias("document_type"), answer.alias("question_answer"),
    )
    variables = t["nation"].select(
        F.format_string("%08d-aaaa-bbbb-cccc-ddddeeeeffff", F.col("n_nationkey")).alias("id"),
        F.concat(F.lit(" Variable "), F.col("n_nationkey").cast("string"), F.lit(" ")).alias("name"),
    )
    return silver.flatten_documents(rows, variables)


@check("silver_flatten_documents", FLATTENED)
def _flatten(t):
    return _flattened(t).select(silver.group_table("form_group").alias("form_table"), "id_subject", "version", "path", "value")


@check("documents_by_form", FLATTENED)
def _written(t):
    """The long answers as one folder for each form group, read back."""
    root = f"{shared_folder(t.spark)}/forms-{uuid.uuid4().hex}"
    silver.write_documents(_flattened(t), root)
    return t.spark.read.option("inferSchema", False).parquet(root).select("form_table", "id_subject", "version", "path", "value")


@check("silver_biosamples", "SELECT o_orderkey AS id, o_custkey AS id_patient, o_orderstatus AS biosample_status, o_orderpriority AS origin_code_repository FROM orders")
def _biosamples(t):
    known = {"id": "o_orderkey", "patient_id": "o_custkey", "status": "o_orderstatus", "sample_old_code": "o_orderpriority"}
    raw = {new: old for old, new in silver.BIOSAMPLE.items()}
    columns = [raw.get(c, c) for c in silver.BIOSAMPLE_COLUMNS if c not in silver.AUDIT]
    rows = t["orders"].select(*[F.col(known[c]).alias(c) if c in known else F.lit("-").alias(c) for c in columns])
    return clean(rows, "biosamples").select("id", "id_patient", "biosample_status", "origin_code_repository")


@check("silver_patients", "SELECT c_custkey AS id_patient, 'MR' || CAST(c_custkey AS VARCHAR) AS id_subject, c_mktsegment AS sex, c_name AS date_of_birth FROM customer")
def _patients(t):
    rows = t["customer"].select(
        F.col("c_custkey").alias("id"), F.concat(F.lit("MR"), text("c_custkey")).alias("nomor_mr"), F.lit("m").alias("id_mpi"),
        F.col("c_mktsegment").alias("sex"), F.col("c_name").alias("dateofbirth"), F.lit("b").alias("id_biobank"),
    )
    return clean(rows, "patients").select("id_patient", "id_subject", "sex", "date_of_birth")


@check("silver_restricted", """
SELECT c_custkey AS id_subject, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_name END AS full_name, CAST(c_custkey AS VARCHAR) AS nik, '1990-01-02' AS birth_date FROM customer
""")
def _restricted(t):
    """Encrypted here with the same key, then opened; a broken text gives null."""
    key, iv = F.lit("0123456789abcdef"), F.lit("fedcba9876543210")

    def seal(c):
        sealed = F.aes_encrypt(c.cast("string"), key.cast("binary"), F.lit("CBC"), F.lit("PKCS"), iv.cast("binary"))
        return F.substring(F.hex(sealed), F.lit(33), F.length(F.hex(sealed)))

    plain = "use_nik_ibu gender source province province_code district district_code created_at updated_at".split()
    name = F.when(F.col("c_custkey") % 9 == 0, F.lit("zz")).otherwise(seal(F.col("c_name")))
    rows = t["customer"].select(
        F.col("c_custkey").alias("id"), name.alias("full_name"), seal(F.col("c_custkey")).alias("nik"), seal(F.lit("1990-01-02")).alias("dob"),
        *[F.lit("-").alias(c) for c in plain],
    )
    out = silver.restricted_participants(rows, key, iv, run_ts())
    return out.select("id_subject", "full_name", "nik", "birth_date")
