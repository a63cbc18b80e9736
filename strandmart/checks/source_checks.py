"""Readers, inventories, report parsers and writers, on inputs derived from the test tables."""

import uuid

from pyspark.sql import functions as F

from strandmart.checks.registry import cents, check, day, flag, stamp
from strandmart.session import shared_folder
from strandmart.settings import Buckets
from strandmart.plans import report_chain
from strandmart.sources import big_csv, bronze, inventory, reports, sheets, tables
from strandmart.streaming.event_log import append_log, load_landed

B = Buckets()


def scratch(t) -> str:
    return f"{shared_folder(t.spark)}/check-{uuid.uuid4().hex}"


# --- files and tables -----------------------------------------------------

ORDER_TEXT = ["o_orderkey", "o_orderstatus", "o_orderpriority"]


@check("bronze_files", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority,
  CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS in_day, o_orderstatus || '-2025-01-0' || CASE o_orderstatus WHEN 'O' THEN '1' ELSE '2' END AS file
FROM orders
""")
def _bronze(t):
    """One folder of dated text files: all of them, and those of one date."""
    root = scratch(t)
    status = F.col("o_orderstatus")
    name = F.concat(status, F.lit("-2025-01-0"), F.when(status == "O", "1").otherwise("2"))
    t["orders"].select(*ORDER_TEXT, name.alias("file")).write.partitionBy("file").option("header", True).csv(root)
    every = bronze.read_bronze_all(t.spark, f"{root}/file=*", ORDER_TEXT)
    dated = bronze.read_bronze_multi(t.spark, f"{root}/file=O-2025-01-01", "", ORDER_TEXT)
    in_day = dated.select(F.col("o_orderkey").alias("k"), F.lit(1).alias("in_day"))
    rows = every.select("*", F.regexp_extract(F.col("_metadata.file_path"), "file=([^/]+)/", 1).alias("file"))
    rows = rows.join(in_day, F.col("o_orderkey") == F.col("k"), "left")
    return rows.select(*ORDER_TEXT, F.coalesce("in_day", F.lit(0)).alias("in_day"), "file")


def _csv_files(t, texts, root):
    """Texts (``file``, ``value``) as files ``*.csv``, one folder each."""
    texts.repartition(1).write.partitionBy("file").option("lineSep", "\n").text(root)
    path = t.spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(t.spark._jsc.hadoopConfiguration())
    for found in files.globStatus(path(f"{root}/file=*/*.txt")):
        files.rename(found.getPath(), path(str(found.getPath()).replace(".txt", ".csv")))


@check("bronze_headers", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS note,
  CASE WHEN o_orderstatus = 'O' THEN o_orderstatus END AS note_1, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority || chr(10) || 'x' END AS two_lines,
  CASE WHEN o_orderstatus = 'F' THEN o_orderstatus END AS unnamed
FROM orders
""")
def _headers(t):
    """A header with a repeated name, one with a line break inside a name and an empty name, and a plain one."""
    status, key = F.col("o_orderstatus"), F.col("o_orderkey").cast("string")
    header = F.when(status == "O", "o_orderkey,note,note").when(status == "F", 'o_orderkey,"two\nlines",').otherwise("o_orderkey,note")
    line = F.when(status == "O", F.concat_ws(",", key, "o_orderpriority", status)).when(
        status == "F", F.concat(key, F.lit(',"'), "o_orderpriority", F.lit('\nx",'), status)
    ).otherwise(F.concat_ws(",", key, "o_orderpriority"))
    texts = t["orders"].groupBy(status.alias("file"), header.alias("head")).agg(F.array_join(F.collect_list(line), "\n").alias("lines"))
    root = scratch(t)
    _csv_files(t, texts.select("file", F.concat_ws("\n", "head", "lines").alias("value")), root)
    names = ["o_orderkey", "note", "note.1", "two\nlines", "Unnamed: 2"]
    rows = bronze.read_bronze_all(t.spark, f"{root}/file=*", names)
    return rows.toDF("o_orderkey", "note", "note_1", "two_lines", "unnamed", *rows.columns[5:]).select("o_orderkey", "note", "note_1", "two_lines", "unnamed")


#: Records of one file, which one task sorts and writes.
FILE_RECORDS = 1_000_000


@check("split_files", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority || chr(10) || 'a "word", ' || repeat(chr(10), CAST(o_orderkey % 4 AS INTEGER)) || o_orderstatus AS note,
  CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 1 ELSE 0 END AS is_last
FROM orders
""")
def _split(t):
    """Files of about a million records with line breaks, quotes and commas in their fields, read in blocks of 8,000 bytes; the rows keep their order."""
    root, orders = scratch(t), t["orders"].count()
    note = F.concat("o_orderpriority", F.lit('\na "word", '), F.repeat(F.lit("\n"), (F.col("o_orderkey") % 4).cast("int")), "o_orderstatus")
    rows = t["orders"].select(F.col("o_orderkey").cast("string").alias("id"), note.alias("note"), "o_orderkey").repartitionByRange(1 + orders // FILE_RECORDS, "o_orderkey")
    rows.sortWithinPartitions("o_orderkey").select("id", "note").write.option("header", True).option("escape", '"').csv(root)
    size = t.spark.conf.get("spark.sql.files.maxPartitionBytes")
    t.spark.conf.set("spark.sql.files.maxPartitionBytes", max(8_000, orders // 4))
    try:
        read = big_csv.read_bronze_large(t.spark, root, "", ["id", "note"])
        # written while the setting holds
        read.write.parquet(f"{root}-read")
    finally:
        t.spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    read = t.spark.read.parquet(f"{root}-read")
    last = read.agg(F.max(bronze.ROW_ORDER)).first()[0]
    return read.select("id", "note", (F.col(bronze.ROW_ORDER) == F.struct(*[F.lit(x).alias(n) for n, x in last.asDict().items()])).cast("int").alias("is_last"))


@check("bronze_day", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority AS note, CAST(NULL AS VARCHAR) AS absent FROM orders WHERE o_orderstatus = 'O'")
def _bronze_day(t):
    """The file of one date, named by it, next to one of another date; a column that it lacks is null, and a date without a file is empty."""
    root = scratch(t)
    texts = t["orders"].filter("o_orderstatus <> 'P'").groupBy(F.col("o_orderstatus").alias("file")).agg(
        F.concat(F.lit("note,o_orderkey\n"), F.array_join(F.collect_list(F.concat_ws(",", "o_orderpriority", F.col("o_orderkey").cast("string"))), "\n")).alias("value")
    )
    _csv_files(t, texts, f"{root}/all")
    path = t.spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(t.spark._jsc.hadoopConfiguration())
    for status, ds in (("O", "2025-01-01"), ("F", "2025-01-02")):
        files.rename(files.globStatus(path(f"{root}/all/file={status}/*.csv"))[0].getPath(), path(f"{root}/{ds}.csv"))
    names = ["o_orderkey", "note", "absent"]
    return bronze.read_bronze(t.spark, root, "2025-01-01", names).unionByName(bronze.read_bronze(t.spark, root, "2030-01-01", names)).select(*names)


@check("full_refresh", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'O'")
def _refresh(t):
    """A table written twice holds the second writing only."""
    root = scratch(t)
    rows = t["orders"].select("o_orderkey", "o_orderstatus")
    for kept in (F.col("o_orderstatus") == "O", F.col("o_orderstatus") != "O"):
        tables.full_refresh(rows.filter(kept), root)
    return t.spark.read.parquet(root)


@check("row_order", """
SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
""")
def _row_order(t):
    """The last row of a file wins, by file position."""
    from strandmart.operators import latest_by

    root = scratch(t)
    ordered = t["orders"].select("o_custkey", "o_orderkey").repartitionByRange(4, "o_custkey").sortWithinPartitions("o_orderkey")
    ordered.write.option("header", True).csv(root)
    rows = bronze.with_row_order(bronze.read_bronze_all(t.spark, root, ["o_custkey", "o_orderkey"]))
    last = latest_by(rows, ["o_custkey"], [bronze.ROW_ORDER])
    return last.select(F.col("o_custkey").cast("bigint"), F.col("o_orderkey").cast("bigint"))


@check("merge_latest", "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def _merge(t):
    rows = t["orders"].select("o_custkey", "o_orderstatus", "o_orderpriority")
    merged = bronze.merge_latest(rows.unionByName(rows), scratch(t), "2025-01-01")
    return merged.withColumn("o_custkey", F.col("o_custkey").cast("bigint"))


FIXES = """
SELECT CAST(o_orderkey AS STRING) AS id, o_orderkey AS id_repository, o_orderdate AS time_requested,
  CASE CAST(o_orderkey % 6 AS INT) WHEN 0 THEN 'id_repository' WHEN 1 THEN 'id_library' WHEN 2 THEN 'id_zlims_index' WHEN 3 THEN 'cram'
       WHEN 4 THEN 'vcf' ELSE 'other' END AS fix_type, o_orderstatus AS new_value
FROM orders
"""


@check("write_by_kind", f"""
SELECT fix_type, count(*) AS ct, CAST(sum(id_repository) AS BIGINT) AS total FROM ({FIXES}) WHERE fix_type <> 'other' GROUP BY 1
""")
def _by_kind(t):
    root = scratch(t)
    bronze.write_by_kind(t.sql(FIXES), root)
    written = t.spark.read.option("header", True).csv(root)
    return written.groupBy("fix_type").agg(
        F.count(F.lit(1)).alias("ct"), F.sum(F.col("id_repository").cast("bigint")).alias("total")
    )


@check("swap_table", """
SELECT o_orderkey AS id, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' THEN 'new' ELSE 'old' END AS origin,
       CASE WHEN o_orderdate < TIMESTAMP '1999-01-01 00:00:00' THEN 1 ELSE 2 END AS created
FROM orders
""")
def _swap(t):
    """Two batches into a versioned table: the second overlaps the first."""
    table = tables.SwappedTable(t.spark, scratch(t))
    orders = t["orders"].select(F.col("o_orderkey").alias("id"), "o_orderdate")
    old = orders.filter(F.col("o_orderdate") < "1999-01-01").select("id", F.lit("old").alias("origin"), F.lit(1).alias("created"))
    new = orders.filter(F.col("o_orderdate") >= "1998-01-01").select("id", F.lit("new").alias("origin"), F.lit(2).alias("created"))
    table.upsert(old, "v1", ["id"], [], ["origin"])
    table.upsert(new, "v2", ["id"], ["created"], ["origin"])
    return table.read()


LOADED = """
SELECT CAST(o_orderkey AS VARCHAR) AS session_id, 'L' || CAST(o_custkey AS VARCHAR) AS id_library, 'R' || CAST(o_orderkey AS VARCHAR) AS id_repository,
  CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' THEN 'second' ELSE 'first' END AS status,
  CASE WHEN o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN '2025-01-01' ELSE '2025-01-02' END AS created_at,
  CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' THEN '2025-01-02' ELSE '2025-01-01' END AS updated_at
FROM orders
"""


def loaded(t, table):
    """Two days of files, columns in another order on the second and every row sent twice, upserted by specification."""
    from strandmart.plans.load import load
    from strandmart.plans.silver import SPECS as SILVER
    from strandmart.plans.upserts import SPECS as KEYS

    landing = scratch(t)
    rows = t["orders"].select(
        F.col("o_orderkey").cast("string").alias("session_id"), F.concat(F.lit("L"), F.col("o_custkey").cast("string")).alias("experiment_name"),
        F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("biosample_name"), "o_orderdate",
    )
    columns = ["session_id", "experiment_name", "biosample_name", "status"]
    for ds, within, order, states in (
        ("2025-01-01", F.col("o_orderdate") < "1998-01-01", columns, ["old", "first"]),
        ("2025-01-02", F.col("o_orderdate") >= "1997-01-01", columns[::-1], ["first", "second"]),
    ):
        sent = rows.filter(within).withColumn("status", F.explode(F.array(*map(F.lit, states))))
        sent.select(*order).write.option("header", True).csv(f"{landing}/{ds}")
        run = F.lit(ds)
        load(t.spark, f"{landing}/{ds}", "", columns, SILVER["bssh"], table, KEYS["U06"], run, f"v{ds}")
    return table.read()


@check("load_job", LOADED)
def _load(t):
    return loaded(t, tables.SwappedTable(t.spark, scratch(t)))


@check("append_log", """
SELECT strftime(ts, '%Y-%m-%d') AS log_date, count(*) AS ct, count(DISTINCT user_id) AS users FROM events GROUP BY 1
""")
def _append(t):
    """Runs that share days, each sent twice: no row doubles, and none of another run is lost."""
    root = scratch(t)
    log = t["events"].select(
        F.col("user_id").alias("ehr_id"), F.col("ts").alias("logged_at"), F.col("event_type").alias("template_id"),
        F.lit("h").alias("hospital"), F.lit("c").alias("crud_type"), F.col("props").alias("composition"),
    )
    morning = F.hour("logged_at") < 12
    for run, part in (("am", morning), ("pm", ~morning), ("am", morning)):
        append_log(log.filter(part), root, run)
    written = t.spark.read.parquet(root)
    return written.groupBy(day("log_date").alias("log_date")).agg(
        F.count(F.lit(1)).alias("ct"), F.count_distinct("ehr_id").alias("users")
    )


@check("landed_log", """
SELECT CASE WHEN hour(ts) < 12 THEN 'landed-0' ELSE 'landed-1' END AS run, strftime(ts, '%Y-%m-%d') AS log_date, count(*) AS ct, count(DISTINCT user_id) AS users
FROM events GROUP BY 1, 2
""")
def _landed(t):
    """Files land twice; the second batch is forgotten and tried again, and replaces itself."""
    landing, log, checkpoint = (scratch(t) for _ in range(3))
    rows = t["events"].select(
        F.col("user_id").alias("ehr_id"), stamp("ts").alias("logged_at"), F.col("event_type").alias("template_id"),
        F.lit("h").alias("hospital"), F.lit("c").alias("crud_type"), F.col("props").alias("composition"),
    )
    morning = F.hour(F.col("logged_at").cast("timestamp")) < 12
    for part in (morning, ~morning):
        rows.filter(part).write.mode("append").option("header", True).option("escape", '"').csv(landing)
        load_landed(t.spark, landing, log, checkpoint)
    path = t.spark._jvm.org.apache.hadoop.fs.Path
    path(checkpoint).getFileSystem(t.spark._jsc.hadoopConfiguration()).delete(path(f"{checkpoint}/commits/1"), False)
    load_landed(t.spark, landing, log, checkpoint)
    return t.spark.read.parquet(log).groupBy("run", day("log_date").alias("log_date")).agg(F.count(F.lit(1)).alias("ct"), F.count_distinct("ehr_id").alias("users"))


@check("sample_table", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 750")
def _sample(t):
    """Capped copy with a total order; the cap is the feature."""
    return tables.sample_table(t["orders"].select("o_orderkey", "o_totalprice"), 750, ["o_orderkey"])


@check("delta_window", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-14 00:00:00' AND TIMESTAMP '2024-01-15 00:00:00'
   OR ts + value * INTERVAL '1' HOUR BETWEEN TIMESTAMP '2024-01-14 00:00:00' AND TIMESTAMP '2024-01-15 00:00:00'
""")
def _delta(t):
    from datetime import datetime

    rows = t.sql("SELECT event_id, ts, ts + value * INTERVAL '1' HOUR AS modified FROM events")
    rows = bronze.delta_window(rows, datetime(2024, 1, 15), "modified", "ts")
    return rows.select("event_id", stamp("ts").alias("ts"))


@check("cutoff_filter", "SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'")
def _since(t):
    return bronze.since(t["events"], "ts", "2024-01-20").select("event_id", "event_type")


@check("export_status", """
SELECT id_subject, analysis_secondary, qc_pass FROM (
  SELECT o_custkey AS id_subject, CASE WHEN o_orderstatus = 'P' THEN 'FAILED' ELSE 'SUCCEEDED' END AS analysis_secondary,
    CASE WHEN o_orderpriority = '5-LOW' THEN '1' ELSE '0' END AS qc_pass,
    row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END DESC NULLS LAST,
      CASE WHEN o_orderpriority = '5-LOW' THEN 'Pass' ELSE o_orderpriority END) AS rn FROM orders)
WHERE rn = 1
""")
def _export(t):
    status = F.when(F.col("o_orderpriority") == "5-LOW", "Pass").otherwise(F.col("o_orderpriority"))
    rows = t["orders"].select(
        F.col("o_custkey").alias("id_repository"), F.nullif("o_orderstatus", F.lit("P")).alias("s"), "o_orderdate",
        status.alias("qc_strict_status"),
    ).withColumn("date_secondary", F.when(F.col("s").isNotNull(), F.col("o_orderdate")))
    return tables.export_status(rows)


# --- inventories ----------------------------------------------------------

OBJECTS = f"""
SELECT '{B.ont_output}' AS bucket,
  'C' || CAST(l_orderkey AS STRING) || '.r_' || CAST(l_partkey % 2 AS STRING) || '/' || CASE CAST(l_linenumber % 4 AS INT)
    WHEN 0 THEN 'p' || CAST(l_partkey AS STRING) || '.cram' WHEN 1 THEN 'p' || CAST(l_partkey AS STRING) || '_snp.vcf.gz'
    WHEN 2 THEN 'wf-human-alignment-report.html' ELSE 'logs/p' || CAST(l_partkey AS STRING) || '.txt' END AS key,
  CAST(floor(l_extendedprice) AS BIGINT) AS size, l_shipdate AS last_modified
FROM lineitem
"""


@check("folder_stats", f"""
SELECT split_part(key, '/', 1) || '/' AS prefix, CAST(sum(size) AS BIGINT) AS total_size,
       strftime(max(last_modified), '%Y-%m-%d') AS latest
FROM ({OBJECTS}) GROUP BY 1
""")
def _folder(t):
    stats = inventory.folder_stats(t.sql(OBJECTS), 1)
    return stats.select("prefix", "total_size", day("latest").alias("latest"))


@check("recent_folders", f"""
SELECT DISTINCT split_part(key, '/', 1) || '/logs/' AS prefix FROM ({OBJECTS})
WHERE last_modified >= TIMESTAMP '2000-01-01 00:00:00' AND key LIKE '%/logs/%'
""")
def _recent(t):
    return inventory.recent_folders(t.sql(OBJECTS), "2000-01-01", 2).select("prefix")


@check("inventory_to_analysis", f"""
WITH o AS (SELECT *, split_part(key, '/', 1) AS run_name, 's3://' || bucket || '/' || key AS path FROM ({OBJECTS})),
u AS (SELECT run_name, key, path, max(size) AS size FROM o GROUP BY 1, 2, 3)
SELECT split_part(split_part(a.run_name, '.', 1), '_', 1) AS id_repository, a.run_name, a.cram, a.cram_size, a.vcf, a.vcf_size,
  a.pipeline_name, a.pipeline_type, strftime(b.d, '%Y-%m-%d') AS date_start
FROM (SELECT run_name, arg_max(path, key) FILTER (key LIKE '%cram') AS cram, arg_max(size, key) FILTER (key LIKE '%cram') AS cram_size,
    arg_max(path, key) FILTER (key LIKE '%vcf.gz') AS vcf, arg_max(size, key) FILTER (key LIKE '%vcf.gz') AS vcf_size,
    max('wf-human-variation 1.' || CAST(len(key) AS VARCHAR)) FILTER (key LIKE '%html') AS pipeline_name,
    max('secondary') FILTER (key LIKE '%html') AS pipeline_type FROM u GROUP BY run_name) a
JOIN (SELECT run_name, min(last_modified) AS d FROM o GROUP BY 1) b ON a.run_name = b.run_name
""")
def _analysis(t):
    objects = t.sql(OBJECTS)
    content = F.concat(
        F.lit("<code>wf-human-alignment-report.html</code> nextflow workflow (1."), F.length("key").cast("string"), F.lit(")")
    )
    html = objects.filter(F.col("key").endswith(".html")).select("key", content.alias("content")).distinct()
    return inventory.inventory_to_analysis(objects, html).withColumn("date_start", day("date_start"))


QC_OBJECTS = f"""
SELECT CASE WHEN l_partkey % 2 = 0 THEN '{B.illumina}' ELSE '{B.citus}' END AS bucket,
  CASE WHEN l_partkey % 2 = 0 THEN 'pro/analysis/f' || CAST(l_orderkey AS STRING) || CASE WHEN l_suppkey % 9 = 0 THEN '/' ELSE '/s' || CAST(l_suppkey AS STRING) || '/' END
       ELSE 'r' || CAST(l_orderkey AS STRING) || '/deep/' END || 'p' || CAST(l_partkey AS STRING) || CASE CAST(l_linenumber AS INT)
    WHEN 1 THEN '.mapping_metrics.csv' WHEN 2 THEN '_metrics.stats' WHEN 3 THEN '.roh_metrics.csv' WHEN 4 THEN '_1_fastqc_metrics.zip'
    WHEN 5 THEN '.sex_check_metrics.csv' WHEN 6 THEN '.bam' ELSE '.vc_metrics.csv.bak' END AS key,
  l_shipdate AS last_modified, l_returnflag
FROM lineitem
"""
PLAN = f"""
SELECT DISTINCT bucket AS source_bucket, key AS source_key,
  CASE WHEN bucket = '{B.illumina}' THEN '{B.dragen_qc}' ELSE '{B.citus_qc}' END AS target_bucket,
  CASE WHEN bucket = '{B.illumina}' THEN split_part(key, '/', 3) || '/' || split_part(key, '/', 4) ELSE split_part(key, '/', 1) END
    || '/' || split_part(key, '/', -1) AS target_key
FROM ({QC_OBJECTS}) WHERE last_modified >= TIMESTAMP '1999-01-01 00:00:00'
  AND CASE WHEN bucket = '{B.illumina}' THEN key LIKE '%.mapping_metrics.csv' OR key LIKE '%.roh_metrics.csv'
           ELSE key LIKE '%_metrics.stats' OR key LIKE '%_1_fastqc_metrics.zip' OR key LIKE '%.sex_check_metrics.csv' END
"""


@check("qc_sync_plan", f"""
WITH plan AS ({PLAN}), done AS (SELECT target_key FROM ({PLAN.replace("WHERE last", "WHERE l_returnflag = 'R' AND last")}))
SELECT * FROM plan WHERE target_key NOT IN (SELECT target_key FROM done)
""")
def _sync(t):
    """Objects of returned lines are taken as copied already."""
    objects = t.sql(QC_OBJECTS)
    nothing = objects.limit(0)
    copied = inventory.qc_sync_plan(objects.filter(F.col("l_returnflag") == "R"), nothing, "1999-01-01")
    existing = copied.select(F.col("target_bucket").alias("bucket"), F.col("target_key").alias("key"))
    return inventory.qc_sync_plan(objects, existing, "1999-01-01").distinct()


@check("incomplete_qc", f"""
WITH q AS (SELECT DISTINCT 'C' || CAST(o_orderkey AS VARCHAR) || '.' AS id, CASE WHEN o_custkey % 2 = 0 THEN 'dragen' ELSE 'citus' END AS pipeline
  FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH')),
f AS (SELECT DISTINCT CASE WHEN size % 2 = 0 THEN 'dragen' ELSE 'citus' END AS pipeline, split_part(key, '/', 1) AS folder FROM ({OBJECTS}))
SELECT DISTINCT q.pipeline, 's3://data-' || q.pipeline || '-qc/' || folder || '/' AS path FROM q JOIN f ON q.pipeline = f.pipeline AND starts_with(folder, id)
""")
def _incomplete(t):
    lacking = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None)).otherwise(F.lit(30.0))
    qc = t["orders"].select(
        F.concat(F.lit("C"), F.col("o_orderkey").cast("string"), F.lit(".")).alias("id_repository"),
        F.when(F.col("o_custkey") % 2 == 0, "DRAGEN x").otherwise("CITUS").alias("pipeline_name"),
        F.nullif("o_orderstatus", F.lit("P")).alias("run_name"), lacking.alias("coverage"), F.lit(1.0).alias("at_least_10x"),
        F.when(F.col("o_orderpriority") != "2-HIGH", "XX").alias("ploidy_estimation"),
    )
    place = F.when(F.col("size") % 2 == 0, B.dragen_qc).otherwise(B.citus_qc)
    return inventory.incomplete_qc_folders(qc, t.sql(OBJECTS).withColumn("bucket", place))


SHEET_ROWS = f"""
SELECT CAST(o_orderkey AS STRING) AS file_name, 'S' || CAST(o_orderkey AS STRING) AS sample_id,
  's3://{B.citus}/C' || CAST(o_orderkey AS STRING) || '_a/C.cram' AS bam, o_orderpriority AS hub_name, o_orderdate AS input_creation_date
FROM orders
"""
REPORT_OBJECTS = """
SELECT 'out/S' || CAST(l_orderkey AS STRING) || CASE WHEN l_returnflag = 'A' THEN '/ind.json' ELSE '/eng.json' END AS key, max(l_shipdate) AS last_modified
FROM lineitem GROUP BY 1
"""


@check("pgx_status", f"""
SELECT s.file_name, s.bam, strftime(s.input_creation_date, '%Y-%m-%d') AS input_creation_date,
  CASE WHEN CAST(s.file_name AS BIGINT) % 10 = 0 THEN 'N' || s.file_name WHEN CAST(s.file_name AS BIGINT) % 10 = 1 THEN 'A' || s.file_name ELSE 'C' || s.file_name END AS id_repository,
  s.hub_name, 'C' || s.file_name || '_a' AS run_name,
  's3://{B.pgx_output}/' || i.key AS report_path_ind, strftime(i.last_modified, '%Y-%m-%d') AS ind_report_creation_date,
  's3://{B.pgx_output}/' || e.key AS report_path_eng, strftime(e.last_modified, '%Y-%m-%d') AS eng_report_creation_date,
  CASE WHEN i.key IS NOT NULL THEN 'v' || CAST(len(i.key) AS VARCHAR) END AS pipeline_version
FROM ({SHEET_ROWS}) s
LEFT JOIN ({REPORT_OBJECTS}) i ON i.key = 'out/' || s.sample_id || '/ind.json'
LEFT JOIN ({REPORT_OBJECTS}) e ON e.key = 'out/' || s.sample_id || '/eng.json'
""")
def _pgx(t):
    objects = t.sql(REPORT_OBJECTS)
    versions = objects.select("key", F.concat(F.lit("v"), F.length("key").cast("string")).alias("version"))
    key = F.col("o_orderkey")
    text = key.cast("string")
    fixes = t["orders"].filter(key % 10 == 0).select(
        F.concat(F.lit("C"), text).alias("id_repository"), F.concat(F.lit("N"), text).alias("new_repository")
    )
    aliases = t["orders"].filter(key % 10 == 1).select(
        F.concat(F.lit("C"), text).alias("new_origin_code_repository"), F.concat(F.lit("A"), text).alias("code_repository")
    )
    out = inventory.pgx_status(t.sql(SHEET_ROWS), objects, versions, fixes, aliases, "out/{sample_id}/{report_type}.json")
    days = ("input_creation_date", "ind_report_creation_date", "eng_report_creation_date")
    return out.withColumns({c: day(c) for c in days})


LISTING = " UNION ALL ".join(
    f"""SELECT 'run' || CAST(o_custkey AS STRING) || '/C' || CAST(o_orderkey AS STRING) || '{ending}' AS Path, 'C' || CAST(o_orderkey AS STRING) || '{ending}' AS Name,
  CAST(floor(o_totalprice) AS BIGINT) + {n} AS Size, o_orderdate AS ModTime, o_orderstatus = 'P' AS IsDir FROM orders"""
    for n, ending in enumerate((".cram", ".cram.crai", ".vcf.gz", ".vcf.gz.tbi"), 1)
)


@check("analysis_listing", f"""
SELECT 'C' || CAST(o_orderkey AS VARCHAR) AS id_repository, strftime(o_orderdate, '%Y-%m-%d') AS date_start, 'CITUS' AS pipeline_name,
  'run' || CAST(o_custkey AS VARCHAR) AS run_name, 'FC' || CAST(o_custkey AS VARCHAR) AS id_flowcell, CAST(o_orderkey % 90 AS VARCHAR) AS id_index,
  CAST(floor(o_totalprice) AS BIGINT) + 1 AS cram_size, 's3://b/run' || CAST(o_custkey AS VARCHAR) || '/C' || CAST(o_orderkey AS VARCHAR) || '.cram' AS cram,
  CAST(floor(o_totalprice) AS BIGINT) + 3 AS vcf_size, 's3://b/run' || CAST(o_custkey AS VARCHAR) || '/C' || CAST(o_orderkey AS VARCHAR) || '.vcf.gz.tbi' AS vcf_index
FROM orders WHERE o_orderstatus <> 'P'
""")
def _listing(t):
    rows = t.sql(LISTING)
    lane = F.concat(
        F.lit("/in/FC"), F.col("o_custkey").cast("string"), F.lit("_L01_"), (F.col("o_orderkey") % 90).cast("string"), F.lit("_1.fq.gz")
    )
    sheet = t["orders"].select(F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("ID"), lane.alias("R1"), lane.alias("R2"))
    out = inventory.analysis_from_listing(rows, sheet, "b")
    return out.select(
        "id_repository", day("date_start").alias("date_start"), "pipeline_name", "run_name", "id_flowcell", "id_index",
        "cram_size", "cram", "vcf_size", "vcf_index",
    )


# --- reports --------------------------------------------------------------


@check("explode_reports", """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linestatus AS hubs, CAST(l_partkey + k AS VARCHAR) AS drug_name,
  l_returnflag AS phenotype_text, CAST(l_linenumber AS SMALLINT) AS rec_category, l_linestatus AS test_method, 'v1' AS version
FROM lineitem, (VALUES (0), (1)) v(k)
""")
def _reports(t):
    """One JSON report per line with two recommendations."""
    def rec(k):
        return F.struct(
            (F.col("l_partkey") + k).cast("string").alias("drug_name"), F.col("l_returnflag").alias("phenotype_text"),
            F.col("l_linenumber").cast("string").alias("rec_category"),
        )

    report = F.struct(
        F.struct(F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_linestatus").alias("ordered_by")).alias("order_details"),
        F.struct(F.col("l_linestatus").alias("test_method")).alias("sample_details"),
        F.lit("v1").alias("version"), F.array(rec(0), rec(1)).alias("clinical_recommendations"),
    )
    files = t["lineitem"].select(F.to_json(report).alias("content"))
    return reports.explode_reports(files).select(
        "order_id", "hubs", "drug_name", "phenotype_text", "rec_category", "test_method", "version"
    )


@check("flatten_stats", """
SELECT 'C' || CAST(o_orderkey AS VARCHAR) || '_r' AS run_name, 'x.stats.json' AS file_name, 'C' || CAST(o_orderkey AS VARCHAR) AS id_repository,
  CAST(o_custkey AS VARCHAR) AS "N50", CAST(o_custkey + 1 AS VARCHAR) AS "Yield (reads >=1000bp)", CAST(o_custkey + 2 AS VARCHAR) AS "Bases with >=10-fold coverage",
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey + 3 AS VARCHAR) END AS "Bases with >=20-fold coverage"
FROM orders
""")
def _stats(t):
    n = F.col("o_custkey")
    folds = F.create_map(F.lit("10"), n + 2, F.lit("20"), F.when(F.col("o_orderstatus") != "P", n + 3))
    content = F.to_json(
        F.struct(n.alias("N50"), F.create_map(F.lit("1000"), n + 1).alias(reports.YIELD_MAP), folds.alias(reports.COVERAGE_MAP))
    )
    files = t["orders"].select(
        F.concat(F.lit("C"), F.col("o_orderkey").cast("string"), F.lit("_r/x.stats.json")).alias("key"), content.alias("content")
    )
    return reports.flatten_stats(files, ["N50"], ["1000"], ["10", "20"])


@check("stats_thresholds", """
SELECT 'C' || CAST(o_orderkey AS VARCHAR) || '_r' AS run_name, 'fold' AS kind, CAST(unnest([10, 40]) AS VARCHAR) AS threshold,
  CAST(o_custkey AS VARCHAR) AS value FROM orders
UNION ALL SELECT 'C' || CAST(o_orderkey AS VARCHAR) || '_r', 'yield', '1000', CAST(o_custkey + 1 AS VARCHAR) FROM orders
""")
def _thresholds(t):
    """Every threshold of both maps, listed or not."""
    n = F.col("o_custkey")
    folds = F.create_map(F.lit("10"), n, F.lit("40"), n)
    content = F.to_json(F.struct(F.create_map(F.lit("1000"), n + 1).alias(reports.YIELD_MAP), folds.alias(reports.COVERAGE_MAP)))
    files = t["orders"].select(
        F.concat(F.lit("C"), F.col("o_orderkey").cast("string"), F.lit("_r/x.stats.json")).alias("key"), content.alias("content")
    )
    return reports.stats_thresholds(files).select("run_name", "kind", "threshold", "value")


@check("html_extract", """
SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
  CAST(len(regexp_extract_all(html, '<a href=')) AS BIGINT) AS links, regexp_extract(html, 'track\\(([0-9]+)\\)', 1) AS track
FROM pages
""")
def _html(t):
    """The same extraction on the page table: whole texts, pattern by pattern."""
    return t["pages"].select(
        "page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.regexp_count("html", F.lit("<a href=")).cast("bigint").alias("links"),
        F.regexp_extract("html", r"track\(([0-9]+)\)", 1).alias("track"),
    )


@check("html_barcodes", """
SELECT 'LIB' || CAST(l_orderkey AS VARCHAR) AS id_library, 'C' || CAST(l_partkey AS VARCHAR) || '_t' AS alias, 'C' || CAST(l_partkey AS VARCHAR) AS id_repository,
  CAST(floor(l_extendedprice) AS BIGINT) AS total_bases, CASE WHEN l_discount = 0 THEN NULL ELSE CAST(floor(CAST(CAST(floor(l_extendedprice) AS BIGINT) AS DOUBLE) * (CAST(CAST(round(l_discount * 100) AS BIGINT) AS DOUBLE) / 100)) AS BIGINT) END AS total_passed_bases
FROM lineitem
""")
def _barcodes(t):
    """Barcode rows of JSON embedded in one HTML report per line."""
    entry = F.struct(
        F.concat(F.lit("C"), F.col("l_partkey").cast("string"), F.lit("_t")).alias("barcode"),
        F.col("l_extendedprice").cast("bigint").alias("total_bases"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("passed_bases_percent"),
    )
    files = t["lineitem"].select(
        F.concat(F.lit("LIB"), F.col("l_orderkey").cast("string"), F.lit("/no_sample/a/report_x.html")).alias("key"),
        F.concat(
            F.lit('<html><script>{"x": 1, "barcode_reads" : '), F.to_json(F.array(entry)), F.lit(', "y": []}</script></html>')
        ).alias("content"),
    )
    out = reports.parse_html_reports(files)
    return out.select(
        "id_library", "alias", "id_repository", F.col("total_bases").cast("bigint").alias("total_bases"), "total_passed_bases"
    )


@check("run_summary", """
SELECT 'r' || CAST(o_orderkey AS VARCHAR) || '/' AS prefix, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS started_at, o_orderstatus AS instrument,
       CAST(o_custkey AS VARCHAR) AS id_flowcell, CAST(NULL AS VARCHAR) AS position
FROM orders
""")
def _summary(t):
    content = F.concat(
        F.lit("protocol=x y\nstarted="), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("\ninstrument="),
        F.col("o_orderstatus"), F.lit(" z\nflow_cell_id="), F.col("o_custkey").cast("string"), F.lit("\n"),
    )
    files = t["orders"].select(
        F.concat(F.lit("r"), F.col("o_orderkey").cast("string"), F.lit("/final_summary.txt")).alias("key"), content.alias("content")
    )
    return reports.parse_summary(files).select("prefix", "started_at", "instrument", "id_flowcell", "position")


@check("ont_chain", """
SELECT 'L' || k AS id_library, 's3://b/L' || k || '/s/bam_pass/C' || k || '_t/' AS bam_folder, 'C' || k || '_t' AS alias, 'C' || k AS id_repository, total_bases, bam_size, date_upload,
  CASE WHEN o_orderkey % 2 = 0 THEN 'i' || o_orderstatus END AS instrument
FROM (SELECT *, CAST(o_orderkey AS VARCHAR) AS k, CASE WHEN o_orderstatus = 'O' THEN CAST(o_custkey AS BIGINT) END AS total_bases, CAST(10 + o_custkey AS BIGINT) AS bam_size,
  strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS date_upload FROM orders)
""")
def _ont_chain(t):
    """Reports of some runs, empty ones of others, folders for the rest; folder sizes and summaries joined to all."""
    status, key = F.col("o_orderstatus"), F.col("o_orderkey").cast("string")
    prefix = F.concat(F.lit("L"), key, F.lit("/s/"))
    barcode = F.concat(F.lit("C"), key, F.lit("_t"))
    entry = F.to_json(F.array(F.struct(barcode.alias("barcode"), F.col("o_custkey").cast("bigint").alias("total_bases"), F.lit(50).cast("bigint").alias("passed_bases_percent"))))
    html = F.concat(F.lit('<script>{"barcode_reads": '), F.when(status == "O", entry).otherwise("[]"), F.lit("}</script>"))
    files = t["orders"].filter(status != "P").select(F.concat(prefix, F.lit("report_1.html")).alias("key"), html.alias("content"))
    objects = [("/a.bam", F.lit(10), F.col("o_orderdate"), barcode), ("/b.bam", F.col("o_custkey"), F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"), barcode),
               ("/c.bam", F.lit(7), F.col("o_orderdate"), F.lit("barcode01")), ("/d.bam", F.lit(7), F.col("o_orderdate"), F.lit("Unclassified"))]
    inventory = None
    for name, size, date, folder in objects:
        part = t["orders"].select(F.concat(prefix, F.lit("bam_pass/"), folder, F.lit(name)).alias("key"), size.cast("bigint").alias("size"), date.cast("timestamp").alias("last_modified"))
        inventory = part if inventory is None else inventory.unionByName(part)
    summaries = t["orders"].filter("o_orderkey % 2 = 0").select(
        F.concat(prefix, F.lit("final_summary_x.txt")).alias("key"), F.concat(F.lit("instrument=i"), status, F.lit("\n")).alias("content")
    )
    out = reports.ont_samples(reports.ont_barcodes(files, inventory), reports.parse_summary(summaries), inventory, "b")
    return out.select("id_library", "bam_folder", "alias", "id_repository", F.col("total_bases").cast("bigint").alias("total_bases"), F.col("bam_size").cast("bigint").alias("bam_size"), "date_upload", "instrument")


@check("log_lines", """
SELECT conv_id, turn, CAST(len(string_split(text, chr(10))) AS BIGINT) AS lines,
  CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[0-9]'))) AS BIGINT) AS numbered
FROM conversations
""")
def _log_lines(t):
    lines = F.split("text", "\n")
    return t["conversations"].select(
        "conv_id", "turn", F.size(lines).cast("bigint").alias("lines"),
        F.size(F.filter(lines, lambda x: x.rlike("[0-9]"))).cast("bigint").alias("numbered"),
    )


@check("log_parse", """
SELECT o_orderkey, 'B' || CAST(o_custkey AS VARCHAR) AS biosample_name, CAST(o_custkey AS VARCHAR) AS biosample_id,
  CAST(floor(o_totalprice) AS BIGINT) AS computed_yield_bps, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderkey + 7 AS VARCHAR) END AS generated_sample_id
FROM orders
""")
def _log(t):
    """Yield line, then other lines, then perhaps the generated sample."""
    text = F.col("o_custkey").cast("string")
    content = F.concat(
        F.lit("start\nComputed yield for biosample 'B"), text, F.lit("' (Id: "), text, F.lit("): "),
        F.col("o_totalprice").cast("bigint").cast("string"), F.lit(" Bps\nother line\n"),
        F.when(F.col("o_orderstatus") == "P", "end").otherwise(
            F.concat(F.lit("Generated new Sample:  "), (F.col("o_orderkey") + 7).cast("string"))
        ),
    )
    return reports.parse_yield_log(t["orders"].select("o_orderkey", content.alias("content")), ["o_orderkey"])


def _sessions(t):
    """One session per line, with one run item."""
    run = F.struct(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("Id"), F.col("l_returnflag").alias("Name"),
        F.struct(F.col("l_quantity").alias("YieldTotal"), F.col("l_tax").alias("PercentGtQ30")).alias("SequencingStats"),
    )
    rows = t["lineitem"].withColumn("runs", F.array(run)).join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    none = F.lit(None).cast(rows.schema["runs"].dataType)

    def item(name, content, items=none):
        return F.struct(F.lit(name).alias("Name"), content.alias("Content"), items.alias("RunItems"))

    log = F.concat(F.lit("Computed yield for biosample 'B"), F.col("o_custkey").cast("string"), F.lit("' (Id: 5): 77 Bps"))
    items = F.array(
        item("ICA.ProjectId", F.lit("first")), item("ICA.ProjectId", F.col("o_orderpriority")),
        item("Input.Runs", F.lit(None).cast("string"), F.col("runs")), item("Logs.Tail", log),
    )
    text = F.to_json(
        F.struct(
            F.col("o_orderkey").cast("string").alias("Id"),
            F.when(F.col("o_orderstatus") != "P", "x BCLConvert").otherwise("other").alias("Name"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSS'Z'").alias("DateModified"),
            F.struct(items.alias("Items")).alias("Properties"),
        )
    )
    # a generator: later filters and columns read the parsed text instead of parsing it once more each
    parsed = F.explode(F.array(F.from_json(text, reports.SESSION))).alias("s")
    return rows.select(parsed).select("s.*")


@check("session_runs", """
SELECT CAST(o_orderkey AS VARCHAR) AS session_id, o_orderpriority AS ica_project_id, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS run_id,
  l_returnflag AS run_name, l_quantity AS yield_total, l_tax AS percent_gt_q30
FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' AND o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'
""")
def _session_runs(t):
    out = reports.sessions_to_runs(_sessions(t), "1997-01-01")
    return out.select(
        "session_id", "ica_project_id", "run_id", "run_name", F.col("total_flowcell_yield_Gbps").alias("yield_total"), "percent_gt_q30"
    )


@check("session_biosamples", """
SELECT CAST(o_orderkey AS VARCHAR) AS session_id, l_returnflag AS run_name, 'B' || CAST(o_custkey AS VARCHAR) AS biosample_name, '5' AS biosample_id, CAST(77 AS BIGINT) AS computed_yield_bps
FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' AND o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'
""")
def _session_samples(t):
    out = reports.sessions_to_biosamples(_sessions(t), "1997-01-01")
    return out.select("session_id", "run_name", "biosample_name", "biosample_id", "computed_yield_bps")


@check("flatten_records", """
SELECT o_orderkey, 'a' || CAST(o_custkey AS VARCHAR) AS application_id, o_orderstatus AS application_name FROM orders
""")
def _flatten(t):
    raw = F.concat(
        F.lit("{'id': 'a"), F.col("o_custkey").cast("string"), F.lit("', 'name': '"), "o_orderstatus", F.lit("', 'x': None}")
    )
    rows = t["orders"].select("o_orderkey", raw.alias("application"))
    return bronze.flatten_records(rows, "application", "id string, name string", "application_").drop("application")


# --- sheets ---------------------------------------------------------------


@check("sheets_union", """
SELECT 'S' || CAST(o_orderkey AS VARCHAR) || '_1' AS code_repository, 'ILLUMINA' AS platform, 0.0 AS volume_remain,
  strftime(o_orderdate, '%Y-%m-%d') AS delivery_date, CAST(NULL AS VARCHAR) AS sequencing_start_date, o_orderstatus AS extraction_status
FROM orders WHERE o_orderstatus <> 'P'
UNION ALL
SELECT 'S' || CAST(o_orderkey AS VARCHAR), 'ONT', CASE WHEN o_orderstatus = 'F' THEN NULL ELSE round(o_totalprice, 2) END,
  strftime(o_orderdate, '%Y-%m-%d'), strftime(o_orderdate, '%Y-%m-%d'), o_orderpriority FROM orders
""")
def _sheets(t):
    """Two wide sheets made from the orders; only positions are known."""
    def wide(width, filled):
        return t["orders"].select(*[filled.get(i, F.lit("-")).alias(f"c{i}") for i in range(width)])

    key = F.concat(F.lit("S"), F.col("o_orderkey").cast("string"))
    coded = F.when(F.col("o_orderstatus") != "P", F.concat(key, F.lit(".1")))
    dashed, compact = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "yyMMdd")
    first = wide(76, {4: coded, 10: dashed, 16: F.lit("bad"), 26: F.col("o_orderstatus")})
    volume = F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice").cast("string")).otherwise("n/a")
    second = wide(74, {2: key, 7: volume, 6: compact, 27: F.col("o_orderpriority"), 71: compact})
    out = sheets.sheets_union([(first, sheets.SHEETS["illumina_2024"]), (second, sheets.SHEETS["ont"])])
    return out.select(
        "code_repository", "platform", cents("volume_remain").alias("volume_remain"), day("delivery_date").alias("delivery_date"),
        day("sequencing_start_date").alias("sequencing_start_date"), "extraction_status",
    )


@check("sheets_others", """
SELECT 'A' || CAST(o_orderkey AS VARCHAR) AS code_repository, 'ILLUMINA' AS platform, round(o_totalprice, 2) AS volume_remain, strftime(o_orderdate, '%Y-%m-%d') AS delivery_date,
  strftime(o_orderdate, '%Y-%m-%d %H:%M') AS extraction_date, strftime(o_orderdate, '%Y-%m-%d') AS finish, o_orderstatus AS sequencing_status FROM orders
UNION ALL SELECT 'B' || CAST(o_orderkey AS VARCHAR), 'MGI', round(o_totalprice, 2), NULL, strftime(o_orderdate, '%Y-%m-%d') || ' 08:30', strftime(o_orderdate, '%Y-%m-%d'), o_orderstatus FROM orders
UNION ALL SELECT 'C' || CAST(o_orderkey AS VARCHAR), 'MGI', round(o_totalprice, 2), NULL, strftime(o_orderdate, '%Y-%m-%d') || ' 08:30', strftime(o_orderdate, '%Y-%m-%d'), o_orderstatus FROM orders
UNION ALL SELECT 'D' || CAST(o_orderkey AS VARCHAR), 'MGI', round(o_totalprice, 2), NULL, strftime(o_orderdate, '%Y-%m-%d') || ' 08:30', strftime(o_orderdate, '%Y-%m-%d'), o_orderstatus FROM orders
""")
def _other_sheets(t):
    """The other four sheets, each with its own positions and date formats."""
    def wide(width, mark, code, filled):
        key = F.concat(F.lit(mark), F.col("o_orderkey").cast("string"))
        return t["orders"].select(*[(key if i == code else filled.get(i, F.lit("-"))).alias(f"c{i}") for i in range(width)])

    volume, status = F.col("o_totalprice").cast("string"), F.col("o_orderstatus")
    dashed, slashed = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "yyyy/MM/dd")
    timed, spaced = F.date_format("o_orderdate", "yyMMdd';08:30'"), F.date_format("o_orderdate", "yyMMdd'; 08:30'")
    made = [
        ("illumina_2025", wide(74, "A", 5, {9: volume, 10: dashed, 15: slashed, 71: slashed, 73: status})),
        ("mgi_2024", wide(79, "B", 2, {7: volume, 11: timed, 69: dashed, 78: status})),
        ("mgi_2025", wide(62, "C", 4, {8: volume, 10: spaced, 59: dashed, 61: status})),
        ("mgi_2025_from_ont", wide(63, "D", 4, {8: volume, 10: spaced, 60: dashed, 62: status})),
    ]
    out = sheets.sheets_union([(rows, sheets.SHEETS[name]) for name, rows in made])
    return out.select(
        "code_repository", "platform", cents("volume_remain").alias("volume_remain"), day("delivery_date").alias("delivery_date"),
        F.date_format("extraction_date", "yyyy-MM-dd HH:mm").alias("extraction_date"), day("sequencing_finish_date").alias("finish"), "sequencing_status",
    )


@check("any_recent", "SELECT 1 AS found FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' LIMIT 1")
def _any(t):
    objects = t["events"].select(F.col("event_type").alias("key"), F.col("ts").alias("last_modified"))
    return inventory.any_recent(objects, "2024-01-20").select(flag(F.col("key").isNotNull()).alias("found"))


# --- the report chain -----------------------------------------------------


@check("report_chain", """
WITH reports AS (
  SELECT o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS custkey, o_orderstatus, o_orderkey % 3 <> 2 AS first_day, o_orderkey % 3 = 0 AS renewed FROM orders WHERE o_orderkey % 3 > 0 OR o_orderkey % 2 = 0),
days AS (SELECT *, CASE WHEN first_day AND NOT renewed THEN 1 ELSE 2 END AS seen FROM reports)
SELECT 'R' || CAST(k AS VARCHAR) AS order_id, 'D' || drug AS drug_name, 'G' || custkey AS gene_symbol, CASE WHEN seen = 1 THEN 'one' ELSE 'two' END AS phenotype_text, seen AS fetched_on
FROM days, (VALUES ('a'), ('b')) v(drug)
""")
def _chain(t):
    """Two days of a report status: new reports are fetched, renewed ones again, others not; the second day is tried twice."""
    orders = t["orders"].filter("o_orderkey % 3 > 0 OR o_orderkey % 2 = 0")
    key = F.col("o_orderkey")
    path = F.concat(F.lit("out/"), key.cast("string"), F.lit("/ind.json"))
    prefix = f"s3://{B.pgx_output}/"

    def status(today):
        """Reports of the first day, and on the second new ones and those with a new date."""
        date = F.when(F.lit(today == 2) & ((key % 3 == 2) | (key % 3 == 0)), "2025-01-02").otherwise("2025-01-01")
        rows = orders.filter((key % 3 != 2) | F.lit(today == 2))
        return rows.select(F.concat(F.lit(prefix), path).alias("report_path_ind"), date.cast("timestamp").alias("ind_report_creation_date")).unionByName(
            rows.limit(5).select(F.lit("nan").alias("report_path_ind"), date.cast("timestamp").alias("ind_report_creation_date"))
        )

    def contents(today):
        def rec(drug):
            return F.struct(
                F.lit(f"D{drug}").alias("drug_name"), F.concat(F.lit("G"), F.col("o_custkey").cast("string")).alias("gene_symbol"),
                F.lit(today).alias("phenotype_text"),
            )

        report = F.struct(
            F.struct(F.concat(F.lit("R"), key.cast("string")).alias("order_id"), F.lit("h").alias("ordered_by")).alias("order_details"),
            F.struct(F.lit("m").alias("test_method")).alias("sample_details"), F.array(rec("a"), rec("b")).alias("clinical_recommendations"),
        )
        files = orders.select(path.alias("path"), F.to_json(report).alias("content"))
        return lambda due: files.join(due.select("path"), "path", "left_semi")

    details, state = report_chain.detail_table(t.spark, scratch(t), 4), report_chain.state_table(t.spark, scratch(t), 4)
    done = [
        report_chain.run_chain(status(day), "2024-10-01", contents(word), details, state, run)
        for day, word, run in ((1, "one", "d1"), (2, "two", "d2"), (2, "three", "d2-again"))
    ]
    if done != [True, True, False]:
        raise AssertionError(done)
    fetched = state.read().select("path", F.dayofmonth("fetched_version").alias("fetched_on"))
    number = F.regexp_extract("order_id", r"\d+", 0)
    rows = details.read().withColumn("path", F.concat(F.lit("out/"), number, F.lit("/ind.json"))).join(fetched, "path")
    return rows.select("order_id", "drug_name", "gene_symbol", "phenotype_text", "fetched_on")
