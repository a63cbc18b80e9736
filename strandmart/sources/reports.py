"""Report parsers: JSON, HTML and log text to rows, with built-in expressions only.

A reader gives (key, content) with one file per row; files are read in
parallel and one file never meets another.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmart.functions.dates import parse_nanos
from strandmart.functions.text import capture_or_null, part
from strandmart.session import shared_folder


def read_whole(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(key, content) of every file that fits the glob."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    key = F.regexp_replace(F.col("_metadata.file_path"), f"^.*?{path.rstrip('/')}/", "")
    return files.select(key.alias("key"), F.col("value").alias("content"))


# Fields of one recommendation.
RECOMMENDATION = (
    "drug_name string, phenotype_text string, gene_symbol string, branded_drug string, "
    "drug_category string, drug_classification string, nala_score_v2 string, rec_category string, "
    "rec_source string, rec_text string, run_id string, scientific_evidence_symbol string, "
    "implication_text string"
)
REPORT = (
    "order_details struct<order_id: string, ordered_by: string>, "
    "sample_details struct<test_method: string>, version string, "
    f"clinical_recommendations array<struct<{RECOMMENDATION.replace(' string', ': string')}>>"
)
REPORT_COLUMNS = [
    "order_id", "hubs", "drug_category", "drug_name", "drug_classification", "phenotype_text",
    "gene_symbol", "branded_drug", "nala_score_v2", "rec_category", "rec_source", "rec_text",
    "run_id", "scientific_evidence_symbol", "implication_text", "test_method", "version",
]


def explode_reports(reports: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per recommendation with the order, sample and version of its report, and columns of the report to keep."""
    parsed = reports.select(*keep, F.from_json("content", REPORT).alias("r"))
    rows = parsed.select(
        *keep,
        F.col("r.order_details.order_id").alias("order_id"),
        F.col("r.order_details.ordered_by").alias("hubs"),
        F.col("r.sample_details.test_method").alias("test_method"),
        F.coalesce("r.version", F.lit("")).alias("version"),
        F.explode("r.clinical_recommendations").alias("rec"),
    )
    flat = rows.select(*keep, "order_id", "hubs", "test_method", "version", "rec.*")
    return flat.select(*keep, *REPORT_COLUMNS).withColumn("rec_category", F.col("rec_category").try_cast("smallint"))


def report_versions(reports: DataFrame) -> DataFrame:
    return reports.select("key", F.coalesce(F.get_json_object("content", "$.version"), F.lit("")).alias("version"))


# Names of the two threshold maps and the thresholds kept as columns.
YIELD_MAP = "Yield (reads >=Nbp)"
COVERAGE_MAP = "Bases with >=N-fold coverage"
COVERAGE_STEPS = ("1", "10", "15", "20", "30")


def flatten_stats(files: DataFrame, fields: Sequence[str], yields: Sequence[str] = (), folds=COVERAGE_STEPS) -> DataFrame:
    """Stats JSON to one row: plain fields, one column per threshold, run and file name."""
    plain = F.from_json("content", "map<string,string>")

    def steps(name):
        return F.from_json(F.element_at("_all", name), "map<string,string>")

    out = files.withColumn("_all", plain).withColumns({"_yield": steps(YIELD_MAP), "_fold": steps(COVERAGE_MAP)})
    run = part("key", "/", 1)
    return out.select(
        *[F.element_at("_all", f).alias(f) for f in fields],
        *[F.element_at("_yield", n).alias(f"Yield (reads >={n}bp)") for n in yields],
        *[F.element_at("_fold", n).alias(f"Bases with >={n}-fold coverage") for n in folds],
        run.alias("run_name"),
        part("key", "/", -1).alias("file_name"),
        F.split(run, "_")[0].alias("id_repository"),
    )


def stats_thresholds(files: DataFrame) -> DataFrame:
    """All thresholds of the stats JSON as rows: run and file name, kind (yield or fold), threshold, value."""
    every = F.from_json("content", "map<string,string>")

    def entries(kind, name):
        return F.transform(
            F.map_entries(F.from_json(F.element_at("_all", name), "map<string,string>")),
            lambda e: F.struct(F.lit(kind).alias("kind"), e["key"].alias("threshold"), e["value"].alias("value")),
        )

    maps = [entries("yield", YIELD_MAP), entries("fold", COVERAGE_MAP)]
    none = F.array().cast("array<struct<kind:string,threshold:string,value:string>>")
    rows = files.withColumn("_all", every).select("key", F.explode(F.concat(*(F.coalesce(m, none) for m in maps))).alias("t"))
    run = part("key", "/", 1)
    return rows.select(
        run.alias("run_name"), part("key", "/", -1).alias("file_name"), F.split(run, "_")[0].alias("id_repository"), "t.*"
    )


BARCODE = "array<struct<barcode: string, total_bases: double, passed_bases_percent: double>>"


def parse_html_reports(reports: DataFrame) -> DataFrame:
    """Barcode rows of the JSON array embedded in a run report."""
    embedded = capture_or_null("content", r'(?s)"barcode_reads"\s*:\s*(\[\{.*?\}\])')
    rows = reports.select("key", F.explode(F.from_json(embedded, BARCODE)).alias("b")).select("key", "b.*")
    return _barcode_fields(rows)


def barcodes_from_folders(inventory: DataFrame, reported: DataFrame) -> DataFrame:
    """Fallback for runs without a usable report: barcodes are the alignment folders."""
    path = F.split("key", "/bam_pass/")
    rows = inventory.filter(F.col("key").contains("/bam_pass/")).select(
        F.concat(path[0], F.lit("/")).alias("prefix"), part(path[1], "/", 1).alias("barcode")
    )
    rows = rows.filter(~F.lower("barcode").rlike("^(barcode|unclassified)")).distinct()
    return rows.join(reported.select("prefix").distinct(), "prefix", "left_anti")


def ont_barcodes(reports: DataFrame, inventory: DataFrame) -> DataFrame:
    """Barcodes of all runs: those of the reports, and for runs without a usable report the alignment folders, whose bases are unknown."""
    reported = parse_html_reports(reports)
    kinds = dict(reported.dtypes)
    unknown = {c: F.lit(None).cast(kinds[c]) for c in ("total_bases", "passed_bases_percent")}
    folders = barcodes_from_folders(inventory, reported).withColumns({"key": F.col("prefix"), **unknown})
    return reported.unionByName(_barcode_fields(folders).select(*reported.columns))


def _barcode_fields(rows: DataFrame) -> DataFrame:
    bases, percent = F.col("total_bases"), F.col("passed_bases_percent")
    passed = F.when((bases != 0) & (percent != 0), F.floor(bases * (percent / 100)))
    return rows.withColumns(
        {
            "prefix": F.regexp_replace("key", "[^/]+$", ""),
            "id_library": part("key", "/", 1),
            "alias": F.col("barcode"),
            "id_repository": F.split("barcode", "_")[0],
            "total_passed_bases": passed,
        }
    )


# Fields of the run summary and their column names.
SUMMARY_FIELDS = {
    "started": "started_at",
    "acquisition_stopped": "acquisition_stopped",
    "processing_stopped": "processing_stopped",
    "instrument": "instrument",
    "position": "position",
    "flow_cell_id": "id_flowcell",
}


def parse_summary(files: DataFrame) -> DataFrame:
    """Six ``key=value`` fields of a run summary."""
    return files.select(
        F.regexp_replace("key", "[^/]+$", "").alias("prefix"),
        *[capture_or_null("content", rf"{f}=(\S+)").alias(c) for f, c in SUMMARY_FIELDS.items()],
    )


def ont_samples(barcodes: DataFrame, summaries: DataFrame, inventory: DataFrame, bucket: str) -> DataFrame:
    """Barcode rows with folder size, newest upload and run summary."""
    from strandmart.operators.joins import left_on

    folder = F.concat("prefix", F.lit("bam_pass/"), "barcode", F.lit("/"))
    parts = F.split("key", "/bam_pass/")
    objects = inventory.filter(F.col("key").contains("/bam_pass/")).select(
        F.concat(parts[0], F.lit("/bam_pass/"), part(parts[1], "/", 1), F.lit("/")).alias("folder"),
        "size", "last_modified",
    )
    sizes = objects.groupBy("folder").agg(
        F.sum("size").alias("bam_size"), F.max("last_modified").alias("date_upload")
    )
    out = left_on(barcodes.withColumn("_folder", folder), sizes, {"_folder": "folder"}, ["bam_size", "date_upload"])
    out = left_on(out, summaries, {"prefix": "prefix"}, list(SUMMARY_FIELDS.values()))
    return out.select(
        "id_library", F.concat(F.lit(f"s3://{bucket}/"), "_folder").alias("bam_folder"), "alias",
        "id_repository", "total_bases", "passed_bases_percent", "total_passed_bases",
        F.coalesce("bam_size", F.lit(0)).alias("bam_size"),
        F.date_format("date_upload", "yyyy-MM-dd HH:mm:ss").alias("date_upload"),
        *SUMMARY_FIELDS.values(),
    )


RUN_ITEM = (
    "struct<Id: string, Name: string, FlowcellBarcode: string, ReagentBarcode: string, Status: string, "
    "ExperimentName: string, DateCreated: string, "
    "SequencingStats: struct<YieldTotal: double, PercentGtQ30: double>>"
)
SESSION = (
    "Id string, Name string, DateCreated string, DateModified string, ExecutionStatus string, "
    f"HrefIcaAnalysis string, Properties struct<Items: array<struct<Name: string, Content: string, RunItems: array<{RUN_ITEM}>>>>"
)


def _recent_sessions(sessions: DataFrame, ds) -> DataFrame:
    changed = F.coalesce(parse_nanos("DateModified"), parse_nanos("DateCreated"))
    kept = F.col("Name").contains("BCLConvert") & F.col("Id").isNotNull() & (changed >= F.lit(ds).cast("timestamp"))
    runs = F.filter("items", lambda i: i.Name == "Input.Runs")
    return sessions.filter(kept).withColumn("items", F.col("Properties.Items")).select(
        F.col("Id").alias("session_id"), F.col("Name").alias("session_name"),
        F.col("DateCreated").alias("date_created"), F.col("DateModified").alias("date_modified"),
        F.col("ExecutionStatus").alias("execution_status"), F.col("HrefIcaAnalysis").alias("ica_link"),
        "items", F.try_element_at(runs, F.lit(-1)).getField("RunItems").alias("run_items"),
    )


def _property(name: str) -> Column:
    """Content of the last item of a name: the last of equal names wins, as in a dictionary."""
    return F.try_element_at(F.filter("items", lambda i: i.Name == name), F.lit(-1)).getField("Content")


def sessions_to_runs(sessions: DataFrame, ds) -> DataFrame:
    """Run rows of conversion sessions changed since the cut-off."""
    shared = ["session_id", "session_name", "date_created", "date_modified", "execution_status", "ica_link", "ica_project_id", "workflow_reference"]
    rows = _recent_sessions(sessions, ds).withColumns(
        {"ica_project_id": _property("ICA.ProjectId"), "workflow_reference": _property("ICA.WorkflowSessionUserReference")}
    ).select(*shared, F.explode("run_items").alias("run"))
    return rows.select(
        *shared,
        F.col("run.Id").alias("run_id"), F.col("run.Name").alias("run_name"),
        F.col("run.SequencingStats.PercentGtQ30").alias("percent_gt_q30"),
        F.col("run.FlowcellBarcode").alias("flowcell_barcode"),
        F.col("run.ReagentBarcode").alias("reagent_barcode"),
        F.col("run.Status").alias("status"), F.col("run.ExperimentName").alias("experiment_name"),
        F.col("run.DateCreated").alias("run_date_created"),
        F.col("run.SequencingStats.YieldTotal").alias("total_flowcell_yield_Gbps"),
    )


YIELD_LINE = r"Computed yield for biosample '([^']+)' \(Id: (\d+)\): (\d+)\s+Bps"


#: Where a generated sample is reported: the text is cut there, so that a piece begins with the id that ends the piece before.
GENERATED = r"Generated new Sample:\s+(?=\d)"
#: Names of these characters only are found inside words of the text; others, which are rare, are looked up in the whole text.
WORD = r"^[\w.-]+$"


def _first_mentions(names: DataFrame, pieces: DataFrame, texts: DataFrame) -> DataFrame:
    """``log``, ``name`` and ``piece``: the first piece of the log that holds the name, also inside longer words."""
    plain = names.filter(F.col("name").rlike(WORD))
    lengths = plain.groupBy("log").agg(F.collect_set(F.length("name")).alias("lengths"))
    words = pieces.select("log", "piece", F.explode(F.array_distinct(F.split("text", r"[^\w.-]+"))).alias("word"))
    words = words.filter(F.col("word") != "").groupBy("log", "word").agg(F.min("piece").alias("piece"))
    # every part of a word that is as long as some name: as many rows as the distinct words have characters, for each length
    parts = words.join(lengths, "log").withColumn("n", F.explode(F.filter("lengths", lambda n: n <= F.length("word"))))
    parts = parts.select("log", "piece", "n", "word", F.explode(F.sequence(F.lit(1), F.length("word") - F.col("n") + 1)).alias("at"))
    parts = parts.select("log", F.substr("word", "at", "n").alias("name"), "piece").groupBy("log", "name").agg(F.min("piece").alias("piece"))
    found = parts.join(plain, ["log", "name"], "left_semi")
    odd = names.filter(~F.col("name").rlike(WORD)).join(texts, "log")
    before = F.expr("substr(content, 1, locate(name, content) - 1)")
    return found.unionByName(odd.select("log", "name", (F.size(F.split(before, GENERATED)) - 1).alias("piece")))


#: Characters to go through, names times length, up to which a log's names are looked up in its own row.
ROW_WORK = 4_000_000


def _row_yields() -> Column:
    """Yields of a short log: name, id, yield and generated sample for each yield line."""
    lines = F.filter(F.split("content", r"\r\n|\r|\n"), lambda line: line.rlike(YIELD_LINE))
    pieces = F.split("content", GENERATED)

    def generated(name):
        holding = F.array_position(F.transform(pieces, lambda p: F.contains(p, name)), True)
        before = F.substr(F.col("content"), F.lit(1), F.position(name, "content") - 1)
        piece = F.when(name.rlike(WORD), holding).otherwise(F.size(F.split(before, GENERATED)))
        return F.regexp_extract(F.get(pieces, F.when(piece > 0, piece).cast("int")), r"^\d+", 0)

    def fields(line):
        name, ident, bps = (F.regexp_extract(line, YIELD_LINE, k) for k in (1, 2, 3))
        return F.struct(name.alias("name"), ident.alias("biosample_id"), bps.alias("bps"), generated(name).alias("generated_sample_id"))

    return F.transform(lines, fields)


def parse_yield_log(logs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Biosample yield rows of session log text (``content``).

    The generated sample is the first one reported after the first mention of the biosample, anywhere later in the text.  A log of
    few names is parsed in its own row.  For the others the work would grow with the square of the log: see ``_long_logs``.  The rows are
    written once, short logs parsed and long ones as they are, so the input is read once and short logs are never shuffled.
    """
    spark = logs.sparkSession
    names = F.size(F.split("content", "Computed yield for biosample '")) - 1
    is_short = names.cast("bigint") * F.length("content") <= ROW_WORK
    folder = f"{shared_folder(spark)}/logs-{uuid.uuid4().hex}"
    logs.filter(F.col("content").isNotNull()).select(
        *keep, F.when(is_short, _row_yields()).alias("_yields"), F.when(~is_short, F.col("content")).alias("content")
    ).write.parquet(folder)
    staged = spark.read.parquet(folder)
    parsed = staged.select(*keep, F.explode("_yields").alias("y")).select(*keep, "y.*")
    long = staged.filter(F.col("content").isNotNull()).drop("_yields")
    if not long.isEmpty():
        parsed = parsed.unionByName(_long_logs(long, keep))
    return parsed.select(
        *keep, F.col("name").alias("biosample_name"), "biosample_id", F.col("bps").try_cast("bigint").alias("computed_yield_bps"), "generated_sample_id"
    )


def _long_logs(logs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Yields of long logs.

    A text is cut into lines and into pieces between generated samples once; yields, first mentions and ids then meet in joins, so that
    time follows the length of the log and no row carries the whole text.
    """
    keyed = logs.withColumn("log", F.sha2("content", 256))
    texts = keyed.select("log", "content").dropDuplicates(["log"])
    lines = texts.select("log", F.explode(F.split("content", r"\r\n|\r|\n")).alias("line")).filter(F.col("line").rlike(YIELD_LINE))
    found = [F.regexp_extract("line", YIELD_LINE, k) for k in (1, 2, 3)]
    yields = lines.select("log", *[c.alias(n) for c, n in zip(found, ("name", "biosample_id", "bps"), strict=True)])
    pieces = texts.select("log", F.posexplode(F.split("content", GENERATED)).alias("piece", "text"))
    first = _first_mentions(yields.select("log", "name").distinct(), pieces, texts)
    ids = pieces.filter("piece > 0").select(
        "log", (F.col("piece") - 1).alias("piece"), F.regexp_extract("text", r"^\d+", 0).alias("generated_sample_id")
    )
    parsed = yields.join(first, ["log", "name"], "left").join(ids, ["log", "piece"], "left")
    return keyed.drop("content").join(parsed, "log").select(*keep, "name", "biosample_id", "bps", "generated_sample_id")


def sessions_to_biosamples(sessions: DataFrame, ds) -> DataFrame:
    """Yield rows per run of each recent session; a session's log is parsed once, whatever its runs."""
    runs = F.transform("run_items", lambda r: F.struct(r.Name.alias("run_name"), r.ExperimentName.alias("experiment_name"), r.DateCreated.alias("run_date_created")))
    shared = ["session_id", "session_name", "date_created"]
    rows = _recent_sessions(sessions, ds).filter(F.size("run_items") > 0)
    rows = rows.select(*shared, runs.alias("runs"), _property("Logs.Tail").alias("content"))
    found = ["biosample_name", "biosample_id", "computed_yield_bps", "generated_sample_id"]
    parsed = parse_yield_log(rows, [*shared, "runs"]).select(*shared, *found, F.explode("runs").alias("run"))
    return parsed.select(*shared, "run.*", *found)
