"""Object inventories: (bucket, key, size, last_modified)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmart.functions.rules import sample_and_run_from_path
from strandmart.functions.text import first_rule, part
from strandmart.operators.joins import left_on, override, prefix_join
from strandmart.settings import Buckets

# Endings of the QC files to copy, per pipeline.
DRAGEN_QC_FILES = [
    r".+\.cnv_metrics\.csv$",
    r".+\.gvcf_hethom_ratio_metrics\.csv$",
    r".+\.gvcf_metrics\.csv$",
    r".+\.hla_metrics\.csv$",
    r".+\.mapping_metrics\.csv$",
    r".+\.ploidy_estimation_metrics\.csv$",
    r".+\.qc-coverage-region-1_coverage_metrics\.csv$",
    r".+\.roh_metrics\.csv$",
    r".+\.sv_metrics\.csv$",
    r".+\.time_metrics\.csv$",
    r".+\.vc_hethom_ratio_metrics\.csv$",
    r".+\.vc_metrics\.csv$",
    r".+\.wgs_coverage_metrics\.csv$",
]
CITUS_QC_FILES = [
    r".+\.bcftools_stats_metrics\.txt$",
    r".+\.het_check_metrics\.csv$",
    r".+\.mosdepth\.global\.dist_metrics\.txt$",
    r".+\.mosdepth\.region\.dist_metrics\.txt$",
    r".+\.mosdepth\.summary_metrics\.txt$",
    r".+\.sex_check_metrics\.csv$",
    r".+_1_fastqc_metrics\.zip$",
    r".+_2_fastqc_metrics\.zip$",
    r".+_metrics\.stats$",
]


def from_files(spark: SparkSession, root: str, bucket: str) -> DataFrame:
    """Inventory of a folder, from file metadata only (no content is read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    key = F.regexp_replace(F.regexp_replace("path", "^file:/+", "/"), f"^{root.rstrip('/')}/", "")
    return files.select(
        F.lit(bucket).alias("bucket"), key.alias("key"), F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )


def prefix_of(key: Column | str, depth: int) -> Column:
    """First ``depth`` folders of a key, with a closing slash; null if there are fewer."""
    key = F.col(key) if isinstance(key, str) else key
    parts = F.split(key, "/")
    return F.when(
        F.size(parts) > depth, F.concat(F.array_join(F.slice(parts, 1, depth), "/"), F.lit("/"))
    )


def folder_stats(inventory: DataFrame, depth: int) -> DataFrame:
    """Size and newest upload per folder."""
    folders = inventory.withColumn("prefix", prefix_of("key", depth)).filter("prefix IS NOT NULL")
    return folders.groupBy("bucket", "prefix").agg(
        F.sum("size").alias("total_size"), F.max("last_modified").alias("latest")
    )


def recent_folders(inventory: DataFrame, ds, depth: int = 1) -> DataFrame:
    """Folders with an object at or after the cut-off."""
    recent = inventory.filter(F.col("last_modified") >= F.lit(ds))
    return recent.select("bucket", prefix_of("key", depth).alias("prefix")).filter("prefix IS NOT NULL").distinct()


def any_recent(inventory: DataFrame, ds) -> DataFrame:
    """One row when something is new, else none."""
    return inventory.filter(F.col("last_modified") >= F.lit(ds)).select("key").limit(1)


def _last(condition: Column, value: Column) -> Column:
    """Value of the last key that fits, as when files are visited in key order."""
    return F.max(F.when(condition, F.struct(F.col("key"), value.alias("v")))).getField("v")


def inventory_to_analysis(inventory: DataFrame, html: DataFrame | None = None) -> DataFrame:
    """One analysis row per run folder: alignment and variant file, pipeline, first date.

    ``html`` may give (key, content) of the alignment reports; the pipeline
    version is read from there.
    """
    path = F.concat(F.lit("s3://"), "bucket", F.lit("/"), "key")
    key = F.col("key")
    cram, vcf = key.rlike("cram$"), key.rlike(r"_snp\.vcf\.gz$")
    report = key.rlike(r"wf-human-alignment-report\.html$")
    runs = inventory.withColumn("run_name", part("key", "/", 1)).filter(key.contains("/"))
    if html is not None:
        version = F.regexp_extract(
            "content", r"wf-human-alignment-report.html</code> nextflow workflow \(([\d.]+)\)", 1
        )
        slim = html.select(F.col("key").alias("_key"), F.nullif(version, F.lit("")).alias("version"))
        runs = left_on(runs, slim, {"key": "_key"}, ["version"])
    else:
        runs = runs.withColumn("version", F.lit(None).cast("string"))
    name = F.concat(F.lit("wf-human-variation "), F.coalesce(F.col("version"), F.lit("None")))
    grouped = runs.groupBy("run_name").agg(
        _last(cram, path).alias("cram"),
        _last(cram, F.col("size")).alias("cram_size"),
        _last(~cram & vcf, path).alias("vcf"),
        _last(~cram & vcf, F.col("size")).alias("vcf_size"),
        _last(~cram & ~vcf & report, name).alias("pipeline_name"),
        F.max(F.when(~cram & ~vcf & report, F.lit("secondary"))).alias("pipeline_type"),
        F.min("last_modified").alias("date_start"),
    )
    ident = F.split(F.split("run_name", "[.]")[0], "_")[0]
    return grouped.select(ident.alias("id_repository"), "*")


def analysis_from_listing(listing: DataFrame, sheets: DataFrame, bucket: str) -> DataFrame:
    """Secondary-analysis rows from a file listing (Path, Name, Size, ModTime, IsDir),
    with the sample-sheet fields of each sample.

    Files are pivoted by type, the first path per type in path order.
    """
    from strandmart.operators.aggregates import pivot_first

    files = listing.filter(~F.col("IsDir")).select(
        F.split("Name", "[.]")[0].alias("id_repository"),
        part("Path", "/", 1).alias("run_name"),
        F.concat(F.lit(f"s3://{bucket}/"), "Path").alias("path"),
        F.col("Size").alias("size"),
        F.col("ModTime").alias("date_start"),
    )
    kind = first_rule(
        [
            (F.col("path").endswith(".cram"), "cram"),
            (F.col("path").endswith(".cram.crai"), "cram_index"),
            (F.col("path").endswith(".vcf.gz"), "vcf"),
            (F.col("path").endswith(".vcf.gz.tbi"), "vcf_index"),
        ]
    )
    kinds = {k: k for k in ("cram", "cram_index", "vcf", "vcf_index")}
    pivot = pivot_first(files, ["id_repository"], kind, kinds, {"path": "", "size": "_size"}, ["path"])
    variants = files.filter(kind == "vcf").select("id_repository", "run_name", "date_start")
    out = left_on(variants, pivot, {"id_repository": "id_repository"},
                  ["cram_size", "cram", "cram_index", "vcf_size", "vcf", "vcf_index"])
    out = left_on(out, sheet_lanes(sheets), {"id_repository": "sheet_id"},
                  ["id_flowcell", "id_index", "fastq_r1", "fastq_r2"])
    return out.select(
        "id_repository", "date_start", F.lit(None).cast("timestamp").alias("date_end"),
        F.lit("CITUS").alias("pipeline_name"), F.lit("secondary").alias("pipeline_type"),
        "run_name", F.lit("SUCCEEDED").alias("run_status"), "id_flowcell", "id_index",
        "fastq_r1", "fastq_r2", "cram_size", "cram", "cram_index", "vcf_size", "vcf", "vcf_index",
    )


def sheet_lanes(sheets: DataFrame) -> DataFrame:
    """Flow-cell and index ids from the first fastq name of a sample sheet (ID, R1, R2)."""
    stem = F.split(part("R1", "/", -1), r"\.fq\.gz")[0]
    return sheets.select(
        F.col("ID").alias("sheet_id"),
        part(stem, "_", 1).alias("id_flowcell"),
        part(stem, "_", 3).alias("id_index"),
        F.col("R1").alias("fastq_r1"),
        F.col("R2").alias("fastq_r2"),
    )


def qc_sync_plan(source: DataFrame, existing: DataFrame, ds, buckets: Buckets = Buckets()) -> DataFrame:
    """Copy plan of new QC files: (source bucket and key, target bucket and key)."""
    name = F.col("_name")

    def wanted(patterns):
        return name.rlike("^(?:" + "|".join(patterns) + ")")

    dragen, citus = F.col("bucket") == buckets.illumina, F.col("bucket") == buckets.citus
    fits = (dragen & wanted(DRAGEN_QC_FILES)) | (citus & wanted(CITUS_QC_FILES))
    folder, sample = part("key", "/", 3), part("key", "/", 4)
    target_key = F.when(dragen, F.concat_ws("/", folder, sample, name)).when(
        citus, F.concat_ws("/", part("key", "/", 1), name)
    )
    known_shape = ~dragen | sample.isNotNull()
    recent = F.col("last_modified").cast("date") >= F.lit(ds).cast("date")
    named = source.filter(recent & (dragen | citus)).withColumn("_name", part("key", "/", -1))
    plan = named.filter(fits & known_shape).select(
        F.col("bucket").alias("source_bucket"), F.col("key").alias("source_key"),
        F.when(dragen, buckets.dragen_qc).otherwise(buckets.citus_qc).alias("target_bucket"),
        target_key.alias("target_key"),
    )
    done = existing.select(F.col("bucket").alias("target_bucket"), F.col("key").alias("target_key"))
    return plan.join(done, ["target_bucket", "target_key"], "left_anti")


def incomplete_qc_folders(gold_qc: DataFrame, inventory: DataFrame, buckets: Buckets = Buckets()) -> DataFrame:
    """Folders of samples whose QC is incomplete, per pipeline."""
    name = F.lower("pipeline_name")
    dragen, citus = name.contains("dragen"), name.contains("citus")
    lacking = F.col("coverage").isNull() | F.col("at_least_10x").isNull() | F.col("ploidy_estimation").isNull()
    ids = (
        gold_qc.filter(F.col("run_name").isNotNull() & (dragen | (name == "citus")) & lacking)
        .select("id_repository", F.when(dragen, "dragen").when(citus, "citus").alias("pipeline"))
        .distinct()
    )
    place = F.when(F.col("bucket") == buckets.dragen_qc, "dragen").when(F.col("bucket") == buckets.citus_qc, "citus")
    folders = (
        inventory.filter(F.col("key").contains("/"))
        .select("bucket", place.alias("_pipeline"), part("key", "/", 1).alias("folder"))
        .filter("_pipeline IS NOT NULL")
        .distinct()
    )
    hits = prefix_join(ids, folders, "id_repository", "folder").filter(F.col("pipeline") == F.col("_pipeline"))
    return hits.select(
        "pipeline", F.concat(F.lit("s3://"), "bucket", F.lit("/"), "folder", F.lit("/")).alias("path")
    ).distinct()


def pgx_status(
    sheets: DataFrame,
    reports: DataFrame,
    versions: DataFrame,
    id_fixes: DataFrame,
    survey_aliases: DataFrame,
    key_template: str,
    buckets: Buckets = Buckets(),
) -> DataFrame:
    """Sample-sheet rows with ids from the path and both language reports.

    ``sheets``: file_name, sample_id, bam, hub_name, input_creation_date.
    ``reports``: inventory of the report bucket.  ``versions``: (key, version).
    ``key_template`` holds ``{sample_id}`` and ``{report_type}``.
    The version is read from the first language only.
    """
    out = sheets.withColumn("_ids", sample_and_run_from_path("bam", buckets)).select("*", "_ids.*").drop("_ids")
    head, tail = key_template.split("{sample_id}", 1)
    for lang in ("ind", "eng"):
        key = F.concat(
            F.lit(head.replace("{report_type}", lang)), "sample_id", F.lit(tail.replace("{report_type}", lang))
        )
        out = out.withColumn(f"_{lang}_key", key)
        out = left_on(out, reports.withColumn("found", F.col("key")), {f"_{lang}_key": "key"},
                      {"found": f"_{lang}_found", "last_modified": f"{lang}_report_creation_date"})
        out = out.withColumn(
            f"report_path_{lang}",
            F.concat(F.lit(f"s3://{buckets.pgx_output}/"), F.col(f"_{lang}_found")),
        )
    out = left_on(out, versions, {"_ind_key": "key"}, {"version": "pipeline_version"})
    out = override(out, id_fixes.select("id_repository", "new_repository").distinct(),
                   "id_repository", "id_repository", "new_repository")
    aliases = survey_aliases.select(
        F.col("new_origin_code_repository").alias("id_repository"), F.col("code_repository").alias("new_repository")
    ).distinct()
    out = override(out, aliases, "id_repository", "id_repository", "new_repository")
    return out.select(
        "file_name", "bam", "input_creation_date", "id_repository", "hub_name", "run_name",
        "report_path_ind", "ind_report_creation_date", "report_path_eng", "eng_report_creation_date",
        "pipeline_version",
    )
