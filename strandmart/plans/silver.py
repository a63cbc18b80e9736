"""Silver clean-ups: one declarative specification per source.

Missing values stay null inside the pipeline; ``as_text`` writes them as empty
text at a text sink.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmart.functions import rules
from strandmart.functions.dates import iso_text, parse_any, parse_day
from strandmart.functions.json_text import (
    is_json,
    list_to_json,
    repair_quotes,
    sum_ignoring_blanks,
    to_valid_json,
)
from strandmart.functions.text import capture_or_null, number_or_null, part
from strandmart.operators.aggregates import collect_parallel
from strandmart.operators.joins import left_on, map_latest
from strandmart.operators.ranking import latest_by, richest_by
from strandmart.settings import Buckets
from strandmart.sources.bronze import delta_window, flatten_records

AUDIT = ("created_at", "updated_at")


@dataclass(frozen=True)
class SilverSpec:
    """rename → derive (in order) → where → latest → select, after dropping equal rows."""

    rename: Mapping[str, str] = field(default_factory=dict)
    derive: Mapping[str, Column | Callable[[], Column]] = field(default_factory=dict)
    where: Callable[[], Column] | None = None
    latest: tuple[Sequence[str], Sequence[str]] | None = None
    select: Sequence[str] | None = None


def with_audit(df: DataFrame, run_ts: Column) -> DataFrame:
    """Audit columns where the source has none."""
    return df.withColumns({c: run_ts for c in AUDIT if c not in df.columns})


def silver(df: DataFrame, spec: SilverSpec, run_ts: Column) -> DataFrame:
    out = df.select(*[F.col(f"`{c}`").alias(spec.rename.get(c, c)) for c in df.columns])
    for name, column in spec.derive.items():
        out = out.withColumn(name, column() if callable(column) else column)
    if spec.where is not None:
        out = out.filter(spec.where())
    out = with_audit(out, run_ts)
    if spec.select is not None:
        out = out.select(*[f"`{c}`" for c in spec.select])
    if spec.latest is not None:
        # The newest row per key makes a separate distinct pointless; null keys are dropped.
        keys, order = spec.latest
        return latest_by(out.dropna(subset=list(keys)), keys, order)
    return out.distinct()


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, null as empty text."""
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])


def drop_first_column(df: DataFrame) -> DataFrame:
    return df.drop(df.columns[0])


def _pipe_part(index: int) -> Column:
    return F.trim(part("Sample", r"\|", index))


def _day(name: str) -> Callable[[], Column]:
    return lambda: parse_day(F.col(name), "dd-MM-yyyy")


# Source column -> table column, in table order.
QUALITY = {
    "SampleID": "id_repository", "Lane": "lane", "index": "index", "index2": "index2",
    "ReadNumber": "read_number", "Yield": "yield", "YieldQ30": "yield_q30",
    "QualityScoreSum": "quality_score_sum", "Mean Quality Score (PF)": "mean_quality_score_pf",
    "% Q30": "percent_q30",
}
DEMULTIPLEX = {
    "SampleID": "id_repository", "Lane": "lane", "Index": "index", "# Reads": "reads",
    "# Perfect Index Reads": "perfect_index_reads", "# One Mismatch Index Reads": "one_mismatch_index_reads",
    "# Two Mismatch Index Reads": "two_mismatch_index_reads", "% Reads": "percent_reads",
    "% Perfect Index Reads": "percent_perfect_index_reads",
    "% One Mismatch Index Reads": "percent_one_mismatch_index_reads",
    "% Two Mismatch Index Reads": "percent_two_mismatch_index_reads",
}
ILLUMINA_QC = {
    "dragen_mapping-Number_of_duplicate_marked_reads_pct": "percent_dups",
    "dragen_mapping-Q30_bases_pct": "percent_q30_bases",
    "dragen_mapping-Total_input_reads": "total_seqs",
    "dragen_mapping-Estimated_sample_contamination": "contam",
    "dragen_mapping-Secondary_alignments_pct": "non_primary",
    "dragen_mapping-Mapped_reads_pct": "percent_mapped",
    "dragen_mapping-Properly_paired_reads_pct": "percent_proper_pairs",
    "dragen_mapping-Total_alignments": "reads_mapped",
    "dragen_coverage-wgs_pct_of_genome_with_coverage_50x_inf": "at_least_50x",
    "dragen_coverage-wgs_pct_of_genome_with_coverage_20x_inf": "at_least_20x",
    "dragen_coverage-wgs_pct_of_genome_with_coverage_10x_inf": "at_least_10x",
    "dragen_coverage-wgs_median_autosomal_coverage_over_genome": "median_coverage",
    "dragen_variant_calling-Total": "vars",
    "dragen_variant_calling-SNPs_pct": "snp",
    "dragen_variant_calling-Indels_pct": "indel",
    "dragen_variant_calling-Ti_Tv_ratio": "ts_tv",
    "dragen_coverage-wgs_average_alignment_coverage_over_genome": "depth",
    "dragen_ploidy_estimation-Ploidy_estimation": "ploidy_estimation",
}
MGI_QC = {
    "fastqc_raw-percent_duplicates": "percent_dups",
    "fastqc_raw-percent_gc": "percent_gc",
    "fastqc_raw-total_sequences": "total_seqs",
    "samtools_flagstat_stats-non_primary_alignments": "non_primary",
    "samtools_flagstat_stats-reads_mapped_percent": "percent_mapped",
    "samtools_flagstat_stats-reads_properly_paired_percent": "percent_proper_pairs",
    "samtools_flagstat_stats-reads_mapped": "reads_mapped",
    "mosdepth-50_x_pc": "at_least_50x",
    "mosdepth-20_x_pc": "at_least_20x",
    "mosdepth-10_x_pc": "at_least_10x",
    "mosdepth-median_coverage": "median_coverage",
    "mosdepth-mean_coverage": "depth",
    "bcftools_stats-number_of_records": "vars",
    "bcftools_stats-number_of_SNPs": "snp",
    "bcftools_stats-number_of_indels": "indel",
    "bcftools_stats-tstv": "ts_tv",
    "peddy-predicted_sex_sex_check": "ploidy_estimation",
}
ZLIMS = {
    "Sample ID(*)": "id_repository", "Flowcell ID": "id_flowcell", "Library ID": "id_pool",
    "DNB ID(*)": "id_dnb", "Index(*)": "id_index", "Create Time": "date_create",
}
ONT_QC = {
    "id_repository": "id_repository", "run_name": "run_name", "Contaminated": "contaminated",
    "N50": "n50", "Yield": "yield", "Read number": "total_seqs", "Reads mapped (%)": "percent_mapped",
    "Median read quality": "median_read_quality", "Median read length": "median_read_length",
    "Chromosomal depth (mean)": "chromosomal_depth", "Total depth (mean)": "total_depth",
    "SNVs": "snv", "Indels": "indel", "Transition/Transversion rate": "ts_tv",
    "SV insertions": "sv_insertion", "SV deletions": "sv_deletion", "Other SVs": "sv_others",
    "Predicted sex chromosome karyotype": "ploidy_estimation",
}
ONT_FOLDS = (1, 10, 15, 20, 30)
GENOME_BASES = 3200000000
BIOSAMPLE = {
    "patient_id": "id_patient", "repository_code": "code_repository", "box_code": "code_box",
    "position_code": "code_position", "received_date": "date_received",
    "enter_date_in_biorepo": "date_enumerated", "sample_old_code": "origin_code_repository",
    "sample_box_old_code": "origin_code_box", "sample_type_id": "biosample_type",
    "specimen_type_id": "biosample_specimen", "vol_product": "biosample_volume",
    "status": "biosample_status",
}
BIOSAMPLE_COLUMNS = (
    "id id_patient code_repository code_box code_position date_received date_enumerated id_biobank "
    "origin_code_repository origin_code_box biosample_type biosample_specimen type_case sub_cell_specimen "
    "biosample_volume biosample_status created_at updated_at final_result_analytic tube_type "
    "degrees_celsius_storage research_id project_id last_save remove log_biospc_id kode_kedatangan "
    "kode_hub_penyimpan"
).split()
PARTICIPANT = {
    "id": "id_subject", "created_at": "creation_date", "updated_at": "updation_date", "gender": "sex",
    "nik": "encrypt_nik", "full_name": "encrypt_full_name", "dob": "encrypt_birth_date",
    "ihs_number": "encrypt_ihs_number",
}
PARTICIPANT_COLUMNS = (
    "id_subject encrypt_full_name encrypt_nik encrypt_birth_date sex source province_code province "
    "district_code district subdistrict_code subdistrict village_code village use_nik_ibu created_by "
    "updated_by hospital_name created_at updated_at creation_date updation_date encrypt_ihs_number"
).split()
SHARING_COLUMNS = (
    "id ethical_clearance_id ethical_clearance_title id_subject institution_owner_id institution_owner_name "
    "institution_share_ids gender dob province district hub_name use_nik_ibu access created_at updated_at"
).split()
PGX_LOG_COLUMNS = (
    "file_name bam input_creation_date id_repository hub_name run_name report_path_ind "
    "ind_report_creation_date report_path_eng eng_report_creation_date pipeline_version created_at updated_at"
).split()
FIX_SAMPLE_COLUMNS = (
    "id id_repository id_library sequencer id_requestor created_at updated_at time_requested fix_type "
    "new_repository new_library id_zlims_index new_index"
).split()
FIX_ANALYSIS_COLUMNS = (
    "id id_repository sequencer run_name id_requestor created_at updated_at time_requested fix_type "
    "new_repository cram new_cram vcf new_vcf cram_size new_cram_size vcf_size new_vcf_size"
).split()

AUDITED = list(AUDIT)
PLAIN = SilverSpec()

SPECS: dict[str, SilverSpec] = {
    # Common clean-up only.
    "plain": PLAIN,
    "bssh": SilverSpec(rename={"experiment_name": "id_library", "biosample_name": "id_repository"}),
    "illumina_quality": SilverSpec(rename=QUALITY, select=[*QUALITY.values(), *AUDIT, "id_library"]),
    "illumina_demultiplex": SilverSpec(rename=DEMULTIPLEX, select=[*DEMULTIPLEX.values(), "id_library", *AUDIT]),
    "illumina_qc": SilverSpec(
        rename=ILLUMINA_QC,
        derive={
            "id_repository": lambda: _pipe_part(-1),
            "run_name": lambda: rules.run_from_folder(_pipe_part(-3)),
        },
        select=["id_repository", *ILLUMINA_QC.values(), *AUDIT, "run_name"],
    ),
    "mgi_analysis": PLAIN,
    "ztron_analysis": SilverSpec(derive={"date_secondary": _day("date_secondary")}),
    "ztron_wide_analysis": SilverSpec(derive={"data_creation_date": _day("data_creation_date")}),
    "mgi_qc": SilverSpec(
        rename=MGI_QC,
        derive={"id_repository": lambda: _pipe_part(-1), "run_name": lambda: _pipe_part(-2)},
        where=lambda: ~F.col("id_repository").rlike(" R[12]$"),
        select=["id_repository", *MGI_QC.values(), *AUDIT, "run_name"],
    ),
    "zlims": SilverSpec(
        rename=ZLIMS,
        derive={"id_index": lambda: F.col("id_index").try_cast("double").try_cast("bigint")},
        where=lambda: ~F.coalesce(F.col("id_repository").rlike(rules.ZLIMS_TRIALS), F.lit(False)),
        select=[*ZLIMS.values(), *AUDIT],
    ),
    "ont_analysis": SilverSpec(
        derive={"date_start": lambda: parse_any("date_start")},
        latest=(["id_repository"], ["date_start"]),
    ),
    "ont_qc": SilverSpec(
        rename=ONT_QC,
        derive={
            f"at_least_{n}x": (
                lambda n=n: number_or_null(f"`Bases with >={n}-fold coverage`") / GENOME_BASES * 100
            )
            for n in ONT_FOLDS
        },
        select=[*ONT_QC.values(), *[f"at_least_{n}x" for n in ONT_FOLDS], *AUDIT],
    ),
    "pgx_log": SilverSpec(
        derive={
            c: (lambda c=c: parse_any(c))
            for c in ("input_creation_date", "ind_report_creation_date", "eng_report_creation_date")
        },
        select=PGX_LOG_COLUMNS,
    ),
    "registry_a_demography": SilverSpec(
        derive={
            "id_subject": lambda: F.col("ehr_id"),
            "sex": lambda: rules.recode("gender", rules.SEX_WORDS),
            "age": lambda: F.col("age").try_cast("bigint"),
            "creation_date": lambda: parse_any("creationDate"),
        },
        select=["id_subject", "age", "sex", *AUDIT, "creation_date", "ehr_id"],
        latest=(["id_subject"], ["creation_date"]),
    ),
    "data_sharing": SilverSpec(rename={"participant_id": "id_subject"}, select=SHARING_COLUMNS),
    "variables": PLAIN,
    "forms": PLAIN,
    "consents": PLAIN,
    "clearances": SilverSpec(rename={"created_at": "creation_date", "updated_at": "updation_date"}),
    "master_values": SilverSpec(derive={"answer": lambda: to_valid_json("answer")}),
    "biosamples": SilverSpec(rename=BIOSAMPLE, select=BIOSAMPLE_COLUMNS),
    "patients": SilverSpec(
        rename={"dateofbirth": "date_of_birth"},
        derive={"id_subject": lambda: F.col("nomor_mr"), "id_patient": lambda: F.col("id")},
        select=["id_patient", "id_mpi", "id_subject", "sex", "date_of_birth", "id_biobank", *AUDIT],
    ),
}


def clean_zlims(df: DataFrame, run_ts: Column) -> DataFrame:
    """Sample-sheet rows; the id loses its suffix only after the trial filter."""
    return silver(df, SPECS["zlims"], run_ts).withColumn("id_repository", rules.zlims_sample_id("id_repository"))


def pgx_log(df: DataFrame, run_ts: Column) -> DataFrame:
    return silver(df, SPECS["pgx_log"], run_ts).orderBy(
        F.desc_nulls_last("input_creation_date"), F.desc_nulls_last("ind_report_creation_date")
    )


def registry_b_demography(df: DataFrame, run_ts: Column, central_site: str) -> DataFrame:
    spec = SilverSpec(
        rename=PARTICIPANT,
        derive={
            "sex": lambda: rules.recode("sex", {"female": "FEMALE", "male": "MALE"}),
            "hospital_name": lambda: rules.hospital_from_email("created_by", central_site),
            "updation_date": lambda: parse_any("updation_date"),
        },
        select=PARTICIPANT_COLUMNS,
        latest=(["id_subject"], ["updation_date"]),
    )
    out = silver(df, spec, run_ts)
    return out.withColumn("updation_date", F.date_format("updation_date", "yyyy-MM-dd HH:mm:ss"))


def fix_records(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correction records: one per id, absent columns empty, fixed order."""
    padded = df.withColumns({c: F.lit("") for c in columns if c not in df.columns})
    return as_text(latest_by(padded.select(*columns), ["id"], ["time_requested"]))


def diseases(df: DataFrame, disease_ddl: str, hub_ddl: str) -> DataFrame:
    """Two nested objects side by side."""

    def obj(column, ddl):
        return F.from_json(repair_quotes(column), ddl)

    both = df.select(obj("diseases", disease_ddl).alias("d"), obj("hub", hub_ddl).alias("h"))
    return both.select("d.*", "h.*").distinct()


def documents_json(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Document columns as JSON text of the raw text."""
    wrapped = {c: F.to_json(F.array(F.col(c))) for c in columns}
    # Quoted and escaped by to_json inside a one-element array; the brackets come off.
    inner = {c: F.substring(w, F.lit(2), F.length(w) - 2) for c, w in wrapped.items()}
    return df.distinct().withColumns({c: F.when(F.col(c).isNotNull(), v) for c, v in inner.items()})


def registry_a_documents(df: DataFrame, run_ts: Column) -> DataFrame:
    """Four columns by position."""
    named = df.toDF("id_subject", "composition_id", "composition_name", "entry", *df.columns[4:])
    return documents_json(with_audit(named, run_ts), ["entry"])


# --- ONT samples ----------------------------------------------------------

ONT_LISTS = (
    "alias total_passed_bases bam_size date_upload total_bases passed_bases_percent bam_folder id_library "
    "started_at acquisition_stopped processing_stopped instrument position id_flowcell"
).split()
ONT_TIMES = ("date_upload", "started_at", "acquisition_stopped", "processing_stopped")


def ont_samples(df: DataFrame, library_fixes: DataFrame, id_fixes: DataFrame, run_ts: Column) -> DataFrame:
    """One row per sample with parallel JSON lists of its run folders.

    Corrections: (id_repository, id_library, new_library, time_requested) and
    (id_repository, new_repository, time_requested), ONT rows only.
    """
    folders = richest_by(df, ["bam_folder"])
    folders = map_latest(
        folders, library_fixes, ["id_repository", "id_library"], "id_library", "new_library", ["time_requested"]
    )
    folders = map_latest(
        folders, id_fixes, ["id_repository"], "id_repository", "new_repository", ["time_requested"]
    )
    folders = folders.withColumns({c: iso_text(parse_any(c)) for c in ONT_TIMES})
    folders = folders.withColumns({c: F.col(c).cast("string") for c in ONT_LISTS})
    lists = collect_parallel(
        folders.filter(F.col("id_repository").isNotNull()), ["id_repository"], ONT_LISTS, ["bam_folder"]
    )
    totals = {
        "sum_of_total_passed_bases": sum_ignoring_blanks("total_passed_bases").cast("string"),
        "sum_of_bam_size": sum_ignoring_blanks("bam_size").cast("string"),
        "id_batch": F.coalesce(F.try_element_at("id_library", F.lit(1)), F.lit("")),
    }
    out = lists.withColumns(totals).withColumns({c: list_to_json(c) for c in ONT_LISTS})
    return out.withColumns({c: run_ts for c in AUDIT})


# --- Illumina samples and analyses ---------------------------------------

TAGS = (
    "technicalTags array<string>, userTags array<string>, connectorTags array<string>, "
    "runInTags array<string>, runOutTags array<string>, referenceTags array<string>"
)


def _list_text(c: Column | str) -> Column:
    """Array as ``['a', 'b']``, the text form that the staging models search."""
    c = F.col(c) if isinstance(c, str) else c
    inner = F.array_join(F.transform(c, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", ")
    return F.concat(F.lit("["), inner, F.lit("]"))


def illumina_samples(df: DataFrame, sample_tags: DataFrame, ts, run_ts: Column) -> DataFrame:
    """Samples changed on the day, with tags; ``sample_tags``: (id, id_library, list columns)."""
    typed = df.distinct().withColumns({c: parse_any(c) for c in ("timeModified", "timeCreated")})
    recent = delta_window(typed, ts, "timeModified", "timeCreated")
    flat = flatten_records(recent, "application", "id string, name string", "application_")
    flat = flatten_records(flat, "tags", TAGS, "tags_")
    extra = [c for c in sample_tags.columns if c != "id"]
    flat = left_on(flat, sample_tags, {"id": "id"}, extra)
    out = with_audit(flat, run_ts).select(
        "id", "id_library", F.col("timeCreated").alias("time_created"), F.col("timeModified").alias("time_modified"),
        *AUDIT, F.col("ownerId").alias("owner_id"), F.col("tenantId").alias("tenant_id"),
        F.col("tenantName").alias("tenant_name"), F.col("name").alias("id_repository"), "status",
        _list_text("tags_technicalTags").alias("tag_technical_tags"),
        _list_text("tags_userTags").alias("tag_user_tags"),
        _list_text("tags_connectorTags").alias("tag_connetor_tags"),
        _list_text("tags_runInTags").alias("tag_run_in_tags"),
        "application_id", "application_name", *[c for c in extra if c != "id_library"],
    )
    return latest_by(out.dropna(subset=["id"]), ["id"], ["time_modified"])


def illumina_analyses(df: DataFrame, inventory: DataFrame, run_ts: Column, buckets: Buckets = Buckets()) -> DataFrame:
    """Analyses with sample id, batch, pipeline and file paths; sizes come from the inventory."""
    rows = flatten_records(df.distinct(), "tags", TAGS, "tags_")
    pipeline = F.coalesce(
        F.get_json_object("pipeline", "$.code"), F.get_json_object(repair_quotes("pipeline"), "$.code")
    )
    sample = rules.sample_from_run("reference")
    folder = F.concat(F.lit("pro/analysis/"), "reference", F.lit("/"), sample, F.lit("/"), sample)
    rows = rows.withColumns(
        {
            "id_repository": rules.sample_from_reference("userReference"),
            "id_batch": F.coalesce(F.regexp_substr(_list_text("tags_userTags"), F.lit(r"LP[\w-]+")), F.lit("")),
            "pipeline_name": pipeline,
            "pipeline_type": F.lit("secondary"),
            "_cram": F.concat(folder, F.lit(".cram")),
            "_vcf": F.concat(folder, F.lit(".hard-filtered.vcf.gz")),
        }
    )
    objects = inventory.filter(F.col("bucket") == buckets.illumina)
    for kind in ("cram", "vcf"):
        rows = left_on(rows, objects, {f"_{kind}": "key"}, {"size": f"{kind}_size"})
        rows = rows.withColumn(kind, F.concat(F.lit(f"s3://{buckets.illumina}/"), f"_{kind}"))
    out = with_audit(rows, run_ts).select(
        "id", parse_any("timeCreated").alias("time_created"), parse_any("timeModified").alias("time_modified"),
        *AUDIT, "id_repository", "id_batch", parse_any("startDate").alias("date_start"),
        parse_any("endDate").alias("date_end"), "pipeline_name", "pipeline_type",
        F.col("userReference").alias("run_name"), F.col("status").alias("run_status"),
        "cram", "cram_size", "vcf", "vcf_size",
        _list_text("tags_technicalTags").alias("tag_technical_tags"),
        _list_text("tags_userTags").alias("tag_user_tags"),
        _list_text("tags_referenceTags").alias("tag_reference_tags"),
    )
    return latest_by(out.dropna(subset=["id"]), ["id"], ["time_modified"])


# --- Questionnaire documents ---------------------------------------------

UUID = "[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}"
FORM_GROUP = r"^AAA\d+/[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}/([^|]+)\|(.+)"
# Answers of the registry form, kept only in the recruitment group.
REGISTRY_PATHS = (
    "Catatan", "Hub", "Institusi", "Judul Penelitian", "Nomor EC", "PIC (Nama Peneliti)", "Proyek",
    "Tanggal Kadaluarsa", "Tanggal Dibuat",
)
# Shortening of group names for table names.
GROUP_SHORT = (("(?i)formulir-", ""), ("(?i)spesifik-penyakit-", ""), ("--", "-"), ("examination", "exam"))


def form_group(document_type: Column | str) -> Column:
    head, tail = (capture_or_null(document_type, FORM_GROUP, i) for i in (1, 2))
    return F.concat(head, F.lit("_"), tail)


def group_table(group: Column | str) -> Column:
    name = F.lower(F.col(group) if isinstance(group, str) else group)
    for pattern, short in GROUP_SHORT:
        name = F.regexp_replace(name, pattern, short)
    return F.concat(F.lit("phenovar_docs_"), name)


#: Path of an answer text that cannot be read; its value is the text.
UNREAD = "_unread"


def _is_object(v: Column) -> Column:
    """A non-empty JSON object; other values are answers, and most hold no brace."""
    return v.contains("{") & F.ltrim(v).startswith("{") & v.rlike(r'^\s*\{\s*"')


def _entries(c: Column) -> Column:
    return F.map_entries(F.from_json(c, "map<string,string>"))


def _open(answers: Column) -> Column:
    """One level: objects become their entries, with dotted paths."""

    def inner(answer):
        below = F.transform(
            _entries(answer["value"]),
            lambda e: F.struct(F.concat(answer["key"], F.lit("."), e["key"]).alias("key"), e["value"].alias("value")),
        )
        return F.when(_is_object(answer["value"]), below).otherwise(F.array(answer))

    return F.flatten(F.transform(answers, inner))


def nesting(text: Column | str) -> Column:
    """How deep the braces of a JSON text go: a running count over the braces outside its strings, in one pass."""
    bare = F.regexp_replace(text, r"(?s)\\.", "")
    braces = F.regexp_replace(F.regexp_replace(bare, r'"[^"]*+"', ""), r"[^{}]+", "")

    def step(seen, brace):
        now = seen["now"] + F.when(brace == "{", 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(seen["most"], now).alias("most"))

    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    chars = F.when(F.length(braces) > 0, F.split(braces, "")).otherwise(F.array().cast("array<string>"))
    return F.aggregate(chars, start, step, lambda seen: seen["most"])


#: Up to so many braces, wherever they stand, it is cheaper to look for objects than to count.
FEW_BRACES = 8


def _leaves(answers: DataFrame) -> DataFrame:
    """(…, path, value) for every answer, nested objects as dotted paths.

    Levels are opened inside the row, as many as the braces outside strings are deep, and rows are made once at the end: time grows with the
    text's length times its depth, not with the number of its objects.  A text that is no object, or is nested deeper than the JSON parser
    goes (1,000 levels), comes out whole under the path ``UNREAD``.  Dots in names stay as they are, so two answers may
    have one path (``{"a.b": {"c": 1}, "a": {"b.c": 2}}`` gives two rows of ``a.b.c``).
    """
    base = [c for c in answers.columns if c != "_json"]

    def level(entries, _):
        nested = F.exists(entries, lambda e: _is_object(e["value"]))
        return F.when(nested, _open(entries)).otherwise(entries)

    braces = F.length("_json") - F.length(F.replace("_json", F.lit("{"), F.lit("")))
    entries, depth = _entries(F.col("_json")), F.when(braces <= FEW_BRACES, braces).otherwise(nesting("_json"))
    opened = F.when(depth > 1, F.aggregate(F.sequence(F.lit(2), depth), entries, level)).otherwise(entries)
    unread = F.array(F.struct(F.lit(UNREAD).alias("key"), F.col("_json").alias("value")))
    rows = answers.select(*base, F.explode(F.when(F.col("_json").isNotNull(), F.coalesce(opened, unread))).alias("e"))
    return rows.select(*base, F.col("e.key").alias("path"), F.col("e.value").alias("value"))


def flatten_documents(documents: DataFrame, variables: DataFrame) -> DataFrame:
    """Questionnaire answers in long form: (form_group, subject, biobank, version, created, path, value).

    Question ids in a path become variable names; how-to-fill texts are dropped;
    registry answers stay only in the recruitment group.  Answers stay rows: no
    column is made from data.
    """
    rows = documents.select("*", F.trim("question_answer").alias("_text"))
    # Some are stored twice: as JSON text of the text.
    inner = F.get_json_object(F.concat(F.lit('{"v":'), "_text", F.lit("}")), "$.v")
    rows = rows.withColumn("_text", F.when(F.col("_text").startswith('"'), inner).otherwise(F.col("_text")))
    answer = (
        F.when(F.col("_text").rlike(r"^\{\s*'"), repair_quotes("_text"))
        .when(is_json("_text"), F.col("_text"))
        .otherwise(repair_quotes("_text"))
    )
    rows = rows.select(
        form_group("document_type").alias("form_group"), F.col("participant_id").alias("id_subject"),
        F.col("institution_name").alias("biobank_nama"), "version", "created_at", answer.alias("_json"),
    ).filter("form_group IS NOT NULL")
    leaves = _leaves(rows).filter(~F.col("path").rlike(rf"form\.continue_values\.{UUID}"))
    leaves = leaves.withColumn("_uuid", F.regexp_substr("path", F.lit(UUID)))
    names = latest_by(variables.select("id", "name"), ["id"], [])
    leaves = left_on(leaves, names, {"_uuid": "id"}, {"name": "_name"})
    bare = F.regexp_replace("path", r"form\.[^.]+\.", "")
    named = F.when(
        F.length("_name") > 0, F.expr("replace(_bare, _uuid, trim(_name))")
    ).otherwise(F.col("_bare"))
    leaves = leaves.withColumn("_bare", bare).withColumn("path", named)
    recruitment = F.col("form_group").rlike("(?i)rekrutmen_registrasi")
    leaves = leaves.filter(recruitment | ~F.col("path").isin(*REGISTRY_PATHS))
    return leaves.select("form_group", "id_subject", "biobank_nama", "version", "created_at", "path", "value")


def write_documents(long: DataFrame, root: str) -> None:
    """One folder per form group."""
    named = long.withColumn("form_table", group_table("form_group")).drop("form_group")
    named.write.mode("overwrite").partitionBy("form_table").parquet(root)


# --- Restricted registry --------------------------------------------------

RESTRICTED_COLUMNS = (
    "id_subject full_name nik use_nik_ibu birth_date sex source province province_code district district_code "
    "creation_date updation_date created_at updated_at"
).split()


def decrypt_hex(c: Column | str, key: Column, iv: Column) -> Column:
    """AES-CBC hex text to text; null where it cannot be decrypted."""
    c = F.col(c) if isinstance(c, str) else c
    sealed = F.when(c.rlike("^([0-9a-fA-F]{32})+$"), F.concat(iv.cast("binary"), F.unhex(c)))
    return F.try_aes_decrypt(sealed, key.cast("binary"), F.lit("CBC"), F.lit("PKCS")).cast("string")


def restricted_participants(df: DataFrame, key: Column, iv: Column, run_ts: Column) -> DataFrame:
    """Whole-table rebuild with three decrypted columns, for the restricted output only."""
    open_columns = {c: decrypt_hex(c, key, iv) for c in ("nik", "full_name", "dob")}
    out = df.distinct().withColumns(open_columns).withColumnsRenamed(
        {"dob": "birth_date", "id": "id_subject", "gender": "sex"}
    )
    return out.withColumns({"creation_date": run_ts, "updation_date": run_ts}).select(*RESTRICTED_COLUMNS)


