"""The sample report, with all quality labels."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmart.functions import qc_rules
from strandmart.functions.rules import is_control_sample
from strandmart.functions.text import blank_to_null
from strandmart.operators.aggregates import group_totals
from strandmart.operators.joins import left_on
from strandmart.operators.ranking import latest_by
from strandmart.operators.shape import union_padded
from strandmart.plans.steps import once

PLATFORMS = (("MGI", "staging_mgi_sec"), ("Illumina", "staging_illumina_sec"), ("ONT", "staging_ont_sec"))
SHARED = (
    "run_name pipeline_name cram cram_size vcf vcf_size at_least_10x at_least_20x median_coverage contamination "
    "percent_q30_bases yield yield_q30 ploidy_estimation id_batch date_start"
).split()
SECONDARY = {
    "id_repository": "string", "sequencer": "string", "run_name": "string", "pipeline_name": "string",
    "cram": "string", "cram_size": "bigint", "vcf": "string", "vcf_size": "bigint", "at_least_10x": "double",
    "at_least_20x": "double", "median_coverage": "double", "contamination": "double",
    "percent_q30_bases": "double", "yield": "double", "yield_q30": "double", "ploidy_estimation": "string",
    "id_batch": "string", "date_start": "timestamp",
}


def secondary(tables):
    """Newest analysis per sample and platform, all platforms in one table.

    Rows are dealt by sample before they are ranked, a platform at a time.  The group limit that would go before a shuffle sorts a scan's
    task, which is a whole row group: millions of wide rows spill, and a sample has few analyses, so the limit drops few.  Ids that have
    no place in the report, which may have very many analyses, leave first.
    """
    keys, parts = ["id_repository", "sequencer"], []
    for platform, name in PLATFORMS:
        have = [c for c in SHARED if c in tables[name].columns]
        rows = tables[name].select("id_repository", F.lit(platform).alias("sequencer"), *have).filter(~is_control_sample("id_repository"))
        parts.append(latest_by(union_padded([rows], SECONDARY).repartition("id_repository"), keys, ["date_start"]))
    return reduce(DataFrame.unionByName, parts)


def unified(tables):
    """Samples with biobank, registry and the analysis of their own platform."""
    samples = tables["staging_seq"].filter(F.col("sequencer").isNotNull() & ~is_control_sample("id_repository"))
    samples = samples.withColumnsRenamed({"id_index": "id_index_zlims", "id_library": "_library"})
    # The subject joins the narrow biobank rows, not the samples that carry them.
    biobank = left_on(
        tables["staging_simbiox_biosamples_patients"].select(
            "code_repository", "id_patient", "id_mpi", "id_subject", "biobank_nama", "registry_sex", "patient_categ"
        ),
        tables["staging_demography"], {"id_subject": "id_subject"}, ["is_excluded"],
    )
    samples = left_on(
        samples, biobank, {"id_repository": "code_repository"},
        {"id_patient": "id_patient", "id_mpi": "id_mpi", "id_subject": "id_subject",
         "biobank_nama": "origin_biobank", "registry_sex": "sex", "patient_categ": "patient_categ", "is_excluded": "is_excluded"},
    )
    # A sample has one platform, so one join replaces a join per platform.  Both sides lie by sample already; the platform, of which a
    # sample has a few, is not a key of the join, or both would be shuffled again.
    renamed = {"median_coverage": "coverage", "id_batch": "_batch", "date_start": "date_secondary"}
    newest = secondary(tables).withColumnsRenamed({"id_repository": "_id", "sequencer": "_platform", **renamed})
    same = (samples["id_repository"] == newest["_id"]) & F.array_contains(F.array("_platform"), F.col("sequencer"))
    out = samples.join(newest, same, "left").drop("_id", "_platform")
    library = F.coalesce(
        blank_to_null("_library"), F.when(F.col("sequencer") == "Illumina", F.col("_batch"))
    )
    batch = F.coalesce(F.when(F.col("sequencer") != "ONT", blank_to_null("_batch")), F.col("_library"))
    return out.withColumns(
        {
            "id_library": library,
            "id_batch": batch,
            "ploidy_estimation": F.upper("ploidy_estimation"),
            "sex_ploidy_category": qc_rules.pair_category("ploidy_estimation", "sex"),
        }
    ).drop("_library", "_batch")


COLUMNS = (
    "id_repository id_patient id_mpi id_subject is_excluded origin_biobank sex patient_categ date_primary sequencer "
    "id_index_zlims id_library id_batch sum_of_total_passed_bases sum_of_bam_size date_secondary run_name "
    "pipeline_name cram cram_size vcf vcf_size at_least_10x at_least_20x coverage contamination percent_q30_bases "
    "yield yield_q30 ploidy_estimation sex_ploidy_category batch_sex_category coverage_category coverage_class "
    "coverage_missing sex_missing ploidy_missing ont_yield_status qc_strict_status qc_strict_progress "
    "qc_strict_color qc_strict_reason qc_strict_diagnosis progress qc_coverage_tier"
).split()


def with_batch_check(df):
    """Batch verdict from whole-library counts; samples without a library are one batch."""
    counted = group_totals(
        df, ["id_library"],
        {
            "_mismatch": F.count_if(F.col("sex_ploidy_category") == qc_rules.MISMATCH),
            "_no_data": F.count_if(F.col("sex_ploidy_category") == qc_rules.NO_DATA),
        },
    )
    return counted.withColumn(
        "batch_sex_category", qc_rules.batch_category("_mismatch", "_no_data")
    ).drop("_mismatch", "_no_data")


def run(tables, run_ts):
    # The batch check reads the samples twice: for the counts of a library, and for the rows that get them.
    samples = once(tables, "qc_samples", unified(tables))
    labelled = qc_rules.add_qc_labels(with_batch_check(samples))
    return labelled.select(*COLUMNS, F.lit(run_ts).cast("timestamp").alias("updated_at"))

