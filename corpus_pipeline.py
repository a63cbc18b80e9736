"""A corpus pipeline: five operators in a row, each over all that the one before kept, written and read again in between.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmart.llm import bpe, decontaminate, quality, secret_scan, simhash
from strandmart.llm.queries import settled
from strandmart.llm.tables import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule refuses."""
    settled(spark)
    return quality.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    settled(spark)
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.  Rows are found by a number of their own, so null and repeated ids take no other row along."""
    settled(spark)
    rows = written(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "numbered")
    leaks = decontaminate.contaminated(rows.select("row", F.col("doc.text").alias("text")), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "row")
    hit = written(leaks.select("row").distinct(), "leaks")
    return rows.join(hit, "row", "left_anti").select("doc.*")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by their kinds; n_chars follows the text."""
    settled(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    clean = secret_scan.redacted_documents(docs, path, public_tokenizers.PATTERN)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(kind)))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with the digests of ids and decoded text."""
    settled(spark)
    return bpe.round_trip_digests(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scans),
    ("BPE encoding and decoding", bpe_encoding),
]

#: Fingerprints, latent retrieval and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-").lower())
    return docs
