"""Registered queries of the subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmart.llm import (
    bpe, chat, decontaminate, filter_audit, hard_negatives, html_text, pii, pstable, quality, secret_scan, simhash, token_files, url_filter
)
from strandmart.llm.tables import new_folder, shipped
from strandmart.session import tune

#: Texts travel to Python in batches of this size at most, so a worker's memory has a bound.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m"}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def settled(spark: SparkSession) -> SparkSession:
    """The library's runtime settings, and those of the text operators."""
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    return tune(shipped(spark))


def query(name: str, sql: str | None = None):
    """Register a query under a name; the session gets the library's runtime settings first."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(settled(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


QUALITY_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS body,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM words WHERE len(words) >= 8),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS text FROM starts),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, text) > 1),
steps AS (SELECT doc_id, least(8, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i), 8)) AS n FROM again),
covered AS (SELECT doc_id, sum(n) AS n FROM steps GROUP BY doc_id),
counts AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(words, lambda x: x IN (STOPS))) AS stops,
         len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*•]'))) AS bullets,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS cuts
  FROM words LEFT JOIN covered USING (doc_id)),
base AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2.0 AND 15.0 AND n_symbols / n_words <= 0.5
       AND stops / n_words >= 0.02 AND n_dup_lines / greatest(n_lines, 1) <= 0.5
       AND bullets / greatest(n_lines, 1) <= 0.9 AND cuts / greatest(n_lines, 1) <= 0.5 AS kept
FROM base
""".replace("STOPS", ", ".join(f"'{w}', '{w.capitalize()}'" for w in quality.STOP_WORDS))


@query("op8_quality_rules", QUALITY_SQL)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of the quality rules for every document."""
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op1_bpe_round_trip")
def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each document's ids and of the text decoded from them."""
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op3_token_files")
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document's ids, read back from the files."""
    folder = new_folder(spark, "tokens")
    manifest = token_files.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return token_files.read_tokens(manifest, folder, token_files.crc32).withColumnRenamed("value", "ids_crc32")


@query("op4_simhash_near_duplicates")
def op4_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans of every document, and all spans."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = secret_scan.scanned(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    base = F.filter("spans", lambda s: s["kind"].isin(list(secret_scan.BASE_KINDS)))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in secret_scan.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query("op7_benchmark_decontamination")
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and the evidence."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_html_main_text")
def op6_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.main_text(table(spark, sf_dir, "pages"))


URL_RULES = tuple(
    url_filter.Rule(*r.split()) for r in ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")
)


@query("op9_url_filter")
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    return url_filter.judged(table(spark, sf_dir, "pages"), URL_RULES, text_cols=("html",)).select("page_id", "host", "path", "rule", "verdict")


CHAT_SQL = r"""
WITH extra AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM extra)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(14 + length(role) + length(text) + length(regexp_replace(role || text, '[^\\<>]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query("op10_chat_format", CHAT_SQL)
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted text."""
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], told.schema)
    made = chat.formatted(chat.numbered(told.unionByName(extra)))
    read = made.select(
        F.col("tree").alias("conv_id"), chat.read_back(F.col("text")).alias("turns"), chat.under_loss(F.col("text"), F.col("loss")).alias("loss"),
        F.length("text").cast("long").alias("formatted_chars"),
    )
    said_all = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said_all, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


@query("op2_pii_pseudonyms")
def op2_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms for its personal data, and how many of each kind it had."""
    made = pii.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), key="example key")

    def count(kind):
        return F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return made.select("doc_id", "text", *(count(kind) for kind in pii.KINDS))


GOOD_VECTORS = "label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

NEGATIVES_SQL = f"""
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE {GOOD_VECTORS}),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor's positives."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


VECTOR_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v,
         embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
  FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
  WHERE a.usable AND b.usable AND list_cosine_similarity(a.v, b.v) >= 0.95),
reached AS (SELECT vec_id, vec_id AS node FROM vectors UNION SELECT vec_id, b FROM reached JOIN links ON node = a),
lowest AS (SELECT vec_id, min(node) AS component_id FROM reached GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM lowest LEFT JOIN counts USING (vec_id)
"""


@query("op12_embedding_near_duplicates", VECTOR_SQL)
def op12_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector, and whether it is its component's first."""
    found = pstable.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


AUDIT_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS body, coalesce(lang, '') AS part,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ 	-]+'), lambda x: x <> '') AS words
  FROM documents),
masks AS (
  SELECT part, [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
                100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body), regexp_matches(body, '[#$%&*|]'),
                coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false)] AS fails,
         coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS good,
         coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1), false) AS bad
  FROM texts),
codes AS (SELECT part, fails, good, bad, count(*) AS n FROM masks GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS step FROM orders),
met AS (
  SELECT part, filter_order, step, n, good, bad, substr(filter_order, step, 1) AS filter, fails[instr('ABCDE', substr(filter_order, step, 1))] AS failed,
         len(list_filter(range(1, step), lambda k: fails[instr('ABCDE', substr(filter_order, CAST(k AS INTEGER), 1))])) > 0 AS gone,
         len(list_filter(fails, lambda x: x)) = 1 AS once
  FROM codes, steps),
counted AS (
  SELECT part, filter_order, step, filter, coalesce(sum(n) FILTER (NOT gone AND NOT failed), 0) AS kept, coalesce(sum(n) FILTER (failed AND NOT gone), 0) AS removed,
         coalesce(sum(n) FILTER (failed AND gone), 0) AS redundant, coalesce(sum(n) FILTER (failed AND once), 0) AS unique_fails,
         coalesce(sum(n) FILTER (failed AND NOT gone AND good), 0) AS good_lost, coalesce(sum(n) FILTER (failed AND NOT gone AND bad), 0) AS toxic_lost
  FROM met GROUP BY part, filter_order, step, filter)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM counted
"""


@query("op13_filter_audit", AUDIT_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each filter does at each step of every order, by language."""
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("filter")
