"""Session helpers: runtime SQL settings the jobs rely on, and the shared folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime settings only; sizes such as shuffle.partitions stay with the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Methods above this bytecode size are not JIT-compiled; wide rule projections run split instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A hot key is split even where the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rank filters keep at most n rows per key in each map task before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}

# Most data for one task, so that a task's memory does not grow with the table: rows of many equal or null columns take
# many times their shuffled bytes in a sort.  A cluster's smaller value stays.
SCAN, PIECE = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
TASK_BYTES = {SCAN: "32m", PIECE: "4m"}
# For queries whose tasks sort whole scans and shuffle partitions of all their input.
SORTED_SCAN = "8m"
DEALT = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Above this Spark keeps only the average size of a map task's pieces.
MOST_DEALT = 2000
# Up to so many pieces a task's rows go straight to files, beyond they are sorted in its memory, a whole row group of them.
STRAIGHT = "spark.shuffle.sort.bypassMergeThreshold"
# Bytes of a column's distinct values that a written file holds once, in place of 1 MB.
DICTIONARY, TEXTS = "parquet.dictionary.page.size", 64 << 20
# Least and greatest values; for a column of long texts they cost more time than all else of the writer.
STATISTICS = "parquet.column.statistics.enabled#"
# What ``fit_tasks`` and ``hold_texts`` found, until ``bound_tasks`` puts it back; empty: not set.
FOUND = "strandmart.found."


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def _bytes(spark: SparkSession, text: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def bound_tasks(spark: SparkSession) -> SparkSession:
    """Hold scans and coalesced shuffle partitions to ``TASK_BYTES``; what ``fit_tasks`` and ``hold_texts`` set for a query before ends."""
    for name, found in spark.conf.getAll.items():
        if name.startswith(FOUND):
            key = name.removeprefix(FOUND)
            spark.conf.set(key, found) if found else spark.conf.unset(key)
            spark.conf.unset(name)
    for key, value in TASK_BYTES.items():
        if _bytes(spark, spark.conf.get(key)) > _bytes(spark, value):
            spark.conf.set(key, value)
    return spark


def fit_tasks(spark: SparkSession, size: int) -> None:
    """Let the number of tasks follow an input of ``size`` bytes, for the query that runs next.

    AQE joins small shuffle partitions but leaves large ones, which are sorted whole: rows are dealt to as many as the input
    has pieces of the size AQE aims at, up to ``MOST_DEALT``, where the cluster's own number is smaller.  Pieces become up to four
    times as large before there are more than ``STRAIGHT`` allows.
    """
    dealt = spark.conf.get(DEALT, None)
    wanted, straight = -(-size // _bytes(spark, spark.conf.get(PIECE))), int(spark.conf.get(STRAIGHT, "200"))
    wanted = min(MOST_DEALT, wanted if wanted <= straight else max(straight, -(-wanted // 4)))
    new = {}
    if wanted > int(dealt or spark.conf.get("spark.sql.shuffle.partitions")):
        new[DEALT] = str(wanted)
    if _bytes(spark, spark.conf.get(SCAN)) > _bytes(spark, SORTED_SCAN):
        new[SCAN] = SORTED_SCAN
    for key, value in new.items():
        _for_now(spark, key, value)


def hold_texts(spark: SparkSession, column: str) -> None:
    """Let written files hold long texts that many rows share once, for the query that runs next: up to ``TEXTS`` bytes of the column."""
    if int(spark.conf.get(DICTIONARY, None) or 0) < TEXTS:
        _for_now(spark, DICTIONARY, str(TEXTS))
    _for_now(spark, STATISTICS + column, "false")


def _for_now(spark: SparkSession, key: str, value: str) -> None:
    if spark.conf.get(FOUND + key, None) is None:
        spark.conf.set(FOUND + key, spark.conf.get(key, None) or "")
    spark.conf.set(key, value)


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strandmart")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return bound_tasks(tune(spark))


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors share: ``spark.checkpoint.dir``; a new local one only on one machine."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="strandmart-")
    return shared
