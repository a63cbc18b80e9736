"""The daily load of one source: raw files of a date → silver rows → upsert by specification → new table version."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession

from strandmart.plans.silver import SilverSpec, silver
from strandmart.plans.upserts import UpsertSpec, match_rules
from strandmart.sources.bronze import ROW_ORDER, read_bronze_multi, with_row_order
from strandmart.sources.tables import SwappedTable


def silver_batch(raw: DataFrame, spec: SilverSpec, run_ts: Column) -> DataFrame:
    """Silver rows that still know their place in the files."""
    if spec.select is not None:
        spec = replace(spec, select=[*spec.select, ROW_ORDER])
    return silver(with_row_order(raw), spec, run_ts)


def load(
    spark: SparkSession,
    landing: str,
    ds: str,
    columns: Sequence[str],
    spec: SilverSpec,
    target: SwappedTable,
    keys: UpsertSpec,
    run_ts: Column,
    version: str,
) -> bool:
    """Bring the files of one date into the current table; False where the date has no file.

    Of rows with one key the last one in the files counts, as if they had been sent one by one.  With an ``IndexedTable`` only the
    files that hold keys of the batch are written again.
    """
    raw = read_bronze_multi(spark, landing, ds, columns)
    if raw.isEmpty():
        return False
    batch = silver_batch(raw, spec, run_ts)
    keep, stamp = match_rules(keys, batch.columns, run_ts)
    target.upsert(batch, version, keys.keys, keep, (ROW_ORDER,), stamp)
    return True
