"""Run order of the models.  Plain calls: each step writes its table, the next reads it."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, MutableMapping

from pyspark.sql import DataFrame, SparkSession

from strandmart.plans.gold import (
    end_to_end,
    lims_report,
    pgx_report,
    sample_qc,
    sheets_report,
    top_genes,
    transfer_report,
)
from strandmart.plans.staging import (
    biobank_samples,
    demography,
    fix_report,
    illumina_primary,
    illumina_secondary,
    mgi_secondary,
    ont_secondary,
    primary_sequencing,
    survey_alias,
    transfers,
)
from strandmart.plans.steps import Steps
from strandmart.settings import Settings
from strandmart.sources.tables import SwappedTable


class Warehouse(MutableMapping[str, DataFrame]):
    """Tables by name: given frames, and model outputs written under ``root``.

    A model output is read back from storage, so that plans stay short and a
    lost executor recomputes from files, not from the raw tables.
    """

    def __init__(self, spark: SparkSession, root: str, given: Mapping[str, DataFrame], version: str):
        self.spark, self.root, self.version = spark, root, version
        self._frames = dict(given)
        self.steps = Steps(spark, f"{root}/_steps/{version}")

    def _table(self, name: str) -> SwappedTable:
        return SwappedTable(self.spark, f"{self.root}/{name}")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            table = self._table(name)
            if not table.exists():
                raise KeyError(name)
            self._frames[name] = table.read()
        return self._frames[name]

    def __setitem__(self, name: str, df: DataFrame) -> None:
        table = self._table(name)
        table.write(df, self.version)
        self._frames[name] = table.read()
        # the model's output stands in files now; nothing reads its steps any more
        self.steps.drop()

    def __delitem__(self, name: str) -> None:
        del self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)


def _steps(settings: Settings):
    ts = settings.run_ts
    return [
        ("staging_fix_ski_id_repo", survey_alias.run),
        ("staging_illumina_primary", illumina_primary.run),
        ("staging_ont_sec", ont_secondary.run),
        ("staging_illumina_sec", illumina_secondary.run),
        ("staging_mgi_sec", mgi_secondary.run),
        ("staging_seq", primary_sequencing.run),
        ("staging_simbiox_transfer", transfers.run),
        ("staging_simbiox_biosamples_patients", biobank_samples.run),
        ("staging_report_fix_simbiox", lambda t: fix_report.run(t, ts)),
        # Reads the sample report of the previous run.
        ("staging_demography", lambda t: demography.run(t, settings)),
        ("gold_qc", lambda t: sample_qc.run(t, ts)),
        ("gold_simbiox_transfer", transfer_report.run),
        ("staging_simbiox_biosamples_latest_transfer", transfers.run_latest),
        ("gold_pgx_report", lambda t: pgx_report.run(t, ts)),
        ("gold_pgx_top_genes_demog_report", top_genes.run),
        ("gold_sheets_sequencing", sheets_report.run),
        ("gold_lims_report", lims_report.run),
        ("end_to_end", end_to_end.run),
    ]


def run_all(tables: MutableMapping[str, DataFrame], settings: Settings) -> None:
    """All models in dependency order."""
    for name, model in _steps(settings):
        tables[name] = model(tables)


