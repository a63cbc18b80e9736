"""Deployment names and run parameters.

Bucket names and the label of the coordinating site belong to a deployment,
not to the computation, so they are arguments with neutral defaults.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone


@dataclass(frozen=True)
class Buckets:
    illumina: str = "data-illumina"
    citus: str = "data-citus-output"
    citus_liquid: str = "data-citus-output-liquid"
    dragen_liquid: str = "data-dragen-output-liquid"
    ont_input: str = "data-ont-input"
    ont_output: str = "data-ont-output"
    dragen_qc: str = "data-dragen-qc"
    citus_qc: str = "data-citus-qc"
    pgx_output: str = "data-pgx-output"


@dataclass(frozen=True)
class Settings:
    buckets: Buckets = field(default_factory=Buckets)
    central_site: str = "Central Hub"
    run_ts: datetime = field(
        default_factory=lambda: datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    )

    @property
    def ds(self) -> str:
        return self.run_ts.strftime("%Y-%m-%d")
