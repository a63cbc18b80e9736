"""Steps of the large models: written once, few scans left, dropped when the output stands in files."""

import os
from datetime import datetime

import pytest

from strandmart.checks.registry import Inputs
from strandmart.checks.warehouse import DerivedTables
from strandmart.plans.gold import end_to_end, sample_qc, sheets_report, transfer_report
from strandmart.plans.pipeline import Warehouse
from strandmart.plans.staging import demography
from strandmart.plans.steps import Steps, once
from strandmart.settings import Settings
from tests.conftest import DATA

RUN = datetime(2025, 9, 9, 1, 30)
MODELS = {
    "demography": (lambda t: demography.run(t, Settings(run_ts=RUN)), 25, 50),
    "sample_qc": (lambda t: sample_qc.run(t, RUN), 6, 8),
    "transfer_report": (transfer_report.run, 12, 16),
    "sheets_report": (sheets_report.run, 8, 8),
    "end_to_end": (end_to_end.run, 8, 19),
}


def scans(df):
    """Scans of the initial physical plan."""
    return sum(line.lstrip(" :+-*()0123456789").startswith("FileScan") for line in df._jdf.queryExecution().executedPlan().toString().splitlines())


@pytest.mark.parametrize("name", MODELS)
def test_scans(spark, name):
    model, most, total = MODELS[name]
    tables = DerivedTables(Inputs(spark, DATA))
    out = model(tables)
    inside = {step: scans(df) for step, df in tables.steps.plans.items()}
    assert inside and 0 < scans(out) <= most, (scans(out), inside)
    assert scans(out) + sum(inside.values()) <= total, (scans(out), inside)


def test_steps_are_written_once_and_dropped(spark, tmp_path):
    steps = Steps(spark, str(tmp_path / "steps"))
    first = steps.once("a", spark.range(5))
    assert steps.once("a", spark.range(9)) is first and first.count() == 5
    steps.drop()
    assert not os.path.exists(tmp_path / "steps") and steps.once("a", spark.range(9)).count() == 9


def test_a_table_drops_the_steps_of_its_model(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), {}, "v1")
    step = once(warehouse, "a", spark.range(5))
    assert os.path.exists(tmp_path / "_steps" / "v1" / "a")
    warehouse["out"] = step
    assert warehouse["out"].count() == 5 and not os.path.exists(tmp_path / "_steps" / "v1")
    assert once({}, "a", spark.range(3)).count() == 3
