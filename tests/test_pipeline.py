"""All models in order on the derived warehouse."""

from datetime import datetime

from pyspark.sql import functions as F

from strandmart.checks.registry import Inputs
from strandmart.checks.warehouse import DerivedTables
from strandmart.plans import pipeline
from strandmart.plans.gold import sample_qc
from strandmart.settings import Settings
from tests.conftest import DATA

OUTPUTS = [name for name, _ in pipeline._steps(Settings())]


def test_all_models(spark, tmp_path):
    settings = Settings(run_ts=datetime(2025, 9, 9, 1, 30))
    derived = DerivedTables(Inputs(spark, DATA))
    previous = ("gold_qc", "staging_report_fix_simbiox")
    given = {n: derived[n] for n in derived if n not in OUTPUTS or n in previous}
    warehouse = pipeline.Warehouse(spark, str(tmp_path), given, "v1")
    pipeline.run_all(warehouse, settings)

    qc = warehouse["gold_qc"]
    samples = warehouse["staging_seq"]
    assert qc.count() > 0 and qc.select("id_repository").distinct().count() <= samples.select("id_repository").distinct().count()
    assert qc.filter(F.col("qc_strict_reason").isNull() | F.col("progress").isNull()).count() == 0
    assert warehouse["staging_mgi_sec"].groupBy("id_repository").count().filter("count > 1").count() == 0
    subjects = warehouse["staging_demography"]
    assert subjects.groupBy("id_subject", "hospital_name", "nomor_ec", "province_iso_code").count().filter("count > 1").count() == 0
    assert warehouse["gold_pgx_report"].count() >= qc.filter("qc_strict_status = 'Pass'").count()
    genes = warehouse["gold_pgx_top_genes_demog_report"]
    assert genes.select("gene_drug").distinct().count() in (0, 30)
    report = warehouse["staging_report_fix_simbiox"]
    assert report.filter(F.col("date_time") == "2025-09-09").count() == 1
    for name in OUTPUTS:
        assert warehouse[name].columns, name

    # The sample report of a second run differs only by what the demography changed.
    again = sample_qc.run(warehouse, settings.run_ts)
    assert again.count() == qc.count()
