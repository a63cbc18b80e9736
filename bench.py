"""Headline queries, timed end to end on the executors (results go to a no-op sink).

Prints one JSON line.  BENCH_SF_DIR and BENCH_CPUS choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from strandmart.checks import QUERIES
from strandmart.session import local_session

HEADLINE = (
    "latest_by best_by latest_by_kind dense_rank first_flag flag_window_sum pivot_latest flag_counts concat_distinct "
    "collect_parallel agg_before_join lookup_join platform_coalesce or_join pair_default union_padded unpivot upsert "
    "insert_ignore regex_clean json_path qc_rules normalise_rules html_extract explode_reports inventory_to_analysis "
    "silver_ont_samples silver_flatten_documents staging_illumina_primary staging_illumina_secondary "
    "staging_mgi_secondary staging_ont_secondary staging_primary_sequencing staging_biobank_samples staging_transfers "
    "staging_demography gold_sample_qc gold_pgx_report gold_top_genes gold_transfer_report gold_sheets_report "
    "gold_end_to_end"
).split()


def timed(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    timed(spark, folder, "global_count")
    seconds = {name: round(timed(spark, folder, name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
