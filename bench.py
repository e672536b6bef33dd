"""Headline timings as one JSON line.

BENCH_SF_DIR   input folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)

``ingest`` loads CSV landing files: cleaning, checks, staging, code resolution,
dimension and keyed fact upsert, all written; ``reload`` upserts the same files again; ``export_all`` writes all eleven CSV datasets from the loaded tables. The rest are
views and analyses from the order lines up, results drained or collected.
"""

from __future__ import annotations

import json
import os
import time

from ledgerwide.plans import exports, load
from ledgerwide.session import local_session, scratch_path
from ledgerwide.sources import derived
from verification.queries import QUERIES, Inputs

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

ANALYSES = [
    "T1_national_trend",
    "T2_sector_comparison",
    "T5_largest_by_income",
    "T7_pay_trend",
    "B1_size_bands",
    "B4_regional_health",
    "B8_ebitda_movers",
    "B9_sickness",
    "A7_sector_benchmarks",
    "C1_rows_by_scope",
    "C10_key_uniqueness",
    "D14_all_checks",
    "G3_margins",
    "G15_sector_benchmark",
]
WRITES = ["V2_profit_and_loss", "V5_balance_sheet", "V7_annual_scorecard", "E8_expenditure_detail"]


def drain(frame) -> None:
    """Compute every row and column without moving them to the driver."""
    frame.write.format("noop").mode("overwrite").save()


def export_all(spark, tables: load.Tables) -> None:
    stored = load.fact_table(spark, tables), load.trust_table(spark, tables)
    warehouse = exports.warehouse_of(spark, *stored)
    exports.write_exports(warehouse, scratch_path(spark, "bench-exports"))


def main() -> None:
    spark = local_session(
        CPUS,
        shuffle_partitions=int(CPUS),
        # Small local stages keep all cores busy; a cluster keeps the default size.
        **{"spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"},
    )
    files = derived.write_landing(spark, FOLDER, scratch_path(spark, "bench-landing"))
    tables = load.Tables(scratch_path(spark, "bench-warehouse"))
    jobs = {
        "ingest": lambda t: load.load(spark, tables, *files),
        "reload": lambda t: load.load(spark, tables, *files),
        "export_all": lambda t: export_all(spark, tables),
        **{name: (lambda t, n=name: drain(QUERIES[n](t))) for name in WRITES},
        **{name: (lambda t, n=name: QUERIES[n](t).collect()) for name in ANALYSES},
    }
    seconds: dict[str, float] = {}
    for name, job in jobs.items():
        started = time.perf_counter()
        job(Inputs(spark, FOLDER))
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
