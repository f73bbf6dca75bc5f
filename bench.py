"""Time the headline queries: one warm-up, then the median of three runs. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the data and the cores.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from feeloom.operators import attribution, checks, clients, reports, staging
from feeloom.plans.queries import QUERIES
from feeloom.plans.refresh import Warehouse, build_reports, build_staging
from feeloom.session import local_session
from feeloom.sinks import overwrite_table
from feeloom.sources.testdata import fee_ledger

RUNS = 3
# Each of these starts from the raw tables and recomputes the whole chain.
FROM_RAW = [
    "stg_fees", "dim_clients", "client_ltv", "client_ltv_single_pass", "cohort_ltv", "adviser_ltv", "top_advisers",
    "time_weighted", "check_summary",
]


def seconds(action, runs: int = RUNS, warm: bool = True) -> float:
    if warm:
        action()
    times = []
    for _ in range(runs):
        started = time.perf_counter()
        action()
        times.append(time.perf_counter() - started)
    return round(statistics.median(times), 3)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores)
    timings = {}
    for name in FROM_RAW:
        timings[name] = seconds(lambda name=name: consume(QUERIES[name](spark, sf_dir)))

    # The models over written tables, as the batch job runs them.
    store = Warehouse(tempfile.mkdtemp(prefix="feeloom-bench-"))
    overwrite_table(fee_ledger(spark, sf_dir, "raw"), store.path("fees"), ["fee_date"])
    timings["job_full_refresh"] = seconds(lambda: build_staging(spark, store, full_refresh=True), runs=1, warm=False)
    timings["job_incremental"] = seconds(lambda: build_staging(spark, store), warm=False)
    timings["job_reports"] = seconds(lambda: build_reports(spark, store), warm=False)
    fees, dimension = store.read(spark, "stg_fees"), store.read(spark, "dim_clients")
    ltv = store.read(spark, "rpt_client_ltv")
    over_tables = {
        "tables_dim_clients": lambda: consume(clients.client_dimension(fees)),
        "tables_client_ltv": lambda: consume(clients.client_ltv(fees, dimension)),
        "tables_cohort_ltv": lambda: consume(reports.cohort_ltv(dimension, ltv)),
        "tables_adviser_ltv": lambda: consume(reports.adviser_ltv(dimension, ltv)),
        "tables_time_weighted": lambda: consume(attribution.time_weighted_ltv(fees, ltv)),
        "tables_checks": lambda: consume(checks.run_checks(store.tables(spark, stg_fees=fees))),
        "tables_slice": lambda: consume(staging.stage_fees(store.read(spark, "fees"), store.newest_date(spark, "stg_fees"))),
    }
    for name, action in over_tables.items():
        timings[name] = seconds(action)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
