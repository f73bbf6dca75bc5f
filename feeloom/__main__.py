"""Run the batch job: spark-submit feeloom/__main__.py ROOT [GLOB] [--full-refresh] ... (or python -m feeloom)."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

if not __package__:  # started by path
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feeloom.operators.checks import ChecksFailed
from feeloom.operators.reports import top_advisers
from feeloom.plans.refresh import Warehouse, register_tables, run_refresh
from feeloom.session import cluster_conf
from feeloom.sources.files import glob_size, size_on_disk
from feeloom.sources.tables import table_exists


def size_shuffles(spark: SparkSession, store: Warehouse, glob: str | None) -> None:
    """Settings of the session from the bytes that the run reads and the cores it has, before its first shuffle."""
    raw = store.path("fees")
    size = glob_size(spark, glob) if glob else size_on_disk(spark, raw)[0] if table_exists(spark, raw) else 0
    for key, value in cluster_conf(size, spark.sparkContext.defaultParallelism).items():
        spark.conf.set(key, value)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="feeloom", description="Load fee files, build the models, check them.")
    parser.add_argument("root", help="folder of the layered tables")
    parser.add_argument("glob", nargs="?", help="CSV files to load; not needed with --skip-ingest")
    parser.add_argument("--skip-ingest", action="store_true")
    parser.add_argument("--skip-tests", action="store_true")
    parser.add_argument("--full-refresh", action="store_true", help="rebuild staging instead of upserting")
    parser.add_argument("--gate", action="store_true", help="publish the reports only if the checks pass")
    parser.add_argument("--versioned", action="store_true", help="publish tables by version, without renames")
    parser.add_argument("--windows", default="1,3,6", help="months, comma separated")
    options = parser.parse_args(argv)
    if not options.skip_ingest and options.glob is None:
        parser.error("a file glob is needed unless --skip-ingest is given")

    spark = SparkSession.builder.appName("feeloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    store = Warehouse(options.root.rstrip("/"), tuple(int(n) for n in options.windows.split(",")), versioned=options.versioned)
    size_shuffles(spark, store, None if options.skip_ingest else options.glob)
    try:
        results = run_refresh(
            spark, store, options.glob, options.skip_ingest, options.skip_tests, options.full_refresh, options.gate
        )
    except ChecksFailed as failure:
        print(f"checks failed: {failure}", file=sys.stderr)
        return 1
    if results is not None:
        print(f"{results.count()} checks passed")
    print("tables: " + ", ".join(register_tables(spark, store)))
    top_advisers(store.read(spark, "rpt_adviser_ltv"), windows=store.windows).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
