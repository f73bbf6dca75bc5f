"""Batch jobs: load the raw table, build the models in order, check them."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feeloom.operators.checks import enforce, non_empty, run_checks
from feeloom.operators.clients import client_dimension, client_ltv
from feeloom.operators.reports import adviser_ltv_from_values, client_values, cohort_ltv_from_values
from feeloom.operators.staging import LOOKBACK_DAYS, stage_fees
from feeloom.schemas import (
    CLIENT_SCHEMA,
    FEE_SCHEMA,
    LTV_WINDOWS,
    STAGED_SCHEMA,
    adviser_ltv_schema,
    client_ltv_schema,
    cohort_ltv_schema,
)
from feeloom.sinks import versions
from feeloom.sinks.tables import overwrite_table, publish, table_report, upsert_by_partition
from feeloom.sources.csv_files import read_fees_csv, require_not_null
from feeloom.sources.files import hadoop_path
from feeloom.sources.tables import newest_partition, read_table, table_exists, table_path


REPORTS = ["dim_clients", "rpt_client_ltv", "rpt_cohort_ltv", "rpt_adviser_ltv"]


@dataclass(frozen=True)
class Warehouse:
    """Where the layered tables live, and the parameters the models share.

    ``versioned``: tables are published by version (see ``sinks.versions``) and shown by name in the catalog, so readers
    never see half a table on any store; otherwise each is a plain folder, replaced by a rename. ``drafts``: versions that
    are written but not published yet, by model; while it is set, nothing is published.
    """

    root: str
    windows: Sequence[int] = LTV_WINDOWS
    lookback_days: int = LOOKBACK_DAYS
    cluster_by: Sequence[str] = ()
    versioned: bool = False
    drafts: dict[str, versions.Snapshot] | None = None

    LAYERS = {"fees": "raw", "stg_fees": "staging", **dict.fromkeys(REPORTS, "reporting")}

    def path(self, model: str) -> str:
        return table_path(self.root, model, self.LAYERS.get(model))

    def read(self, spark: SparkSession, model: str) -> DataFrame:
        schemas = {
            "fees": FEE_SCHEMA,
            "stg_fees": STAGED_SCHEMA,
            "dim_clients": CLIENT_SCHEMA,
            "rpt_client_ltv": client_ltv_schema(self.windows),
            "rpt_cohort_ltv": cohort_ltv_schema(self.windows),
            "rpt_adviser_ltv": adviser_ltv_schema(self.windows),
        }
        if self.versioned:
            draft = (self.drafts or {}).get(model)
            schema = schemas[model].fieldNames()
            return versions.read_snapshot(spark, self.path(model), draft).select(*schema)
        return read_table(spark, self.path(model), schemas.get(model))

    def name(self, model: str) -> str:
        return f"{self.LAYERS[model]}.{model}"

    def exists(self, spark: SparkSession, model: str) -> bool:
        if self.versioned:
            return bool(versions.snapshot_numbers(spark, self.path(model)))
        return table_exists(spark, self.path(model))

    def write(
        self, df: DataFrame, model: str, partition_by: str | None = None, accept: Callable[[DataFrame], None] | None = None, laid_out: bool = False
    ) -> None:
        """Replace a table by ``df``; the old rows stay if the job or ``accept`` fails. ``laid_out``: see ``stage_fees``."""
        spark, cluster_by = df.sparkSession, self.cluster_by if partition_by else ()
        if not self.versioned:
            overwrite_table(df, self.path(model), [partition_by] if partition_by else [], cluster_by, accept, laid_out)
        elif self.drafts is not None:
            self.drafts[model] = versions.write_version(df, self.path(model), partition_by, cluster_by, accept, laid_out)
        else:
            create_database(spark, self, self.LAYERS[model])
            versions.replace_table(df, self.path(model), partition_by, cluster_by, accept, self.name(model), laid_out)

    def upsert(self, spark: SparkSession, model: str, incoming: DataFrame) -> None:
        if self.versioned:
            create_database(spark, self, self.LAYERS[model])
            versions.upsert_table(spark, self.path(model), incoming, cluster_by=self.cluster_by, name=self.name(model))
        else:
            upsert_by_partition(spark, self.path(model), incoming, cluster_by=self.cluster_by)

    def newest_date(self, spark: SparkSession, model: str) -> dt.date | None:
        """The newest date of a table partitioned by fee_date, from names of folders; None if it is empty."""
        if not self.versioned:
            return newest_partition(spark, self.path(model))
        current = versions.snapshot(spark, self.path(model))
        dates = [p.split("=", 1)[1] for p in current.folders] if current else []
        return max((dt.date.fromisoformat(d) for d in dates if d[0].isdigit()), default=None)

    def tables(self, spark: SparkSession, **known: DataFrame) -> dict[str, DataFrame]:
        """Every table, keyed as run_checks() expects; ``known`` are frames already read (and listed)."""
        models = {"raw_fees" if m == "fees" else m: m for m in self.LAYERS}
        return {name: known[name] if name in known else self.read(spark, m) for name, m in models.items()}


def create_database(spark: SparkSession, store: Warehouse, layer: str) -> None:
    # Beside the tables, not around them: dropping a database deletes its folder.
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{store.root.rstrip('/')}/_databases/{layer}'")


def register_tables(spark: SparkSession, store: Warehouse) -> list[str]:
    """Make the written tables queryable by name (raw.fees, reporting.rpt_adviser_ltv, ...); returns the names.

    The tables stay where they are; call again after a run that added dates.
    """
    names = []
    for model, layer in store.LAYERS.items():
        path, name = store.path(model), store.name(model)
        if not store.exists(spark, model):
            continue
        create_database(spark, store, layer)
        names.append(name)
        if store.versioned:
            versions.show_by_name(spark, name, path, versions.snapshot(spark, path))
            continue
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW":
            spark.sql(f"DROP VIEW {name}")
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: its files stay
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
        if layer != "reporting":
            spark.sql(f"MSCK REPAIR TABLE {name}")
    return names


def ingest_fees(spark: SparkSession, glob: str, store: Warehouse) -> DataFrame:
    """Replace the raw table by the CSV files; returns the load report (table, rows, bytes, files).

    One pass over the files. A bad record, a NULL or an empty load fails and leaves the old table in place.
    """
    fees = require_not_null(read_fees_csv(spark, glob))
    counted = []
    store.write(fees, "fees", "fee_date", accept=lambda loaded: counted.append(non_empty(loaded, "raw.fees")))
    return table_report(spark, store.path("fees"), "raw.fees", counted[0])


def build_staging(
    spark: SparkSession, store: Warehouse, full_refresh: bool = False, raw: DataFrame | None = None
) -> None:
    """First run or full refresh: rebuild staging. Otherwise upsert the rows since the lookback bound."""
    raw = store.read(spark, "fees") if raw is None else raw
    if full_refresh or not store.exists(spark, "stg_fees"):
        store.write(stage_fees(raw, lay_out_by="fee_date"), "stg_fees", "fee_date", laid_out=True)
        return
    bound = store.newest_date(spark, "stg_fees")
    store.upsert(spark, "stg_fees", stage_fees(raw, bound, store.lookback_days))


def backfill_staging(spark: SparkSession, store: Warehouse, start: dt.date, end: dt.date) -> None:
    """Upsert the raw rows dated ``start`` to ``end`` (inclusive), whatever the lookback."""
    chosen = store.read(spark, "fees").where(F.col("fee_date").between(start, end))
    store.upsert(spark, "stg_fees", stage_fees(chosen))


def build_reports(spark: SparkSession, store: Warehouse, fees: DataFrame | None = None) -> None:
    """Rebuild the reporting tables from staging. Each table is written and read back, as its readers see it."""
    fees = store.read(spark, "stg_fees") if fees is None else fees
    store.write(client_dimension(fees), "dim_clients")
    clients = store.read(spark, "dim_clients")
    store.write(client_ltv(fees, clients, store.windows), "rpt_client_ltv")
    # Both reports read the same client-level join.
    values = client_values(clients, store.read(spark, "rpt_client_ltv"), store.windows)
    values = values.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        store.write(cohort_ltv_from_values(values, store.windows), "rpt_cohort_ltv")
        store.write(adviser_ltv_from_values(values, store.windows), "rpt_adviser_ltv")
    finally:
        values.unpersist()


def release(spark: SparkSession, store: Warehouse, model: str) -> None:
    """Publish the draft of a model: nothing is moved, its manifest and its name are set."""
    create_database(spark, store, store.LAYERS[model])
    path, draft = store.path(model), store.drafts[model]
    before = versions.snapshot(spark, path)
    versions.publish_snapshot(spark, path, draft, before.number if before else 0, store.name(model))
    del store.drafts[model]


def run_refresh(
    spark: SparkSession,
    store: Warehouse,
    glob: str | None = None,
    skip_ingest: bool = False,
    skip_tests: bool = False,
    full_refresh: bool = False,
    gate: bool = False,
) -> DataFrame | None:
    """Ingest, build every model, then check; returns the check results (None if skipped).

    Checks run on the published tables; a failure raises ChecksFailed and leaves them published. With ``gate``
    the reporting tables are built aside and replace the published ones only if the checks pass (raw and
    staging are updated either way).
    """
    if not skip_ingest:
        if glob is None:
            raise ValueError("a file glob is needed unless skip_ingest is set")
        ingest_fees(spark, glob, store)
    raw = store.read(spark, "fees")
    build_staging(spark, store, full_refresh, raw)
    fees = store.read(spark, "stg_fees")
    if not gate:
        target = store
    elif store.versioned:
        target = replace(store, drafts={})
    else:
        target = replace(store, root=f"{store.root}/candidate_{uuid.uuid4().hex[:12]}")
    try:
        build_reports(spark, target, fees)
        results = None
        if not skip_tests:
            results = enforce(run_checks(target.tables(spark, raw_fees=raw, stg_fees=fees), store.windows))
        if gate:
            for model in REPORTS:
                release(spark, target, model) if store.versioned else publish(spark, target.path(model), store.path(model))
        return results
    finally:
        if gate and store.versioned:
            for model, draft in target.drafts.items():
                versions.discard(spark, target.path(model), draft)
        elif gate:
            fs, aside = hadoop_path(spark, target.root)
            fs.delete(aside, True)
