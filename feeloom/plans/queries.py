"""Named queries over the test tables. Each takes (spark, sf_dir), reads the whole tables and returns a DataFrame."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from feeloom.functions.money import to_units, units_to_double
from feeloom.operators import attribution, checks, clients, monitoring, privacy, reports, staging
from feeloom.plans.refresh import Warehouse, backfill_staging, build_reports, build_staging, ingest_fees, run_refresh
from feeloom.schemas import FEE_SCHEMA, STAGED_SCHEMA
from feeloom.session import scratch_dir
from feeloom.sinks.by_client import write_by_client
from feeloom.sinks.tables import overwrite_table, upsert_by_partition, write_by_outcome
from feeloom.sinks.versions import read_snapshot, restore_snapshot, snapshot
from feeloom.sources.csv_files import file_freshness, header_contract, quarantine_fees_csv, read_fees_csv_traced, sort_out_fees_csv
from feeloom.sources.tables import high_water_mark, read_table
from feeloom.sources.testdata import event_ledger, fee_ledger, fee_lines, fees_sent
from feeloom.streaming.arrivals import stage_arrivals

# The first load of the incremental queries ends here; everything later arrives afterwards.
FIRST_LOAD_END = dt.date(1999, 6, 30)
BACKFILL = (dt.date(1996, 2, 1), dt.date(1996, 4, 30))
AS_OF = dt.date(2001, 8, 10)
LINES_PER_FILE = 250_000


def _staged(spark: SparkSession, sf_dir: str, variant: str = "raw") -> DataFrame:
    return staging.stage_fees(fee_ledger(spark, sf_dir, variant))


def _client_tables(fees: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dimension and lifetime values in one plan. Without a written dimension to read back, the single-pass form
    saves computing the dimension twice.
    """
    return clients.client_dimension(fees), clients.client_ltv_single_pass(fees)


def _build(spark: SparkSession, ledger: DataFrame) -> dict[str, DataFrame]:
    """Every table of one build, each written and read back, as the batch job does: nothing is computed twice."""
    store = Warehouse(scratch_dir(spark, "build"))
    overwrite_table(ledger, store.path("fees"))
    overwrite_table(staging.stage_fees(store.read(spark, "fees")), store.path("stg_fees"))
    build_reports(spark, store)
    return store.tables(spark)


# Models


def stg_fees(spark, sf_dir):
    return _staged(spark, sf_dir)


def stg_fees_by_key(spark, sf_dir):
    return staging.stage_fees(fee_ledger(spark, sf_dir, "faulty"), dedup_on="key")


def stg_incremental_slice(spark, sf_dir):
    raw = fee_ledger(spark, sf_dir, "raw")
    return staging.stage_fees(raw, high_water_mark(raw))


def dim_clients(spark, sf_dir):
    return clients.client_dimension(_staged(spark, sf_dir))


def client_ltv(spark, sf_dir):
    fees = _staged(spark, sf_dir)
    return clients.client_ltv(fees, clients.client_dimension(fees))


def client_ltv_single_pass(spark, sf_dir):
    return clients.client_ltv_single_pass(_staged(spark, sf_dir))


def client_ltv_by_layout(spark, sf_dir):
    """Lifetime values over staging laid out by client: the even part is bucketed and read without an exchange."""
    root = scratch_dir(spark, "by-client")
    name = "fees_" + root.rsplit("-", 1)[1]
    layout = write_by_client(_staged(spark, sf_dir), name, root, buckets=16, sort_by=("fee_date",), rows_per_task=1000)
    parts = (layout.even(spark), layout.heavy(spark))
    return reduce(DataFrame.unionAll, [clients.client_ltv(fees, clients.client_dimension(fees)) for fees in parts])


def client_ltv_yearly(spark, sf_dir):
    fees = _staged(spark, sf_dir)
    return clients.client_ltv(fees, clients.client_dimension(fees), windows=(12, 24))


def client_ltv_events(spark, sf_dir):
    return _client_tables(staging.stage_fees(event_ledger(spark, sf_dir)))[1]


def cohort_ltv(spark, sf_dir):
    return reports.cohort_ltv(*_client_tables(_staged(spark, sf_dir))).orderBy("cohort_month")


def adviser_ltv(spark, sf_dir):
    return reports.adviser_ltv(*_client_tables(_staged(spark, sf_dir))).orderBy("rank_by_ltv_6_month")


def top_advisers(spark, sf_dir):
    return reports.top_advisers(reports.adviser_ltv(*_client_tables(_staged(spark, sf_dir))))


# Loads and writes


def _earlier_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as first loaded: rows up to FIRST_LOAD_END, with national insurance numbers since replaced."""
    ledger = fee_ledger(spark, sf_dir, "raw").where(F.col("fee_date") <= F.lit(FIRST_LOAD_END))
    return ledger.withColumn("client_nino", F.concat(F.lit("OLD"), F.col("client_nino")))


def stg_upsert(spark, sf_dir):
    store = Warehouse(scratch_dir(spark, "upsert"))
    overwrite_table(staging.stage_fees(_earlier_ledger(spark, sf_dir), lay_out_by="fee_date"), store.path("stg_fees"), ["fee_date"], laid_out=True)
    overwrite_table(fee_ledger(spark, sf_dir, "raw").dropna(subset=["fee_date"]), store.path("fees"), ["fee_date"])
    build_staging(spark, store)
    return store.read(spark, "stg_fees")


def published_versions(spark, sf_dir):
    """Staging published three times: the first load, the upsert of later rows, the first load restored.

    Each is read by name; ``held`` was resolved before the upsert was published, and runs after it.
    """
    store = Warehouse(scratch_dir(spark, "versions"), versioned=True)
    store.write(staging.stage_fees(_earlier_ledger(spark, sf_dir), lay_out_by="fee_date"), "stg_fees", "fee_date", laid_out=True)
    held = spark.table(store.name("stg_fees"))
    store.write(fee_ledger(spark, sf_dir, "raw").dropna(subset=["fee_date"]), "fees", "fee_date")
    build_staging(spark, store)
    upserted = spark.table(store.name("stg_fees"))
    restore_snapshot(spark, store.path("stg_fees"), 1, store.name("stg_fees"))
    restored = spark.table(store.name("stg_fees"))
    readings = {"held": held, "upserted": upserted, "restored": restored}
    return reduce(DataFrame.unionAll, [
        df.agg(
            F.lit(reading).alias("reading"), F.count("*").alias("rows"), F.min("fee_date").alias("first_date"), F.max("fee_date").alias("last_date"),
            F.count_if(F.col("client_nino").startswith("OLD")).alias("old_numbers"), units_to_double(F.sum(to_units(F.col("fee_amount")))).alias("total_fees"),
        )
        for reading, df in readings.items()
    ])


def refresh_run_versioned(spark, sf_dir):
    root = scratch_dir(spark, "refresh-versioned")
    _drop_csv(fee_ledger(spark, sf_dir), f"{root}/files")
    return run_refresh(spark, Warehouse(root, versioned=True), f"{root}/files/*.csv", full_refresh=True, gate=True)


def stg_append_columns(spark, sf_dir):
    path = scratch_dir(spark, "append")
    overwrite_table(staging.stage_fees(_earlier_ledger(spark, sf_dir), lay_out_by="fee_date"), path, ["fee_date"], laid_out=True)
    later = fee_ledger(spark, sf_dir, "raw").withColumn("currency", F.lit("GBP"))
    bound = high_water_mark(read_table(spark, path, STAGED_SCHEMA))
    upsert_by_partition(spark, path, staging.stage_fees(later, bound, extra_columns=["currency"]))
    return read_table(spark, path, merge_schema=True)


def stg_clustered(spark, sf_dir):
    path = scratch_dir(spark, "clustered")
    overwrite_table(_staged(spark, sf_dir), path, ["fee_date"], ["client_id"])
    return read_table(spark, path, STAGED_SCHEMA)


def backfill_range(spark, sf_dir):
    store = Warehouse(scratch_dir(spark, "backfill"))
    overwrite_table(staging.stage_fees(_earlier_ledger(spark, sf_dir), lay_out_by="fee_date"), store.path("stg_fees"), ["fee_date"], laid_out=True)
    overwrite_table(fee_ledger(spark, sf_dir, "raw").dropna(subset=["fee_date"]), store.path("fees"), ["fee_date"])
    backfill_staging(spark, store, *BACKFILL)
    return store.read(spark, "stg_fees")


def _drop_csv(ledger: DataFrame, folder: str) -> None:
    ledger.write.mode("append").csv(folder, header=True)


def ingest_summary(spark, sf_dir):
    root = scratch_dir(spark, "ingest")
    _drop_csv(fee_ledger(spark, sf_dir), f"{root}/files")
    store = Warehouse(root)
    report = ingest_fees(spark, f"{root}/files/*.csv", store)
    loaded = store.read(spark, "fees").agg(
        F.min("fee_date").alias("first_date"),
        F.max("fee_date").alias("last_date"),
        units_to_double(F.sum(to_units(F.col("fee_amount")))).alias("total_fees"),
    )
    return loaded.withColumn("rows", report.select("rows").scalar())


def quarantine_summary(spark, sf_dir):
    folder = f"{scratch_dir(spark, 'quarantine')}/files"
    _drop_csv(fee_ledger(spark, sf_dir, "raw"), folder)
    accepted, rejected = quarantine_fees_csv(spark, f"{folder}/*.csv")
    good = accepted.agg(F.lit("accepted").alias("outcome"), F.count("*").alias("rows"))
    bad = rejected.groupBy(F.col("reason").alias("outcome")).agg(F.count("*").alias("rows"))
    return good.unionAll(bad)


def stream_arrivals(spark, sf_dir):
    root = scratch_dir(spark, "arrivals")
    ledger = fee_ledger(spark, sf_dir)
    early = F.col("fee_date") <= F.lit(FIRST_LOAD_END)
    resent = F.col("fee_date") >= F.date_sub(F.lit(FIRST_LOAD_END), 30)
    for drop in (ledger.where(early), ledger.where(resent)):
        _drop_csv(drop, f"{root}/files")
        stage_arrivals(spark, f"{root}/files", f"{root}/staged", f"{root}/checkpoint").awaitTermination()
    return read_table(spark, f"{root}/staged", STAGED_SCHEMA)


def refresh_run(spark, sf_dir):
    root = scratch_dir(spark, "refresh")
    _drop_csv(fee_ledger(spark, sf_dir), f"{root}/files")
    return run_refresh(spark, Warehouse(root), f"{root}/files/*.csv", full_refresh=True)


# Checks


def check_unique_fee_id(spark, sf_dir):
    return checks.unique(_staged(spark, sf_dir, "faulty"), "fee_id")


def check_not_null_summary(spark, sf_dir):
    return checks.null_counts(fee_ledger(spark, sf_dir, "raw"), FEE_SCHEMA.fieldNames())


def check_client_nino(spark, sf_dir):
    return checks.one_nino_per_client(_staged(spark, sf_dir, "faulty"))


def check_financial_reconciliation(spark, sf_dir):
    ltv = _client_tables(_staged(spark, sf_dir))[1]
    return checks.financial_reconciliation(_staged(spark, sf_dir, "faulty"), ltv)


def check_row_counts(spark, sf_dir):
    return checks.row_count_reconciliation(fee_ledger(spark, sf_dir, "bulky"), _staged(spark, sf_dir, "bulky"))


def check_ltv_recompute(spark, sf_dir):
    ltv = _client_tables(_staged(spark, sf_dir))[1]
    return checks.ltv_recomputation(_staged(spark, sf_dir, "faulty"), ltv)


def check_summary(spark, sf_dir):
    return checks.run_checks(_build(spark, fee_ledger(spark, sf_dir, "raw")))


def check_summary_faulty(spark, sf_dir):
    return checks.run_checks(_build(spark, fee_ledger(spark, sf_dir, "faulty")))


# Other attributions


def last_touch(spark, sf_dir):
    return clients.last_touch(_staged(spark, sf_dir))


def last_touch_ltv(spark, sf_dir):
    fees = _staged(spark, sf_dir)
    return attribution.last_touch_ltv(fees, _client_tables(fees)[1])


def fee_weighted(spark, sf_dir):
    fees = _staged(spark, sf_dir)
    return attribution.fee_weighted_ltv(fees, clients.client_dimension(fees))


def time_weighted(spark, sf_dir):
    fees = _staged(spark, sf_dir)
    return attribution.time_weighted_ltv(fees, _client_tables(fees)[1])


# Monitoring


def freshness(spark, sf_dir):
    return monitoring.freshness(fee_ledger(spark, sf_dir), AS_OF)


def daily_anomaly(spark, sf_dir):
    return monitoring.daily_anomalies(_staged(spark, sf_dir))


def daily_anomaly_events(spark, sf_dir):
    return monitoring.daily_anomalies(staging.stage_fees(event_ledger(spark, sf_dir)), days=7, sigmas=1.0)


def calendar_anomaly(spark, sf_dir):
    return monitoring.calendar_anomalies(_staged(spark, sf_dir).where("dayofweek(fee_date) <> 1"), days=14, sigmas=2.0)


def layer_counts(spark, sf_dir):
    return monitoring.layer_counts(_build(spark, fee_ledger(spark, sf_dir, "raw")))


def count_changes(spark, sf_dir):
    daily = fee_ledger(spark, sf_dir).groupBy("fee_date").agg(F.count("*").alias("rows"))
    history = daily.select(F.col("fee_date").alias("run_id"), F.lit("fees").alias("table"), "rows")
    return monitoring.count_changes(history, 0.5)


def recorded_counts(spark, sf_dir):
    history = f"{scratch_dir(spark, 'counts')}/history"
    for run_id, variant in (("first", "raw"), ("second", "bulky")):
        layers = {"raw_fees": fee_ledger(spark, sf_dir, variant), "stg_fees": _staged(spark, sf_dir, variant)}
        monitoring.record_counts(layers, history, run_id)
    return monitoring.count_changes(spark.read.parquet(history), 0.05)


def declared_rules(spark, sf_dir):
    rules = [
        monitoring.Rule("client_id", "not_null"),
        monitoring.Rule("fee_amount", "between", -100000.0, 100000.0),
        monitoring.Rule("fee_date", "between", dt.date(1995, 1, 1), dt.date(2000, 12, 31)),
        monitoring.Rule("client_id", "unique"),
    ]
    return monitoring.rule_violations(fee_ledger(spark, sf_dir, "raw"), rules)


def late_rows_skipped(spark, sf_dir):
    staged = staging.stage_fees(fee_ledger(spark, sf_dir, "raw"))
    bound = high_water_mark(fee_ledger(spark, sf_dir, "raw"))
    return staging.skipped_by_lookback(fee_ledger(spark, sf_dir), staged, bound)


def matured_cohorts(spark, sf_dir):
    dimension, ltv = _client_tables(_staged(spark, sf_dir))
    return reports.cohort_ltv(monitoring.matured_clients(dimension, dt.date(1999, 12, 31)), ltv)


def reconcile_ltv(spark, sf_dir):
    ltv = _client_tables(_staged(spark, sf_dir))[1]
    return monitoring.reconcile_ltv(_staged(spark, sf_dir, "faulty"), ltv)


def compare_builds(spark, sf_dir):
    # Both builds are made of the same lines, joined once.
    path = f"{scratch_dir(spark, 'lines')}/lines"
    overwrite_table(fee_lines(spark, sf_dir), path)
    before, after = (_build(spark, fees_sent(read_table(spark, path), variant)) for variant in ("raw", "faulty"))
    money = {"raw_fees": "fee_amount", "stg_fees": "fee_amount", "rpt_client_ltv": "ltv_total"}
    return monitoring.compare_builds(before, after, money)


def trace_to_raw(spark, sf_dir):
    fees = _staged(spark, sf_dir)
    dimension, ltv = _client_tables(fees)
    best = reports.top_advisers(reports.adviser_ltv(dimension, ltv), 1).select("adviser_id")
    served = dimension.join(best, dimension.first_adviser_id == best.adviser_id, "left_semi")
    return monitoring.trace_to_raw(fee_ledger(spark, sf_dir, "raw"), fees, served)


def trace_to_file(spark, sf_dir):
    """The fees behind the best adviser's value, each with the file and the record that brought it."""
    root = scratch_dir(spark, "trace")
    ledger = fee_ledger(spark, sf_dir, "raw").withColumn("month", F.date_format("fee_date", "yyyy-MM"))
    # One file a month, its records in the order of their columns.
    files = ledger.repartition("month").sortWithinPartitions("month", *FEE_SCHEMA.fieldNames())
    files.write.partitionBy("month").csv(f"{root}/files", header=True)
    path = f"{root}/raw"
    overwrite_table(read_fees_csv_traced(spark, f"{root}/files/*/*.csv"), path, ["fee_date"])
    raw = read_table(spark, path, StructType([*FEE_SCHEMA.fields, StructField("source_file", StringType()), StructField("source_id", LongType())]))
    fees = staging.stage_fees(raw)
    dimension, ltv = _client_tables(fees)
    best = reports.top_advisers(reports.adviser_ltv(dimension, ltv), 1).select("adviser_id")
    served = dimension.join(best, dimension.first_adviser_id == best.adviser_id, "left_semi")
    traced = monitoring.trace_to_file(raw, fees, served)
    month = F.regexp_extract("source_file", "month=([0-9-]+)/", 1)
    return traced.select("fee_id", "client_id", "adviser_id", "fee_date", "fee_amount", month.alias("source_month"), "source_row")


def _faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fees as CSV text, some written badly, as attributes of the line tell."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").join(spark.read.parquet(f"{sf_dir}/orders.parquet"), F.expr("l_orderkey = o_orderkey"))
    fault = F.when(F.col("l_tax") == 0, F.col("l_quantity").cast("int"))
    client, date, amount = F.col("o_custkey").cast("string"), F.col("o_orderdate").cast("date").cast("string"), F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    cells = {
        "client_id": F.when(fault == 1, "").otherwise(client),
        "client_nino": F.when(fault == 2, F.concat(F.lit('"NI\n'), client, F.lit('"'))).otherwise(F.concat(F.lit("NI"), client)),
        "adviser_id": F.col("l_suppkey").cast("string"),
        "fee_date": F.when(fault.isin(3, 4), "1996-02-31").otherwise(date),
        "fee_amount": F.when(fault.isin(4, 5), F.concat(amount, F.lit("d"))).when(fault == 6, F.concat(amount, F.lit(",extra"))).otherwise(amount),
    }
    whole = F.concat_ws(",", *cells.values())
    short = F.concat_ws(",", *list(cells.values())[:-1])
    return lines.select(F.when(fault == 7, short).otherwise(whole).alias("value"))


def quarantine_by_column(spark, sf_dir):
    root = scratch_dir(spark, "sorted-out")
    header = spark.createDataFrame([(",".join(FEE_SCHEMA.fieldNames()),)], "value string")
    # Every file begins with the header: 16 files of lines or more, each below its own. A file is read by one task.
    files = max(16, -(-spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() // LINES_PER_FILE))
    lines = _faulty_lines(spark, sf_dir).withColumn("file", F.pmod(F.xxhash64("value"), F.lit(files)).cast("int"))
    headers = header.select("value", F.explode(F.sequence(F.lit(0), F.lit(files - 1))).alias("file"))
    ordered = headers.withColumn("at", F.lit(0)).unionByName(lines.withColumn("at", F.lit(1))).repartition(files, "file").sortWithinPartitions("file", "at")
    ordered.select("value", "file").write.partitionBy("file").text(f"{root}/files")
    write_by_outcome(sort_out_fees_csv(spark, f"{root}/files/*/*.txt"), f"{root}/records")
    found = spark.read.parquet(f"{root}/records").withColumn("reason", F.array_join("reasons", "; "))
    units = F.sum(to_units(F.col("fee_amount")))
    return found.groupBy("outcome", "reason").agg(
        F.count("*").alias("rows"), units_to_double(units).alias("total_fees"), F.count("record").alias("records_kept"),
        F.count_if(F.col("client_nino").contains("\n")).alias("quoted_newlines"),
    )


def header_drift(spark, sf_dir):
    """Files of one month each, whose headers differ by quarter: as declared, a column left out, added, renamed or moved."""
    folder = f"{scratch_dir(spark, 'headers')}/files"
    # Joined and dealt out once for all layouts.
    ledger = fee_ledger(spark, sf_dir).withColumn("month", F.date_format("fee_date", "yyyy-MM")).repartition("month").persist(StorageLevel.DISK_ONLY)
    names = FEE_SCHEMA.fieldNames()
    layouts = {
        (1, 2, 3): ledger,
        (4, 5): ledger.drop("adviser_id"),
        (6, 7): ledger.withColumn("currency", F.lit("GBP")),
        (8, 9): ledger.withColumnRenamed("client_nino", "nino"),
        (10, 11, 12): ledger.select(*names[::-1], "month"),
    }
    try:
        for months, rows in layouts.items():
            rows.where(F.month("fee_date").isin(*months)).write.mode("append").partitionBy("month").csv(folder, header=True)
    finally:
        ledger.unpersist()
    drift = header_contract(spark, f"{folder}/*/*.csv")
    return drift.select(F.regexp_extract("source_file", "month=([0-9-]+)/", 1).alias("month"), "column_name", "drift", "position")


def landing_freshness(spark, sf_dir):
    folder = f"{scratch_dir(spark, 'landing')}/files"
    fee_ledger(spark, sf_dir).withColumn("year", F.year("fee_date")).repartition("year").write.partitionBy("year").csv(folder, header=True)
    return file_freshness(spark, f"{folder}/*/*.csv").select("files", (F.col("bytes") > 0).alias("has_bytes"), (F.col("age_days") <= 1).alias("recent"), "stale")


def changed_fees(spark, sf_dir):
    """The fees that differ between the first load and the upserted staging table."""
    store = Warehouse(scratch_dir(spark, "changed"), versioned=True)
    store.write(staging.stage_fees(_earlier_ledger(spark, sf_dir), lay_out_by="fee_date"), "stg_fees", "fee_date", laid_out=True)
    store.write(fee_ledger(spark, sf_dir, "raw").dropna(subset=["fee_date"]), "fees", "fee_date")
    build_staging(spark, store)
    first, second = (read_snapshot(spark, store.path("stg_fees"), snapshot(spark, store.path("stg_fees"), n)) for n in (1, 2))
    return monitoring.changed_rows(first, second)


def pii_masked(spark, sf_dir):
    return privacy.mask_pii(_staged(spark, sf_dir), FEE_SCHEMA)


def pii_masked_keyed(spark, sf_dir):
    return privacy.mask_pii_keyed(_staged(spark, sf_dir), FEE_SCHEMA, "a secret for the tests alone")


def pii_scan(spark, sf_dir):
    patterns = {"nino": r"^NI[0-9]+X?$", "md5": r"^[0-9a-f]{32}$"}
    return privacy.scan_for_pii(_staged(spark, sf_dir, "faulty"), patterns)


def pii_scan_documents(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    return privacy.scan_for_pii(documents)


QUERIES = {
    f.__name__: f
    for f in (
        stg_fees,
        stg_fees_by_key,
        stg_incremental_slice,
        stg_upsert,
        published_versions,
        refresh_run_versioned,
        stg_append_columns,
        stg_clustered,
        dim_clients,
        client_ltv,
        client_ltv_single_pass,
        client_ltv_by_layout,
        client_ltv_yearly,
        client_ltv_events,
        cohort_ltv,
        adviser_ltv,
        top_advisers,
        check_unique_fee_id,
        check_not_null_summary,
        check_client_nino,
        check_financial_reconciliation,
        check_row_counts,
        check_ltv_recompute,
        check_summary,
        check_summary_faulty,
        ingest_summary,
        refresh_run,
        stream_arrivals,
        last_touch,
        last_touch_ltv,
        time_weighted,
        fee_weighted,
        backfill_range,
        quarantine_summary,
        quarantine_by_column,
        landing_freshness,
        header_drift,
        freshness,
        daily_anomaly,
        daily_anomaly_events,
        calendar_anomaly,
        layer_counts,
        count_changes,
        recorded_counts,
        declared_rules,
        late_rows_skipped,
        matured_cohorts,
        reconcile_ltv,
        compare_builds,
        trace_to_raw,
        trace_to_file,
        changed_fees,
        pii_masked,
        pii_masked_keyed,
        pii_scan,
        pii_scan_documents,
    )
}
