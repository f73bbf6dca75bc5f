"""Physical plans: what reaches the scan, what is shuffled, what stays out of one task."""

import datetime as dt
import re

import pytest

from feeloom.operators.clients import client_dimension, client_ltv, client_ltv_single_pass
from feeloom.operators.staging import stage_fees
from feeloom.plans.queries import QUERIES
from feeloom.plans.refresh import Warehouse
from feeloom.session import cluster_conf
from feeloom.sinks import overwrite_table
from feeloom.sources.testdata import fee_ledger

SF_DIR = "/root/testdata/sf0.001"
LAZY = [n for n in QUERIES if n not in {
    "stg_upsert", "stg_append_columns", "backfill_range", "ingest_summary", "quarantine_summary", "stream_arrivals",
    "refresh_run", "refresh_run_versioned", "published_versions", "header_drift", "check_summary", "check_summary_faulty", "layer_counts", "compare_builds", "trace_to_file", "quarantine_by_column", "landing_freshness", "changed_fees", "client_ltv_by_layout", "stg_incremental_slice", "late_rows_skipped",
}]


def plan(df, mode="formatted"):
    jvm = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return df._jdf.queryExecution().explainString(jvm.fromString(mode))


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = Warehouse(str(tmp_path_factory.mktemp("plans")))
    raw = fee_ledger(spark, SF_DIR).where("fee_date < DATE '1995-02-15'")
    overwrite_table(raw, store.path("fees"), ["fee_date"])
    overwrite_table(stage_fees(raw), store.path("stg_fees"), ["fee_date"])
    overwrite_table(client_dimension(store.read(spark, "stg_fees")), store.path("dim_clients"))
    return store


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_or_nested_loop_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python", text)
    # Only the smallest-number option keeps a string in an aggregate buffer, which needs sorting.
    assert "SortAggregate" not in text or name == "stg_fees_by_key"


def test_lookback_prunes_partitions(spark, store):
    slice_ = stage_fees(store.read(spark, "fees"), dt.date(1995, 2, 10))
    text = plan(slice_)
    print(text)
    assert re.search(r"PartitionFilters: \[.*fee_date#\d+ >= 1995-02-07", text)


def test_client_models_read_only_their_columns(spark, store):
    fees = store.read(spark, "stg_fees")
    schemas = re.findall(r"ReadSchema: (struct<.*?>)", plan(client_ltv_single_pass(fees)))
    assert schemas == ["struct<client_id:string,fee_amount:double>"]
    assert "client_nino" not in "".join(re.findall(r"ReadSchema: (.*)", plan(client_dimension(fees))))


def test_dimension_limits_rows_before_the_exchange(spark, store):
    text = plan(client_dimension(store.read(spark, "stg_fees")), "simple")
    exchange = text.index("Exchange hashpartitioning(client_id")
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > exchange > text.index("WindowGroupLimit")


def test_client_ltv_sums_days_before_the_client_exchange(spark, store):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(client_ltv(store.read(spark, "stg_fees"), store.read(spark, "dim_clients")), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"Exchange hashpartitioning\(client_id#\d+, fee_date#\d+, ", text)) == 1
    # One exchange by client on each side of the join; the final aggregate needs none of its own.
    assert len(re.findall(r"Exchange hashpartitioning\(client_id#\d+, \d+\)", text)) == 2
    assert text.count("Exchange") == 3


def test_single_pass_has_one_scan(spark, store):
    text = plan(client_ltv_single_pass(store.read(spark, "stg_fees")), "simple")
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 2


def test_staging_shuffles_once_and_without_the_key(spark, store):
    text = plan(stage_fees(store.read(spark, "fees")), "simple")
    assert text.count("Exchange") == 1
    assert text.index("md5") < text.index("Exchange")


def test_cluster_settings_scale_with_the_input():
    assert int(cluster_conf(100 * 10**12, 8000)["spark.sql.shuffle.partitions"]) > 700_000
    assert int(cluster_conf(10**9, 8)["spark.sql.shuffle.partitions"]) == 16
