"""Heavy clients: salted joins, and tables laid out by client."""

import datetime as dt
import hashlib
import hmac
import re
import statistics

import pytest
from pyspark.sql import functions as F

from feeloom.operators.attribution import adviser_tenure, fee_weighted_ltv
from feeloom.operators.checks import ltv_recomputation
from feeloom.operators.clients import client_dimension, client_ltv, daily_units
from feeloom.operators.monitoring import calendar_anomalies
from feeloom.operators.privacy import keyed_digest, mask_pii_keyed
from feeloom.operators.skew import heavy_keys, salted_join
from feeloom.operators.staging import stage_fees
from feeloom.schemas import FEE_SCHEMA
from feeloom.sinks.by_client import write_by_client, write_model
from tests.conftest import fee, rows
from tests.test_plans import plan

N = 90_000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the fees are one client's, under 10,000 advisers."""
    i = F.col("id")
    raw = spark.range(0, N, numPartitions=8).select(
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (i % 9973).cast("string"))).alias("client_id"),
        F.lit("n").alias("client_nino"),
        F.concat(F.lit("a"), (F.floor(i / 3) % 10_000).cast("string")).alias("adviser_id"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), ((i * 7) % 400).cast("int")).alias("fee_date"),
        ((i % 10007) / 100.0).cast("decimal(18,2)").cast("double").alias("fee_amount"),
    )
    return stage_fees(raw).persist()


def largest_to_median(df):
    """Rows of the fullest task against the median one, where the exchange deals rows by what it joined on."""
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    return max(sizes) / statistics.median(sizes)


def test_a_heavy_client_is_spread_evenly(spark, skewed):
    heavy = heavy_keys(skewed, "client_id", rows_per_task=100)
    assert [r["client_id"] for r in heavy.collect()] == ["hot"]
    daily = daily_units(skewed, "client_id", "adviser_id")
    dimension = client_dimension(skewed)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = daily.join(dimension.select("client_id", "first_fee_date"), "client_id")
        salted = salted_join(daily, dimension.select("client_id", "first_fee_date"), "client_id", ["adviser_id", "fee_date"], heavy)
        assert largest_to_median(plain) > 2
        assert largest_to_median(salted) <= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert rows(salted, *plain.columns) == rows(plain, *plain.columns)


def test_credits_do_not_depend_on_the_salt(skewed):
    dimension = client_dimension(skewed).persist()
    plain = fee_weighted_ltv(skewed, dimension)
    assert rows(fee_weighted_ltv(skewed, dimension, rows_per_task=50), "*") == rows(plain, "*")
    assert heavy_keys(skewed, "client_id").isEmpty()


def test_heavy_keys_of_awkward_tables(spark):
    keys = spark.createDataFrame([(None,)] * 50 + [("a",)] * 40 + [("b",)], "k string")
    assert [tuple(r) for r in heavy_keys(keys, "k", rows_per_task=10).collect()] == [("a", 4)]
    assert heavy_keys(keys.limit(0), "k").isEmpty()
    one = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, x int")
    assert salted_join(keys, one, "k", ["k"], heavy_keys(keys, "k", 10)).groupBy("x").count().orderBy("x").collect() == [(1, 40), (2, 1)]


@pytest.fixture
def layout(spark, skewed, tmp_path):
    made = write_by_client(skewed, "layout_fees", str(tmp_path / "fees"), 8, sort_by=("fee_date",), rows_per_task=1000)
    yield made
    for name in ("layout_fees", "layout_clients", "layout_ltv"):
        for part in ("even", "heavy"):
            spark.sql(f"DROP TABLE IF EXISTS {name}_{part}")


def test_client_models_need_no_exchange_over_the_layout(spark, skewed, layout, tmp_path):
    assert [r[0] for r in layout.heavy(spark).select("client_id").distinct().collect()] == ["hot"]
    assert layout.even(spark).count() + layout.heavy(spark).count() == skewed.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "true")
    try:
        clients = write_model(client_dimension(layout.even(spark)), client_dimension(layout.heavy(spark)), layout, "layout_clients", str(tmp_path / "clients"))
        values = [client_ltv(part(layout), part(clients)) for part in (lambda t: t.even(spark), lambda t: t.heavy(spark))]
        ltv = write_model(*values, layout, "layout_ltv", str(tmp_path / "ltv"))
        plans = [client_dimension(layout.even(spark)), values[0], ltv_recomputation(layout.even(spark), ltv.even(spark))]
        for df in plans:
            text = plan(df, "simple")
            assert "Exchange" not in text and re.search(r"Bucketed: true|SelectedBucketsCount: 8 out of 8", plan(df)), text
        assert ltv_recomputation(layout.even(spark), ltv.even(spark)).isEmpty()
        both = ltv.even(spark).unionAll(ltv.heavy(spark))
        assert rows(both, "*") == rows(client_ltv(skewed, client_dimension(skewed)), "*")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def test_one_file_a_bucket(spark, layout):
    files = layout.even(spark).inputFiles()
    assert len(files) == len(set(files)) <= 8


def test_keyed_digests_are_hmacs(spark, ledger):
    values = ["", "NI1", "ü\U0001f600", "x" * 300, None]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    for secret in ("k", "secret " * 8, "a long secret " * 9):
        want = [None if v is None else hmac.new(secret.encode(), v.encode(), hashlib.sha256).hexdigest() for v in values]
        assert [r[0] for r in frame.select(keyed_digest(F.col("v"), secret)).collect()] == want
    with pytest.raises(ValueError):
        keyed_digest(F.col("v"), "")
    masked = mask_pii_keyed(ledger(fee("A", "a", "2025-01-05", 1.0), fee("B", "a", "2025-01-05", 1.0, "NA")), FEE_SCHEMA, "k").collect()
    assert masked[0]["client_nino"] == masked[1]["client_nino"] != hashlib.sha256(b"NA").hexdigest() and masked[0]["client_id"] == "A"


def test_a_silent_day_is_a_row_and_anomalous(ledger):
    start = dt.date(2025, 1, 1)
    fees = [fee("A", f"a{k}", start + dt.timedelta(days=d), 10.0 + d % 3) for d in range(40) if d not in (20, 33) for k in range(3)]
    fees.append(fee("A", "a", start + dt.timedelta(days=80), 10.0))
    got = {r["fee_date"]: r for r in calendar_anomalies(ledger(*fees), days=7).collect()}
    assert len(got) == 81
    day = lambda d: got[start + dt.timedelta(days=d)]
    assert day(20)["silent"] and day(20)["anomalous"] and day(33)["anomalous"] and day(20)["total_fees"] == 0.0
    assert not day(10)["anomalous"] and not day(0)["anomalous"] and day(0)["expected_fees"] is None
    # A silent stretch stops being news once most days before it were silent too.
    assert day(40)["anomalous"] and not day(60)["anomalous"] and day(60)["silent"]
    assert calendar_anomalies(ledger()).count() == 0


def test_tenure_takes_one_exchange_by_client(spark, ledger):
    fees = stage_fees(ledger(fee("A", "a", "2025-01-05", 1.0)))
    text = plan(adviser_tenure(fees.select("client_id", "fee_date", "adviser_id")), "simple")
    # The source rows are staged (one) and made distinct (one); clients are dealt out once.
    assert text.count("Exchange") <= 3 and len(re.findall(r"hashpartitioning\(client_id#\d+, \d+\)", text)) == 1


def test_tenure_by_hand(ledger):
    days = ["2025-01-01", "2025-01-01", "2025-01-04", "2025-01-04", "2025-01-04", "2025-03-01"]
    fees = ledger(*[fee("A", a, d, 1.0 + i) for i, (a, d) in enumerate(zip("abaacb", days, strict=True))], fee("B", "a", "2025-02-01", 1.0))
    got = {(r["client_id"], r["adviser_id"]): (r["tenure_units"], r["client_units"]) for r in adviser_tenure(fees).collect()}
    # 3 days shared by a and b, 56 by a and c, the last day b's.
    whole = 60_000_000
    assert got == {("A", "a"): (29_500_000, whole), ("A", "b"): (2_500_000, whole), ("A", "c"): (28_000_000, whole), ("B", "a"): (1_000_000, 1_000_000)}
