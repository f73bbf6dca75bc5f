"""One key holding a third of the rows: same results, and no task that must hold the whole group."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feeloom.operators.attribution import adviser_tenure, fee_weighted_ltv, time_weighted_ltv
from feeloom.operators.checks import one_nino_per_client
from feeloom.operators.clients import client_dimension, client_ltv, client_ltv_single_pass, daily_units
from feeloom.operators.reports import adviser_ltv, cohort_ltv
from feeloom.operators.staging import stage_fees
from tests.conftest import rows

N = 60_000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the fees are one client's, a third one adviser's, a third of all rows are copies of one fee."""
    i = F.col("id")
    raw = spark.range(0, N, numPartitions=8).select(
        F.when(i % 3 == 0, "hot").when(i % 3 == 1, "copied").otherwise(F.concat(F.lit("c"), (i % 997).cast("string"))).alias("client_id"),
        F.lit("n").alias("client_nino"),
        F.when(i % 3 == 1, "a1").when(i % 2 == 0, "a0").otherwise(F.concat(F.lit("a"), (i % 31).cast("string"))).alias("adviser_id"),
        F.when(i % 3 == 1, F.lit(dt.date(2024, 1, 1))).otherwise(F.date_add(F.lit(dt.date(2024, 1, 1)), ((i * 7) % 400).cast("int"))).alias("fee_date"),
        F.when(i % 3 == 1, 5.0).otherwise((i % 10007) / 100.0).cast("decimal(18,2)").cast("double").alias("fee_amount"),
    )
    return stage_fees(raw).persist()


def test_copies_collapse_before_the_exchange(skewed):
    assert skewed.where("client_id = 'copied'").count() == 1


def test_models_equal_a_plain_recomputation(skewed):
    pdf = skewed.toPandas()
    pdf["pennies"] = (pdf.fee_amount * 100).round().astype(int)
    first = pdf.sort_values(["fee_date", "fee_id"]).groupby("client_id").first()
    dimension = client_dimension(skewed)
    assert rows(dimension, "client_id", "first_adviser_id") == sorted(
        (c, a) for c, a in first.adviser_id.items()
    )
    totals = pdf.groupby("client_id").pennies.sum()
    ltv = client_ltv(skewed, dimension)
    assert rows(ltv, "client_id", (F.round(F.col("ltv_total") * 100)).cast("bigint")) == sorted(totals.items())
    assert rows(client_ltv_single_pass(skewed), "*") == rows(ltv, "*")
    by_adviser = totals.groupby(first.adviser_id).sum()
    report = adviser_ltv(dimension, ltv)
    assert rows(report, "adviser_id", (F.round(F.col("total_client_ltv_all_time") * 100)).cast("bigint")) == sorted(
        by_adviser.items()
    )
    assert cohort_ltv(dimension, ltv).agg(F.sum("client_count")).first()[0] == len(totals)
    assert one_nino_per_client(skewed).isEmpty()


def test_a_client_brings_at_most_one_row_per_day_to_its_exchange(skewed):
    per_client = daily_units(skewed, "client_id").groupBy("client_id").count()
    assert per_client.agg(F.max("count")).first()[0] <= 400


def test_shares_add_up(skewed):
    dimension = client_dimension(skewed)
    ltv = client_ltv(skewed, dimension)
    total = skewed.agg(F.sum(F.col("fee_amount").cast("decimal(18,2)"))).first()[0]
    fee_weighted = fee_weighted_ltv(skewed, dimension)
    assert abs(fee_weighted.agg(F.sum("credited_ltv_total")).first()[0] - float(total)) < 0.01
    tenure = adviser_tenure(skewed).groupBy("client_id").agg(
        F.sum("tenure_units").alias("parts"), F.max("client_units").alias("whole")
    )
    assert tenure.where("parts <> whole").isEmpty()
    credited = time_weighted_ltv(skewed, ltv).agg(F.sum("credited_ltv_total")).first()[0]
    assert abs(credited - float(total)) < 0.01
    pairs = skewed.select("client_id", "adviser_id").distinct().count()
    assert adviser_tenure(skewed).count() == pairs
