"""Means, medians and totals that stay exact beyond the size of the test tables."""

import pytest
from pyspark.sql import functions as F

from feeloom.functions.money import exact_mean
from feeloom.operators.checks import financial_reconciliation
from feeloom.operators.reports import exact_median


@pytest.mark.parametrize(
    "pennies,count,mean",
    [(10_000, 20_001, 0.0), (-10_000, 20_001, 0.0), (10_000, 20_000, 0.01), (-10_000, 20_000, -0.01), (25, 10, 0.03), (-25, 10, -0.03), (7, 1, 0.07)],
)
def test_a_mean_is_rounded_once(spark, pennies, count, mean):
    row = spark.createDataFrame([(pennies, count)], "s long, n long").select(exact_mean(F.col("s"), F.col("n"))).first()
    assert row[0] == mean


@pytest.mark.parametrize("partitions", [1, 4, 32])
def test_a_median_is_exact_for_many_values(spark, partitions):
    values = spark.range(200_000).select(F.lit("a").alias("k"), (F.xxhash64("id") % 10**12).alias("v"))
    hot = spark.range(90_000).select(F.lit("b").alias("k"), F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") - 45_000).cast("long").alias("v"))
    both = values.unionByName(hot).unionByName(spark.createDataFrame([("c", None), ("c", 3), ("d", 4), ("d", -4)], "k string, v long"))
    got = {r["k"]: r["m"] for r in exact_median(both.repartition(partitions), "k", "v", "m").collect()}
    want = {r["k"]: r["m"] for r in both.groupBy("k").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY v)").alias("m")).collect()}
    assert got == {k: int(m) for k, m in want.items()}


def test_totals_beyond_a_double_are_compared_exactly(spark):
    fees = spark.createDataFrame([(7e13,)] * 399 + [(7e13 + 1,)], "fee_amount double")
    ltv = spark.createDataFrame([(7e13,)] * 400, "ltv_total double")
    assert financial_reconciliation(fees, ltv).count() == 1
    assert financial_reconciliation(fees, fees.select(F.col("fee_amount").alias("ltv_total"))).isEmpty()
