"""Client-level models: dimension and lifetime value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feeloom.functions.dates import in_first_months, month_label
from feeloom.functions.money import MONEY_SCALE, to_units, units_to_double
from feeloom.schemas import LTV_WINDOWS, ltv_column, ltv_columns


def _one_per_client(fees: DataFrame, *order: Column) -> DataFrame:
    # Catalyst keeps the row_number() = 1 limit on both sides of the exchange (WindowGroupLimit), so each map
    # task sends at most one row per client, however many fees a client has.
    numbered = Window.partitionBy("client_id").orderBy(*order)
    return (
        fees.select("client_id", "adviser_id", "fee_date", "fee_id")
        .withColumn("fee_rank", F.row_number().over(numbered))
        .where("fee_rank = 1")
    )


def client_dimension(fees: DataFrame) -> DataFrame:
    """One row per client: first fee date, adviser of the first fee (ties by fee_id), cohort month."""
    first = _one_per_client(fees, F.asc("fee_date"), F.asc("fee_id"))
    return first.select(
        "client_id",
        F.col("fee_date").alias("first_fee_date"),
        F.col("adviser_id").alias("first_adviser_id"),
        month_label(F.col("fee_date")).alias("cohort_month"),
    )


def last_touch(fees: DataFrame) -> DataFrame:
    """One row per client: date and adviser of the latest fee (ties by fee_id, latest first)."""
    last = _one_per_client(fees, F.desc("fee_date"), F.desc("fee_id"))
    return last.select(
        "client_id",
        F.col("fee_date").alias("last_fee_date"),
        F.col("adviser_id").alias("last_adviser_id"),
    )


def daily_units(fees: DataFrame, *keys: str, scale: int = MONEY_SCALE) -> DataFrame:
    """Fees summed per ``keys`` and day, in minor units.

    Windows depend on the date only, so this changes no result, and it bounds what one client can bring to
    the later client-wise exchange by the number of calendar days.
    """
    return (
        fees.select(*keys, "fee_date", to_units(F.col("fee_amount"), scale).alias("units"))
        .groupBy(*keys, "fee_date")
        .agg(F.sum("units").alias("units"))
    )


def window_units(windows: Sequence[int], first: str = "first_fee_date") -> list[Column]:
    """Cumulative sums of ``units`` per window of months, then the all-time sum."""
    sums = [
        F.sum(
            F.when(in_first_months(F.col("fee_date"), F.col(first), n), F.col("units")).otherwise(F.lit(0))
        ).alias(ltv_column(n))
        for n in windows
    ]
    return [*sums, F.sum("units").alias("ltv_total")]


def _ltv_table(daily_with_first: DataFrame, windows: Sequence[int], scale: int) -> DataFrame:
    sums = daily_with_first.groupBy("client_id", "first_fee_date").agg(*window_units(windows))
    money = [units_to_double(F.col(c), scale).alias(c) for c in ltv_columns(windows)]
    return sums.select("client_id", "first_fee_date", *money)


def client_ltv(
    fees: DataFrame, clients: DataFrame, windows: Sequence[int] = LTV_WINDOWS, scale: int = MONEY_SCALE
) -> DataFrame:
    """Lifetime value per client at each window of calendar months from the dimension's first fee date."""
    daily = daily_units(fees, "client_id", scale=scale)
    return _ltv_table(
        daily.join(clients.select("client_id", "first_fee_date"), "client_id"), windows, scale
    )


def client_ltv_single_pass(
    fees: DataFrame, windows: Sequence[int] = LTV_WINDOWS, scale: int = MONEY_SCALE
) -> DataFrame:
    """As client_ltv, taking the first date from the fees themselves: one scan, no join."""
    daily = daily_units(fees, "client_id", scale=scale)
    first = F.min("fee_date").over(Window.partitionBy("client_id"))
    return _ltv_table(daily.withColumn("first_fee_date", first), windows, scale)
