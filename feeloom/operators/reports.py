"""Cohort and adviser reports over the client-level tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feeloom.functions.money import exact_mean, to_units, units_to_double
from feeloom.operators.ranking import rank_descending, value_band
from feeloom.schemas import LTV_WINDOWS, adviser_ltv_schema, cohort_ltv_schema, ltv_column, ltv_columns


def client_values(
    clients: DataFrame, ltv: DataFrame, windows: Sequence[int] = LTV_WINDOWS
) -> DataFrame:
    """Clients with their lifetime values in minor units of the published (2-decimal) figures."""
    units = [to_units(F.col(c)).alias(c) for c in ltv_columns(windows)]
    return clients.join(ltv.select("client_id", *units), "client_id")


def _total(column: str) -> Column:
    return units_to_double(F.col(column))


def exact_median(df: DataFrame, key: str, value: str, out: str, few_keys: bool = False) -> DataFrame:
    """(key, out): the value at place ceil(n / 2) of each key's n sorted values (BIGINT, NULLs left out).

    Equal values are counted first, map-side. The distinct values of a key are cut into bands by a monotone function;
    the band totals show which band holds the place, and only the values of that band meet in one task.
    ``few_keys``: the keys are as few as the months of a calendar, so the middle bands, one row each, are broadcast.
    """
    counts = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_band", value_band(value))
    preceding = (Window.unboundedPreceding, -1)
    whole = Window.partitionBy(key)
    bands = counts.groupBy(key, "_band").agg(F.sum("_n").alias("_in_band"))
    before = F.coalesce(F.sum("_in_band").over(whole.orderBy("_band").rowsBetween(*preceding)), F.lit(0))
    bands = bands.withColumns({"_before": before, "_place": F.floor((F.sum("_in_band").over(whole) + 1) / 2).cast("bigint")})
    middle = bands.where((F.col("_before") < F.col("_place")) & (F.col("_before") + F.col("_in_band") >= F.col("_place")))
    middle = middle.select(key, "_band", "_before", "_place")
    inside = counts.join(F.broadcast(middle) if few_keys else middle, [key, "_band"])
    reached = F.col("_before") + F.sum("_n").over(Window.partitionBy(key, "_band").orderBy(value))
    return inside.withColumn("_reached", reached).where("_reached >= _place").groupBy(key).agg(F.min(value).alias(out))


def cohort_ltv_from_values(values: DataFrame, windows: Sequence[int] = LTV_WINDOWS) -> DataFrame:
    """Cohort report from client_values()."""
    longest = ltv_column(max(windows))
    # client_id is unique on both sides of the join, so count(*) is the distinct count without its exchange.
    sums = values.groupBy("cohort_month").agg(
        F.count("*").alias("client_count"),
        *[F.sum(ltv_column(n)).alias(ltv_column(n)) for n in windows],
    )
    sums = sums.join(exact_median(values, "cohort_month", longest, "median", few_keys=True), "cohort_month", "left")
    return sums.select(
        "cohort_month",
        "client_count",
        *[exact_mean(F.col(ltv_column(n)), F.col("client_count")).alias(f"avg_{ltv_column(n)}") for n in windows],
        *[_total(ltv_column(n)).alias(f"total_{ltv_column(n)}") for n in windows],
        _total("median").alias(f"median_{longest}"),
    ).select(*cohort_ltv_schema(windows).fieldNames())


def adviser_ltv_from_values(
    values: DataFrame, windows: Sequence[int] = LTV_WINDOWS, adviser: str = "first_adviser_id"
) -> DataFrame:
    """Adviser report from client_values(): every client's whole value goes to the adviser in ``adviser``."""
    longest = ltv_column(max(windows))
    sums = values.groupBy(F.col(adviser).alias("adviser_id")).agg(
        F.count("*").alias("client_count"),
        *[F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c) for c in ltv_columns(windows)],
    )
    ranked = rank_descending(sums, longest, f"rank_by_{longest}")
    return ranked.select(
        "adviser_id",
        "client_count",
        *[_total(ltv_column(n)).alias(f"total_client_{ltv_column(n)}") for n in windows],
        _total("ltv_total").alias("total_client_ltv_all_time"),
        exact_mean(F.col(longest), F.col("client_count")).alias(f"avg_client_{longest}"),
        f"rank_by_{longest}",
    ).select(*adviser_ltv_schema(windows).fieldNames())


def cohort_ltv(clients: DataFrame, ltv: DataFrame, windows: Sequence[int] = LTV_WINDOWS) -> DataFrame:
    """Per cohort month: clients, average and total lifetime value per window, median of the longest.

    The median is the lower one of two middle values, exact for any number of clients.
    """
    return cohort_ltv_from_values(client_values(clients, ltv, windows), windows)


def adviser_ltv(
    clients: DataFrame,
    ltv: DataFrame,
    windows: Sequence[int] = LTV_WINDOWS,
    adviser: str = "first_adviser_id",
) -> DataFrame:
    """Per adviser: clients, total lifetime value per window and all time, average, and rank by the longest window."""
    return adviser_ltv_from_values(client_values(clients, ltv, windows), windows, adviser)


def top_advisers(report: DataFrame, k: int = 10, windows: Sequence[int] = LTV_WINDOWS) -> DataFrame:
    """The ``k`` best-ranked advisers; adviser_id breaks ties."""
    return report.orderBy(f"rank_by_{ltv_column(max(windows))}", "adviser_id").limit(k)
