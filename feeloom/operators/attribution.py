"""Attribution models other than first touch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feeloom.functions.money import MONEY_SCALE, units_to_double
from feeloom.operators.clients import daily_units, last_touch, window_units
from feeloom.operators.reports import adviser_ltv, client_values
from feeloom.operators.skew import ROWS_PER_TASK, heavy_keys, salted_join
from feeloom.schemas import LTV_WINDOWS, ltv_column, ltv_columns
from feeloom.session import scratch_dir
from feeloom.sinks.tables import COMPRESSION

# Tenure is counted in millionths of a day, so that advisers can share one.
DAY_UNITS = 1_000_000
# A task's windows, sums and joins take about 1.2 kB for each of these rows.
SERVED_ROWS_PER_TASK = 250_000


def last_touch_ltv(fees: DataFrame, ltv: DataFrame, windows: Sequence[int] = LTV_WINDOWS) -> DataFrame:
    """Adviser report crediting each client to the adviser of the latest fee."""
    return adviser_ltv(last_touch(fees), ltv, windows, adviser="last_adviser_id")


def fee_weighted_ltv(
    fees: DataFrame,
    clients: DataFrame,
    windows: Sequence[int] = LTV_WINDOWS,
    scale: int = MONEY_SCALE,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Adviser report crediting each adviser with the fees collected under them, window by window.

    A client whose fees span very many advisers and days is salted in the join, since AQE does not split a join that
    aggregates feed; advisers are summed map-side after it.
    """
    daily = daily_units(fees, "client_id", "adviser_id", scale=scale)
    heavy = heavy_keys(fees, "client_id", rows_per_task)
    dated = salted_join(daily, clients.select("client_id", "first_fee_date"), "client_id", ["adviser_id", "fee_date"], heavy)
    credited = dated.groupBy("adviser_id").agg(*window_units(windows))
    counts = (
        fees.select("client_id", "adviser_id")
        .distinct()
        .groupBy("adviser_id")
        .agg(F.count("*").alias("client_count"))
    )
    sums = credited.join(counts, "adviser_id")
    return sums.select(
        "adviser_id",
        "client_count",
        *[units_to_double(F.col(ltv_column(n)), scale).alias(f"credited_{ltv_column(n)}") for n in windows],
        units_to_double(F.col("ltv_total"), scale).alias("credited_ltv_total"),
    )


def adviser_tenure(fees: DataFrame) -> DataFrame:
    """(client_id, adviser_id, tenure_units, client_units): millionths of a day each adviser looked after a client.

    The advisers of a fee day share the time until the client's next fee day equally; the last fee day counts one day.
    Every pair of client and adviser is counted. A client brings one row per day and adviser to the one exchange by
    client; all the windows and sums over them keep that layout, and spill if a client has very many advisers.
    These rows are written first: their number tells how many tasks to deal them to, so that what one task sorts does not grow.
    """
    spark = fees.sparkSession
    path = scratch_dir(spark, "served")
    fees.select("client_id", "fee_date", "adviser_id").distinct().write.option("compression", COMPRESSION).parquet(path)
    served = spark.read.parquet(path)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-served.count() // SERVED_ROWS_PER_TASK))
    served = served.repartition(tasks, "client_id")
    day = F.unix_date("fee_date")
    advisers = F.count("*").over(Window.partitionBy("client_id", "fee_date"))
    # From the latest day back, the smallest of the later days is the next one.
    later = Window.partitionBy("client_id").orderBy(day.desc()).rangeBetween(Window.unboundedPreceding, -1)
    length = F.coalesce(F.min(day).over(later) - day, F.lit(1)).cast("bigint") * DAY_UNITS
    each = served.select("client_id", "adviser_id", F.call_function("div", length, advisers).alias("units"))
    pairs = each.groupBy("client_id", "adviser_id").agg(F.sum("units").alias("tenure_units"))
    return pairs.withColumn("client_units", F.sum("tenure_units").over(Window.partitionBy("client_id")))


def time_weighted_ltv(fees: DataFrame, ltv: DataFrame, windows: Sequence[int] = LTV_WINDOWS) -> DataFrame:
    """Adviser report splitting each client's value by tenure, in whole pennies.

    Shares are cut to the penny; what is left of a client's value goes to the adviser with the longest tenure (the
    smallest id of several), so the credits of a client add up to its value exactly.
    """
    values = client_values(adviser_tenure(fees), ltv, windows)
    names = ltv_columns(windows)

    def share(column: str):
        # In DECIMAL: a BIGINT product could overflow.
        return F.expr(f"(CAST({column} AS DECIMAL(20,0)) * tenure_units) div client_units")

    client = Window.partitionBy("client_id")
    first = F.row_number().over(client.orderBy(F.desc("tenure_units"), "adviser_id")) == 1
    split = values.select("client_id", "adviser_id", "tenure_units", first.alias("keeps_rest"), *names, *[share(c).alias(f"cut_{c}") for c in names])
    left = {c: F.when(F.col("keeps_rest"), F.col(c) - F.sum(f"cut_{c}").over(client)).otherwise(F.lit(0)) for c in names}
    credits = split.select("adviser_id", "tenure_units", *[(F.col(f"cut_{c}") + left[c]).alias(c) for c in names])
    sums = credits.groupBy("adviser_id").agg(
        F.count("*").alias("client_count"),
        F.sum("tenure_units").alias("tenure_units"),
        *[F.sum(c).alias(c) for c in names],
    )
    return sums.select(
        "adviser_id",
        "client_count",
        (F.col("tenure_units") / float(DAY_UNITS)).alias("tenure_days"),
        *[units_to_double(F.col(c)).alias(f"credited_{c}") for c in names],
    )
