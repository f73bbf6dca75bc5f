"""A global rank that does not gather all rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bands per doubling of the value. A BIGINT spans 2 * 63 doublings, so there are at most 2 * 63 * 16 bands.
BANDS_PER_DOUBLING = 16


def value_band(value: str) -> Column:
    """A band number that rises with the BIGINT column ``value``; never NULL."""
    band = F.floor(F.signum(value) * F.log2(F.abs(value) + F.lit(1.0)) * BANDS_PER_DOUBLING)
    return F.coalesce(band, F.lit(0).cast("bigint"))


def rank_descending(df: DataFrame, value: str, out: str) -> DataFrame:
    """Add ``rank() over (order by value desc)`` for a BIGINT ``value``: ties share a rank and leave gaps.

    Equal values are counted first (map-side), so a value shared by many rows is one row from then on. The
    distinct values are cut into bands by a monotone function of the value; the rank of a value is the count
    in higher bands plus the count above it in its band. Only the band totals, at most 2016 rows, meet in one
    task or are broadcast. The banding steers the distribution only: any monotone function gives the same rank.
    """
    # The band is never NULL, so the joins add no IsNotNull filters and both uses of the counts share one exchange.
    counts = df.groupBy(value).agg(F.count("*").alias("_n")).withColumn("_band", value_band(value))
    preceding = (Window.unboundedPreceding, -1)

    higher_bands = Window.orderBy(F.desc("_band")).rowsBetween(*preceding)
    bands = (
        counts.groupBy("_band")
        .agg(F.sum("_n").alias("_in_band"))
        .select("_band", F.coalesce(F.sum("_in_band").over(higher_bands), F.lit(0)).alias("_above_band"))
    )
    higher_values = Window.partitionBy("_band").orderBy(F.desc(value)).rowsBetween(*preceding)
    ranks = (
        counts.withColumn("_above_value", F.coalesce(F.sum("_n").over(higher_values), F.lit(0)))
        .join(F.broadcast(bands), "_band")
        .select(value, (F.col("_above_band") + F.col("_above_value") + 1).alias(out))
    )
    return df.join(ranks, value)
