"""Joins and layouts in which one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Below this many rows a key is no burden to one task, whatever the size of the table.
ROWS_PER_TASK = 1_000_000
SHARES = 16


def heavy_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(``key``, parts) for every key with more rows than one part should hold: how many parts to cut it into.

    A part holds ``rows_per_task`` rows, or a sixteenth of a shuffle partition's even share if that is more, so there
    are at most 16 heavy keys, and 16 parts, for each shuffle partition: small enough to broadcast at any input. Counts are
    partial aggregates; null keys are not heavy, they join nothing.
    """
    spark = df.sparkSession
    shares = SHARES * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    share = F.ceil(df.agg(F.count("*").alias("n")).scalar() / F.lit(shares))
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    limit = F.greatest(F.lit(rows_per_task).cast("bigint"), share.cast("bigint"))
    return counts.where(F.col("n") > limit).select(key, F.ceil(F.col("n") / limit).cast("int").alias("parts"))


def salted_join(many: DataFrame, one: DataFrame, key: str, spread_by: list[str], heavy: DataFrame) -> DataFrame:
    """Inner join of ``many`` with ``one`` (a row for each ``key``), in two explicit steps.

    Rows of a heavy key (see ``heavy_keys``) get a salt from ``spread_by``, and its row of ``one`` is repeated for every
    salt; all other keys have the one salt 0. So no task holds more than a part of a key, whichever join is chosen.
    """
    heavy = F.broadcast(heavy.select(F.col(key).alias("heavy_key"), F.col("parts").alias("heavy_parts")))

    def marked(df: DataFrame) -> DataFrame:
        return df.join(heavy, F.col(key) == F.col("heavy_key"), "left")

    salt = F.when(F.col("heavy_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*spread_by), F.col("heavy_parts")).cast("int"))
    salted = marked(many).withColumn("salt", salt).drop("heavy_key", "heavy_parts")
    salts = F.sequence(F.lit(0), F.coalesce("heavy_parts", F.lit(1)) - 1)
    repeated = marked(one).withColumn("salt", F.explode(salts)).drop("heavy_key", "heavy_parts")
    return salted.join(repeated, [key, "salt"]).drop("salt")
