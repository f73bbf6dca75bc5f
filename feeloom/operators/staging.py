"""Raw ledger -> deduplicated, keyed staging rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeloom.functions.keys import fee_key
from feeloom.functions.money import MONEY_SCALE, to_units
from feeloom.schemas import FEE_COLUMNS, FEE_KEY, STAGED_COLUMNS

LOOKBACK_DAYS = 3


def drop_incomplete(df: DataFrame, columns: Sequence[str] = FEE_COLUMNS) -> DataFrame:
    """Rows with a value in every one of ``columns``."""
    return df.where(reduce(and_, [F.col(c).isNotNull() for c in columns]))


def since_lookback(
    df: DataFrame, bound: dt.date | None, days: int = LOOKBACK_DAYS, column: str = "fee_date"
) -> DataFrame:
    """Rows dated no earlier than ``bound`` minus ``days``, inclusive. No bound keeps everything.

    The bound is a literal, so on a date-partitioned table the filter prunes partitions.
    """
    if bound is None:
        return df
    return df.where(F.col(column) >= F.date_sub(F.lit(bound), days))


def stage_fees(
    raw: DataFrame,
    bound: dt.date | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    dedup_on: str = "row",
    scale: int = MONEY_SCALE,
    extra_columns: Sequence[str] = (),
    lay_out_by: str | None = None,
) -> DataFrame:
    """Complete rows, each distinct row once, with its ``fee_id``.

    ``dedup_on='row'``: rows that agree on the key but not on the national insurance number both stay, and the
    uniqueness check reports them. ``'key'``: one row per key, the smallest number kept. An amount with more
    than ``scale`` decimals fails the job.

    Copies collapse map-side before the shuffle, however many there are of one row; the key is hashed after
    it, so its 32 characters are never shuffled here. ``lay_out_by`` gathers the values of a column, as the writers do for a
    table partitioned by it, but ahead of the key: tell the writer that the rows are ``laid_out``.
    """
    fees = drop_incomplete(since_lookback(raw, bound, lookback_days)).select(*FEE_COLUMNS, *extra_columns)
    if dedup_on == "row":
        fees = fees.distinct()
    elif dedup_on == "key":
        others = [c for c in fees.columns if c not in FEE_KEY]
        fees = fees.groupBy(*FEE_KEY).agg(*[F.min(c).alias(c) for c in others])
    else:
        raise ValueError(f"dedup_on must be 'row' or 'key', not {dedup_on!r}")
    if lay_out_by is not None:
        fees = fees.hint("rebalance", lay_out_by)
    exact = (to_units(F.col("fee_amount"), scale, strict=True) / F.lit(float(10**scale))).alias("fee_amount")
    return fees.withColumn("fee_amount", exact).select(
        fee_key(scale).alias("fee_id"), *STAGED_COLUMNS[1:], *extra_columns
    )


def skipped_by_lookback(
    raw: DataFrame, staged: DataFrame, bound: dt.date | None, lookback_days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Distinct complete raw rows older than the lookback bound that staging does not hold."""
    before = F.lit(False) if bound is None else F.col("fee_date") < F.date_sub(F.lit(bound), lookback_days)
    old = stage_fees(raw.where(before))
    # The key holds the date: staging before the bound is all that is read of it.
    held = staged.where(before).select("fee_date", "fee_id")
    return old.join(held, ["fee_date", "fee_id"], "left_anti").select(*old.columns)
