"""Exact money arithmetic.

Amounts are DOUBLE at the table boundary. Inside a plan they are BIGINT minor units (pennies at scale 2):
integer sums do not depend on row order or partitioning, and a BIGINT sum keeps its buffer in the fixed part
of the row, so the aggregate stays a HashAggregate under whole-stage codegen. A sum past 2**63 raises under
ANSI mode (the default).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_SCALE = 2


def to_units(amount: Column, scale: int = MONEY_SCALE, strict: bool = False) -> Column:
    """Minor units of ``amount``; with ``strict``, fail the job on an amount not exact at ``scale`` decimals."""
    factor = float(10**scale)
    amount = amount.cast("double")
    units = F.rint(amount * factor)
    if strict:
        # Dividing back gives the double nearest to the decimal, so equality means nothing was lost. From 2**53
        # units on a double no longer tells neighbours apart; NaN compares as larger than any number.
        exact = ((units / factor) == amount) & (F.abs(units) < float(2**53))
        message = F.concat(F.lit(f"amount is not exact at {scale} decimals: "), amount.cast("string"))
        units = F.when(exact, units).otherwise(F.raise_error(message).cast("double"))
    return units.cast("bigint")


def from_units(units: Column, scale: int = MONEY_SCALE) -> Column:
    """Minor units as an exact decimal."""
    exact = units.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-scale))
    return exact.cast(f"decimal({20 + scale},{scale})")


def units_to_double(units: Column, scale: int = MONEY_SCALE) -> Column:
    """Minor units rounded half away from zero to 2 decimals, as the public DOUBLE."""
    exact = from_units(units, scale)
    return (exact if scale <= 2 else F.round(exact, 2)).cast("double")


def exact_mean(units_sum: Column, count: Column, scale: int = MONEY_SCALE) -> Column:
    """Mean rounded once to 2 decimals, half away from zero: integer division of the exact sum."""
    return rounded_quotient(units_sum, count.cast("decimal(20,0)") * F.lit(10 ** (scale - 2)))


def rounded_quotient(units: Column, parts: Column) -> Column:
    """Hundredths ``units`` / ``parts`` as a DOUBLE with 2 decimals, rounded half away from zero in integers."""
    wide, parts = units.cast("decimal(20,0)"), parts.cast("decimal(18,0)")
    hundredths = F.call_function("div", (F.abs(wide) * 2 + parts).cast("decimal(38,0)"), parts * 2)
    return F.when(wide < 0, -hundredths).otherwise(hundredths).cast("double") / F.lit(100.0)
