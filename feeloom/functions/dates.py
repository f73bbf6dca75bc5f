"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_label(date: Column) -> Column:
    """'YYYY-MM', which sorts chronologically."""
    return F.date_format(date, "yyyy-MM")


def in_first_months(date: Column, first: Column, months: int) -> Column:
    """True inside the half-open window of calendar months from ``first`` (month ends clamp)."""
    return date < F.add_months(first, months)
