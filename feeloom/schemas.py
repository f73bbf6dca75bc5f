"""Declared table schemas. Public money columns are DOUBLE; arithmetic inside uses exact minor units."""

from __future__ import annotations

from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

LTV_WINDOWS = (1, 3, 6)
PII_KEY = "contains_pii"

_CLIENT = StructField("client_id", StringType(), False)
_NINO = StructField("client_nino", StringType(), False, {PII_KEY: True})
_ADVISER = StructField("adviser_id", StringType(), False)
_DATE = StructField("fee_date", DateType(), False)
_AMOUNT = StructField("fee_amount", DoubleType(), False)

FEE_SCHEMA = StructType([_CLIENT, _NINO, _ADVISER, _DATE, _AMOUNT])
STAGED_SCHEMA = StructType([StructField("fee_id", StringType(), False), *FEE_SCHEMA.fields])
CLIENT_SCHEMA = StructType(
    [
        _CLIENT,
        StructField("first_fee_date", DateType(), False),
        StructField("first_adviser_id", StringType(), False),
        StructField("cohort_month", StringType(), False),
    ]
)

FEE_COLUMNS = FEE_SCHEMA.fieldNames()
STAGED_COLUMNS = STAGED_SCHEMA.fieldNames()
# The columns that identify one fee; the national insurance number is an attribute, not part of the key.
FEE_KEY = ["client_id", "adviser_id", "fee_date", "fee_amount"]


def ltv_column(months: int) -> str:
    return f"ltv_{months}_month"


def ltv_columns(windows=LTV_WINDOWS) -> list[str]:
    return [ltv_column(n) for n in windows] + ["ltv_total"]


def client_ltv_schema(windows=LTV_WINDOWS) -> StructType:
    return StructType(
        [_CLIENT, StructField("first_fee_date", DateType(), False)]
        + [StructField(c, DoubleType(), False) for c in ltv_columns(windows)]
    )


def cohort_ltv_schema(windows=LTV_WINDOWS) -> StructType:
    money = [f"avg_{ltv_column(n)}" for n in windows]
    money += [f"total_{ltv_column(n)}" for n in windows]
    money += [f"median_{ltv_column(max(windows))}"]
    return StructType(
        [StructField("cohort_month", StringType(), False), StructField("client_count", LongType(), False)]
        + [StructField(c, DoubleType(), False) for c in money]
    )


def adviser_ltv_schema(windows=LTV_WINDOWS) -> StructType:
    longest = ltv_column(max(windows))
    money = [f"total_client_{ltv_column(n)}" for n in windows]
    money += ["total_client_ltv_all_time", f"avg_client_{longest}"]
    return StructType(
        [_ADVISER, StructField("client_count", LongType(), False)]
        + [StructField(c, DoubleType(), False) for c in money]
        + [StructField(f"rank_by_{longest}", LongType(), False)]
    )
