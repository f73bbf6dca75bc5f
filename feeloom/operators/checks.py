"""Data-quality checks. Each returns the violating rows; no rows means the check passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feeloom.functions.dates import in_first_months
from feeloom.functions.money import MONEY_SCALE, rounded_quotient, to_units, units_to_double
from feeloom.operators.clients import daily_units
from feeloom.schemas import LTV_WINDOWS, ltv_column, ltv_columns

MONEY_TOLERANCE = 0.01
MAX_LOST_FRACTION = 0.05


class ChecksFailed(AssertionError):
    """At least one check returned rows."""


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` that occur more than once (NULLs aside), with their row count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .where("n_records > 1")
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value in ``column``."""
    return df.where(F.col(column).isNull())


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_rows) for all ``columns`` from one aggregate pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_rows")


def beyond_tolerance(pairs: Sequence[tuple[Column, Column]], tolerance: float = MONEY_TOLERANCE) -> Column:
    """True if any pair of money values differs by more than ``tolerance``; compared in exact minor units."""
    limit = to_units(F.lit(tolerance))
    return reduce(or_, [F.abs(to_units(a) - to_units(b)) > limit for a, b in pairs])


def one_nino_per_client(fees: DataFrame) -> DataFrame:
    """Clients with more than one national insurance number."""
    return (
        fees.groupBy("client_id").agg(F.count_distinct("client_nino").alias("nino_count")).where("nino_count > 1")
    )


def financial_reconciliation(
    fees: DataFrame, ltv: DataFrame, scale: int = MONEY_SCALE, guard_empty: bool = False
) -> DataFrame:
    """One row if the fee total and the reported all-time total differ by more than the tolerance.

    Totals of empty tables are NULL and compare as passing; ``guard_empty`` reports them.
    """
    reported = ltv.agg(F.sum(to_units(F.col("ltv_total"))).alias("reported"))
    staged = F.sum(to_units(F.col("fee_amount"), scale)).alias("staged")
    totals = fees.agg(staged).select("staged", reported.scalar().alias("published"))
    failed = totals_differ(F.col("staged"), F.col("published"), scale)
    if guard_empty:
        failed = failed | F.col("staged").isNull() | F.col("published").isNull()
    return totals.where(failed).select(
        units_to_double(F.col("staged"), scale).alias("staging_total_fees"),
        units_to_double(F.col("published")).alias("reporting_total_fees"),
        units_to_double(_apart(F.col("staged"), F.col("published"), scale), scale).alias("discrepancy"),
    )


def _apart(staged: Column, published: Column, scale: int) -> Column:
    """Staged total minus published total (in pennies), in units of ``scale``."""
    return staged.cast("decimal(20,0)") - published.cast("decimal(20,0)") * F.lit(10 ** (scale - MONEY_SCALE))


def totals_differ(staged: Column, published: Column, scale: int = MONEY_SCALE) -> Column:
    """Whether two exact totals differ by more than the tolerance; no double is involved, however large they are.

    Published values are rounded to pennies, staged ones may be finer: the published total is as exact as its pennies.
    """
    limit = round(MONEY_TOLERANCE * 10**scale)
    return F.abs(_apart(staged, published, scale)) > limit


def _too_many_lost(max_lost: float) -> Column:
    removed = F.col("raw_count") - F.col("staging_count")
    return (removed < 0) | (removed > F.col("raw_count") * F.lit(max_lost))


def row_count_reconciliation(
    raw: DataFrame, fees: DataFrame, max_lost: float = MAX_LOST_FRACTION
) -> DataFrame:
    """One row if staging has more rows than raw, or lost more than ``max_lost`` of them."""
    staged = fees.agg(F.count("*").alias("n"))
    counts = raw.agg(F.count("*").alias("raw_count")).select("raw_count", staged.scalar().alias("staging_count"))
    removed = F.col("raw_count") - F.col("staging_count")
    # Hundredths of a per cent, rounded once.
    share = rounded_quotient(removed.cast("decimal(20,0)") * 10000, F.nullif(F.col("raw_count"), F.lit(0)))
    return counts.select(
        "raw_count",
        "staging_count",
        removed.alias("rows_removed"),
        share.alias("pct_removed"),
    ).where(_too_many_lost(max_lost))


def expected_ltv(fees: DataFrame, windows: Sequence[int] = LTV_WINDOWS, scale: int = MONEY_SCALE) -> DataFrame:
    """Lifetime values recomputed from the fees alone, with the first date taken by min() per client."""
    # One scan: the first date comes from the daily sums, still without the dimension.
    first = F.min("fee_date").over(Window.partitionBy("client_id"))
    days = daily_units(fees, "client_id", scale=scale).withColumn("first_seen", first)
    inside = {ltv_column(n): in_first_months(F.col("fee_date"), F.col("first_seen"), n) for n in windows}
    sums = [F.sum(F.when(test, F.col("units")).otherwise(F.lit(0))).alias(name) for name, test in inside.items()]
    totals = days.groupBy("client_id", "first_seen").agg(*sums, F.sum("units").alias("ltv_total"))
    return totals.select(
        "client_id",
        *[units_to_double(F.col(c), scale).alias(f"expected_{c}") for c in ltv_columns(windows)],
    )


def ltv_recomputation(
    fees: DataFrame, ltv: DataFrame, windows: Sequence[int] = LTV_WINDOWS, scale: int = MONEY_SCALE
) -> DataFrame:
    """Clients whose reported values differ from expected_ltv(). A client absent from the report is not seen;
    reconcile_ltv() in the monitoring operators is the full-outer form.
    """
    names = ltv_columns(windows)
    actual = ltv.select("client_id", *[F.col(c).alias(f"actual_{c}") for c in names])
    both = expected_ltv(fees, windows, scale).join(actual, "client_id")
    ordered = [c for name in names for c in (f"expected_{name}", f"actual_{name}")]
    pairs = [(F.col(f"expected_{c}"), F.col(f"actual_{c}")) for c in names]
    return both.where(beyond_tolerance(pairs)).select("client_id", *ordered)


def non_empty(df: DataFrame, name: str) -> int:
    """Row count of a loaded table (from file footers); raises if there are none."""
    rows = df.count()
    if rows == 0:
        raise ValueError(f"{name} has 0 rows after load")
    return rows


# Key and required columns per table of one build.
UNIQUE_COLUMNS = {
    "stg_fees": "fee_id",
    "dim_clients": "client_id",
    "rpt_client_ltv": "client_id",
    "rpt_cohort_ltv": "cohort_month",
    "rpt_adviser_ltv": "adviser_id",
}
REQUIRED_COLUMNS = {
    "stg_fees": ["fee_id", "client_id", "client_nino", "adviser_id", "fee_date", "fee_amount"],
    "dim_clients": ["client_id", "first_fee_date", "first_adviser_id", "cohort_month"],
    "rpt_client_ltv": ["client_id"],
    "rpt_cohort_ltv": ["cohort_month"],
    "rpt_adviser_ltv": ["adviser_id"],
}


def _staging_profile(tables: Mapping[str, DataFrame], scale: int) -> DataFrame:
    """Null counts, financial and row-count reconciliation of staging, from one pass over it."""
    fees, columns = tables["stg_fees"], REQUIRED_COLUMNS["stg_fees"]
    raw = tables["raw_fees"].agg(F.count("*").alias("n"))
    reported = tables["rpt_client_ltv"].agg(F.sum(to_units(F.col("ltv_total"))).alias("u"))
    profile = fees.agg(
        F.count("*").alias("staging_count"),
        F.sum(to_units(F.col("fee_amount"), scale)).alias("staged"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    ).select("*", raw.scalar().alias("raw_count"), reported.scalar().alias("published"))
    staged, published = F.col("staged"), F.col("published")
    unbalanced = totals_differ(staged, published, scale) | staged.isNull() | published.isNull()
    results = {f"not_null stg_fees.{c}": F.col(f"null_{c}") for c in columns}
    results["financial reconciliation"] = unbalanced.cast("bigint")
    results["row count reconciliation"] = _too_many_lost(MAX_LOST_FRACTION).cast("bigint")
    rows = [F.struct(F.lit(n).alias("check"), v.alias("violations")) for n, v in results.items()]
    return profile.select(F.inline(F.array(*rows)))


def run_checks(
    tables: Mapping[str, DataFrame], windows: Sequence[int] = LTV_WINDOWS, scale: int = MONEY_SCALE
) -> DataFrame:
    """(check, violations) for every check over one build; ``tables`` maps model names, with ``raw_fees``."""

    def counted(name: str, violations: DataFrame) -> DataFrame:
        return violations.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")

    fees, ltv = tables["stg_fees"], tables["rpt_client_ltv"]
    results = [_staging_profile(tables, scale)]
    for table, column in UNIQUE_COLUMNS.items():
        results.append(counted(f"unique {table}.{column}", unique(tables[table], column)))
    for table, columns in REQUIRED_COLUMNS.items():
        if table != "stg_fees":
            nulls = null_counts(tables[table], columns)
            label = F.concat(F.lit(f"not_null {table}."), F.col("column_name"))
            results.append(nulls.select(label.alias("check"), F.col("null_rows").alias("violations")))
    results.append(counted("one nino per client", one_nino_per_client(fees)))
    results.append(counted("ltv recomputation", ltv_recomputation(fees, ltv, windows, scale)))
    return reduce(DataFrame.unionAll, results)


def enforce(results: DataFrame) -> DataFrame:
    """Evaluate run_checks() once (a row per check) and return the outcome; raise ChecksFailed on any violation."""
    outcome = results.collect()
    failed = [f"{r['check']}: {r['violations']}" for r in outcome if r["violations"]]
    if failed:
        raise ChecksFailed("; ".join(failed))
    return results.sparkSession.createDataFrame(outcome, results.schema)
