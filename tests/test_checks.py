import datetime as dt

import pytest
from pyspark.sql import functions as F

from feeloom.operators import checks
from feeloom.operators.clients import client_dimension, client_ltv
from feeloom.operators.reports import adviser_ltv, cohort_ltv
from feeloom.operators.staging import stage_fees
from tests.conftest import fee, rows


@pytest.fixture(scope="module")
def build(ledger):
    raw = ledger(
        *[fee(f"C{i % 7}", f"a{i % 3}", dt.date(2025, 1, 1) + dt.timedelta(days=11 * i), 10.0 + i) for i in range(40)]
    )
    staged = stage_fees(raw)
    dimension = client_dimension(staged)
    ltv = client_ltv(staged, dimension)
    tables = {
        "raw_fees": raw,
        "stg_fees": staged,
        "dim_clients": dimension,
        "rpt_client_ltv": ltv,
        "rpt_cohort_ltv": cohort_ltv(dimension, ltv),
        "rpt_adviser_ltv": adviser_ltv(dimension, ltv),
    }
    return {name: df.persist() for name, df in tables.items()}


def failing(tables):
    """Names of the checks that fail the run."""
    with pytest.raises(checks.ChecksFailed) as failure:
        checks.enforce(checks.run_checks(tables))
    return {part.rsplit(":", 1)[0] for part in str(failure.value).split("; ")}


def test_a_clean_build_passes_all_checks(build):
    results = checks.run_checks(build)
    assert results.count() == 22
    assert rows(checks.enforce(results), "*") == rows(results, "*")


def blank(df, column):
    return df.withColumn(column, F.when(F.col("client_id") != "C0", F.col(column)))


FAULTS = {
    "unique stg_fees.fee_id": ("stg_fees", lambda df: df.unionAll(df.limit(1))),
    "unique dim_clients.client_id": ("dim_clients", lambda df: df.unionAll(df.limit(1))),
    "unique rpt_client_ltv.client_id": ("rpt_client_ltv", lambda df: df.unionAll(df.limit(1))),
    "unique rpt_cohort_ltv.cohort_month": ("rpt_cohort_ltv", lambda df: df.unionAll(df.limit(1))),
    "unique rpt_adviser_ltv.adviser_id": ("rpt_adviser_ltv", lambda df: df.unionAll(df.limit(1))),
    "not_null stg_fees.client_nino": ("stg_fees", lambda df: blank(df, "client_nino")),
    "not_null stg_fees.adviser_id": ("stg_fees", lambda df: blank(df, "adviser_id")),
    "not_null dim_clients.first_fee_date": ("dim_clients", lambda df: blank(df, "first_fee_date")),
    "not_null dim_clients.cohort_month": ("dim_clients", lambda df: blank(df, "cohort_month")),
    "one nino per client": (
        "stg_fees",
        lambda df: df.withColumn("client_nino", F.when(F.col("adviser_id") == "a0", "other").otherwise("same")),
    ),
    "financial reconciliation": ("rpt_client_ltv", lambda df: df.withColumn("ltv_total", F.col("ltv_total") + 1)),
    "row count reconciliation": ("raw_fees", lambda df: df.unionAll(df)),
    "ltv recomputation": ("rpt_client_ltv", lambda df: df.withColumn("ltv_1_month", F.col("ltv_1_month") + 0.02)),
}


@pytest.mark.parametrize("check", FAULTS)
def test_each_fault_trips_its_check(build, check):
    table, spoil = FAULTS[check]
    tables = {**build, table: spoil(build[table])}
    failed = failing(tables)
    assert check in failed
    # A spoiled amount or duplicate can rightly trip the reconciliations too, but never an unrelated check.
    related = {"financial reconciliation", "row count reconciliation", "ltv recomputation"}
    assert failed <= {check} | related


@pytest.mark.parametrize("raw, staged, fails", [(100, 95, False), (100, 94, True), (100, 101, True), (0, 0, False)])
def test_row_count_limits(spark, raw, staged, fails):
    violations = checks.row_count_reconciliation(spark.range(raw), spark.range(staged)).collect()
    assert bool(violations) == fails
    if fails:
        assert violations[0]["rows_removed"] == raw - staged
        assert violations[0]["pct_removed"] == float(raw - staged)


@pytest.mark.parametrize("reported, fails", [(100.01, False), (100.02, True), (99.98, True)])
def test_money_tolerance(spark, reported, fails):
    staged = spark.createDataFrame([(60.0,), (40.0,)], "fee_amount double")
    report = spark.createDataFrame([(reported,)], "ltv_total double")
    violations = checks.financial_reconciliation(staged, report).collect()
    assert bool(violations) == fails
    if fails:
        assert violations[0]["discrepancy"] == round(100.0 - reported, 2)


def test_empty_layers_pass_silently_unless_guarded(spark):
    staged = spark.createDataFrame([], "fee_amount double")
    report = spark.createDataFrame([], "ltv_total double")
    assert checks.financial_reconciliation(staged, report).isEmpty()
    assert checks.financial_reconciliation(staged, report, guard_empty=True).count() == 1


def test_unique_ignores_nulls_and_not_null_finds_them(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "k string")
    assert rows(checks.unique(df, "k"), "*") == [("a", 2)]
    assert checks.not_null(df, "k").count() == 2


def test_recomputation_misses_absent_clients(build):
    report = build["rpt_client_ltv"].where("client_id <> 'C0'")
    assert checks.ltv_recomputation(build["stg_fees"], report).isEmpty()
