"""Invariants over generated ledgers."""

import datetime as dt
import tempfile
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feeloom.operators.checks import run_checks
from feeloom.operators.clients import client_dimension, client_ltv, client_ltv_single_pass
from feeloom.operators.reports import adviser_ltv, cohort_ltv
from feeloom.operators.staging import stage_fees
from feeloom.plans.refresh import Warehouse, build_staging
from feeloom.schemas import STAGED_COLUMNS, ltv_columns
from feeloom.sinks import overwrite_table
from tests.conftest import fee, rows

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

pennies = st.integers(-10**7, 10**7).map(lambda p: p / 100)
fees = st.builds(
    fee,
    st.sampled_from("ABCDE"),
    st.sampled_from(["x", "y", "z"]),
    st.dates(dt.date(2023, 12, 1), dt.date(2025, 3, 1)),
    pennies,
)
ledgers = st.lists(fees, min_size=1, max_size=40)


@FEW
@given(ledgers)
def test_totals_survive_every_layer(ledger, generated):
    staged = stage_fees(ledger(*generated, *generated[:3])).persist()
    dimension = client_dimension(staged)
    ltv = client_ltv(staged, dimension)
    total = sum({(c, a, d): Decimal(0) for c, _, a, d, _ in generated}.values(), Decimal(0))
    total += sum((Decimal(str(x)).quantize(Decimal("0.01")) for *_, x in set(generated)), Decimal(0))
    exact = F.sum(F.col("ltv_total").cast("decimal(18,2)"))
    assert ltv.agg(exact).first()[0] == total
    report = adviser_ltv(dimension, ltv)
    assert report.agg(F.sum(F.col("total_client_ltv_all_time").cast("decimal(18,2)"))).first()[0] == total
    clients = {c for c, *_ in generated}
    assert report.agg(F.sum("client_count")).first()[0] == len(clients)
    assert cohort_ltv(dimension, ltv).agg(F.sum("client_count")).first()[0] == len(clients)
    assert rows(client_ltv_single_pass(staged), "client_id", *ltv_columns()) == rows(ltv, "client_id", *ltv_columns())


@FEW
@given(ledgers)
def test_a_build_from_complete_rows_passes_the_checks_but_row_loss(ledger, generated):
    raw = ledger(*generated)
    staged = stage_fees(raw).persist()
    dimension = client_dimension(staged)
    ltv = client_ltv(staged, dimension).persist()
    results = run_checks({
        "raw_fees": raw, "stg_fees": staged, "dim_clients": dimension, "rpt_client_ltv": ltv,
        "rpt_cohort_ltv": cohort_ltv(dimension, ltv), "rpt_adviser_ltv": adviser_ltv(dimension, ltv),
    })
    assert results.where("violations > 0 AND check <> 'row count reconciliation'").isEmpty()


@settings(FEW, max_examples=4)
@given(ledgers, st.dates(dt.date(2023, 12, 1), dt.date(2025, 3, 1)))
def test_incremental_equals_full_when_nothing_is_late(spark, ledger, generated, cut):
    raw = ledger(*generated)
    store = Warehouse(tempfile.mkdtemp(prefix="feeloom-test-"))
    first = [f for f in generated if f[3] <= cut]
    overwrite_table(ledger(*first), store.path("fees"), ["fee_date"])
    build_staging(spark, store)
    overwrite_table(raw, store.path("fees"), ["fee_date"])
    build_staging(spark, store)
    assert rows(store.read(spark, "stg_fees"), *STAGED_COLUMNS) == rows(stage_fees(raw), *STAGED_COLUMNS)
