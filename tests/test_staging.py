import datetime as dt

import pytest
from pyspark.sql import functions as F

from feeloom.functions.keys import surrogate_key
from feeloom.operators.staging import drop_incomplete, since_lookback, skipped_by_lookback, stage_fees
from feeloom.schemas import STAGED_COLUMNS
from tests.conftest import fee, rows


def test_exact_copies_collapse(ledger):
    staged = stage_fees(ledger(*[fee("D", "a1", "2025-01-05", 1.0)] * 3))
    assert staged.columns == STAGED_COLUMNS
    assert staged.count() == 1


def test_same_day_other_amount_stays(ledger):
    staged = stage_fees(ledger(fee("E", "a1", "2025-01-05", 1.0), fee("E", "a1", "2025-01-05", 2.0)))
    assert staged.select("fee_id").distinct().count() == 2


def test_two_ninos_share_a_key(ledger):
    raw = ledger(fee("F", "a1", "2025-01-05", 1.0, "N2"), fee("F", "a1", "2025-01-05", 1.0, "N1"))
    staged = stage_fees(raw)
    assert staged.count() == 2
    assert staged.select("fee_id").distinct().count() == 1
    assert rows(stage_fees(raw, dedup_on="key"), "client_nino") == [("N1",)]
    with pytest.raises(ValueError):
        stage_fees(raw, dedup_on="nino")


@pytest.mark.parametrize("position", range(5))
def test_a_null_anywhere_drops_the_row(ledger, position):
    good = fee("H", "a1", "2025-01-05", 1.0)
    bad = tuple(None if i == position else v for i, v in enumerate(good))
    assert stage_fees(ledger(good, bad)).count() == 1
    assert drop_incomplete(ledger(bad)).count() == 0


def test_negative_zero_and_refunds(ledger):
    staged = stage_fees(
        ledger(fee("Z", "a1", "2025-01-05", 0.0), fee("Z", "a1", "2025-01-05", -0.0), fee("Z", "a1", "2025-01-05", -7.0))
    )
    assert rows(staged, "fee_amount") == [(-7.0,), (0.0,)]


@pytest.mark.parametrize("amount", [1.005, float("nan"), float("inf"), 1e14])
def test_an_amount_that_is_not_exact_fails(ledger, amount):
    with pytest.raises(Exception, match="not exact at 2 decimals"):
        stage_fees(ledger(fee("P", "a1", "2025-01-05", amount))).collect()


def test_a_wider_scale_accepts_fractions_of_a_penny(ledger):
    staged = stage_fees(ledger(fee("P", "a1", "2025-01-05", 1.0051)), scale=4)
    assert rows(staged, "fee_amount") == [(1.0051,)]


def test_lookback_bound_is_inclusive(ledger):
    raw = ledger(*[fee("L", "a1", d, 1.0) for d in ("2025-06-06", "2025-06-07", "2025-06-11")])
    kept = since_lookback(raw, dt.date(2025, 6, 10))
    assert rows(kept, F.col("fee_date").cast("string")) == [("2025-06-07",), ("2025-06-11",)]
    assert since_lookback(raw, None).count() == 3


def test_skipped_rows_are_counted_after_a_future_dated_fee(ledger):
    raw = ledger(fee("S", "a1", "2099-01-01", 1.0), fee("S", "a1", "2025-06-11", 2.0), fee("S", "a1", "2025-06-12", 3.0))
    staged = stage_fees(raw.where("fee_amount < 3"))
    assert rows(skipped_by_lookback(raw, staged, dt.date(2099, 1, 1)), "fee_amount") == [(3.0,)]
    assert skipped_by_lookback(raw, staged, None).count() == 0


def test_key_separates_columns_and_sees_nulls(spark):
    frame = spark.createDataFrame([("a-b", "c"), ("a", "b-c"), ("a", None), (None, "a")], "x string, y string")
    assert frame.select(surrogate_key("x", "y").alias("k")).distinct().count() == 4


def test_staging_is_idempotent(ledger):
    raw = ledger(*[fee("I", f"a{i % 3}", dt.date(2025, 1, 1 + i % 9), float(i % 5)) for i in range(60)])
    once = stage_fees(raw)
    assert rows(stage_fees(once), *STAGED_COLUMNS) == rows(once, *STAGED_COLUMNS)
