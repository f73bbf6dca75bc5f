import datetime as dt

import pytest
from pyspark.sql import functions as F

from feeloom.operators.clients import client_dimension, client_ltv, client_ltv_single_pass, last_touch
from feeloom.operators.ranking import rank_descending
from feeloom.operators.reports import adviser_ltv, cohort_ltv, top_advisers
from feeloom.operators.staging import stage_fees
from feeloom.schemas import adviser_ltv_schema, client_ltv_schema, cohort_ltv_schema, ltv_columns
from tests.conftest import fee, rows

CASES = {
    "month end clamps": (
        [("2025-01-31", 100.0), ("2025-02-27", 10.0), ("2025-02-28", 5.0)],
        (110.0, 115.0, 115.0, 115.0),
    ),
    "windows are half open": (
        [("2025-03-15", 20.0), ("2025-04-15", 7.0), ("2025-06-15", 3.0), ("2025-09-15", 2.0)],
        (20.0, 27.0, 30.0, 32.0),
    ),
    "refunds count": ([("2025-01-10", 50.0), ("2025-02-20", -60.0)], (50.0, -10.0, -10.0, -10.0)),
    "nothing in a window is zero": ([("2025-01-10", 5.0), ("2025-01-10", -5.0), ("2026-01-10", 1.0)], (0.0, 0.0, 0.0, 1.0)),
}


@pytest.mark.parametrize("case", CASES)
def test_client_ltv(ledger, case):
    fees, expected = CASES[case]
    staged = stage_fees(ledger(*[fee("A", "a1", d, x) for d, x in fees]))
    dimension = client_dimension(staged)
    for table in (client_ltv(staged, dimension), client_ltv_single_pass(staged)):
        assert table.columns == client_ltv_schema().fieldNames()
        assert rows(table, *ltv_columns()) == [expected]


def test_dimension(ledger):
    staged = stage_fees(ledger(fee("A", "late", "2025-02-01", 1.0), fee("A", "early", "2025-01-31", 1.0)))
    assert rows(client_dimension(staged), "*") == [("A", dt.date(2025, 1, 31), "early", "2025-01")]
    assert rows(last_touch(staged), "*") == [("A", dt.date(2025, 2, 1), "late")]


def test_first_touch_tie_goes_to_the_smaller_key_in_any_order(ledger):
    pair = [fee("G", "a1", "2025-01-05", 9.0), fee("G", "a2", "2025-01-05", 9.0)]
    winners = set()
    for order in (pair, pair[::-1]):
        staged = stage_fees(ledger(*order))
        smallest = staged.orderBy("fee_id").first()["adviser_id"]
        winners |= {smallest, client_dimension(staged).first()["first_adviser_id"]}
    assert len(winners) == 1


def built(staged, windows=(1, 3, 6)):
    dimension = client_dimension(staged)
    return dimension, client_ltv(staged, dimension, windows)


def test_rank_ties_leave_a_gap(ledger):
    staged = stage_fees(
        ledger(*[fee(c, a, "2025-01-05", x) for c, a, x in [("A", "x", 30.0), ("B", "y", 30.0), ("C", "z", 10.0)]])
    )
    report = adviser_ltv(*built(staged))
    assert report.columns == adviser_ltv_schema().fieldNames()
    assert rows(report, "adviser_id", "rank_by_ltv_6_month") == [("x", 1), ("y", 1), ("z", 3)]
    assert [r.adviser_id for r in top_advisers(report, 2).collect()] == ["x", "y"]


def test_even_cohort_median_is_an_observed_value(ledger):
    staged = stage_fees(ledger(*[fee(f"C{x}", "a", "2025-01-05", float(x)) for x in (10, 20, 30, 40)]))
    report = cohort_ltv(*built(staged))
    assert report.columns == cohort_ltv_schema().fieldNames()
    row = report.first()
    assert (row.client_count, row.median_ltv_6_month, row.avg_ltv_6_month) == (4, 20.0, 25.0)


def test_half_penny_means_round_away_from_zero(ledger):
    staged = stage_fees(
        ledger(
            fee("A", "a", "2025-01-05", 1.00),
            fee("B", "a", "2025-01-05", 1.01),
            fee("C", "b", "2025-02-05", -1.00),
            fee("D", "b", "2025-02-05", -1.01),
        )
    )
    report = cohort_ltv(*built(staged))
    assert rows(report, "cohort_month", "avg_ltv_6_month") == [("2025-01", 1.01), ("2025-02", -1.01)]


def test_windows_are_a_parameter(ledger):
    staged = stage_fees(ledger(fee("A", "a", "2025-01-05", 1.0), fee("A", "a", "2025-12-31", 2.0)))
    dimension, ltv = built(staged, (2, 12))
    assert rows(ltv, "ltv_2_month", "ltv_12_month", "ltv_total") == [(1.0, 3.0, 3.0)]
    assert adviser_ltv(dimension, ltv, (2, 12)).columns == adviser_ltv_schema((2, 12)).fieldNames()
    assert cohort_ltv(dimension, ltv, (2, 12)).columns == cohort_ltv_schema((2, 12)).fieldNames()


def test_published_types_match_the_declared_schemas(ledger):
    dimension, ltv = built(stage_fees(ledger(fee("A", "a", "2025-01-05", 1.0))))
    for table, schema in (
        (ltv, client_ltv_schema()),
        (cohort_ltv(dimension, ltv), cohort_ltv_schema()),
        (adviser_ltv(dimension, ltv), adviser_ltv_schema()),
    ):
        assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in schema]


def test_fractions_of_a_penny_round_per_client_first(ledger):
    staged = stage_fees(
        ledger(fee("A", "a", "2025-01-05", 0.005), fee("B", "a", "2025-01-05", 0.005)), scale=3
    )
    dimension = client_dimension(staged)
    ltv = client_ltv(staged, dimension, scale=3)
    assert rows(ltv, "ltv_total") == [(0.01,), (0.01,)]
    assert adviser_ltv(dimension, ltv).first()["total_client_ltv_all_time"] == 0.02


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_result_does_not_depend_on_partitioning(spark, partitions):
    from feeloom.sources.testdata import fee_ledger

    raw = fee_ledger(spark, "/root/testdata/sf0.001", "raw")
    baseline = adviser_ltv(*built(stage_fees(raw)))
    moved = adviser_ltv(*built(stage_fees(raw.repartition(partitions, F.rand(7)))))
    assert rows(moved, "*") == rows(baseline, "*")


@pytest.mark.parametrize("values", [
    [0, 0, 0, 5, -5, 7, 7, 1_000_000, -1_000_000, 2**62, -(2**62), 1, -1],
    list(range(-50, 50)) + [3] * 40,
    [9] * 30,
    [],
])
def test_rank_equals_a_plain_window(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v bigint")
    got = {r["id"]: r["r"] for r in rank_descending(df, "v", "r").collect()}
    assert got == {i: 1 + sum(o > v for o in values) for i, v in enumerate(values)}
