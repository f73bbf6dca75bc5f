import datetime as dt

import pytest
from pyspark.sql import functions as F

from feeloom.operators import attribution, monitoring, privacy
from feeloom.operators.clients import client_dimension, client_ltv
from feeloom.operators.staging import stage_fees
from feeloom.schemas import CLIENT_SCHEMA, FEE_SCHEMA, STAGED_SCHEMA
from tests.conftest import fee, rows


def test_freshness(spark, ledger):
    raw = ledger(fee("A", "a", "2025-01-05", 1.0), fee("A", "a", "2025-01-02", 1.0))
    assert rows(monitoring.freshness(raw, dt.date(2025, 1, 8)), "age_days", "stale") == [(3, False)]
    assert rows(monitoring.freshness(raw, dt.date(2025, 1, 9)), "age_days", "stale") == [(4, True)]
    assert monitoring.freshness(raw).first()["stale"]
    assert monitoring.freshness(raw.limit(0)).first()["stale"]


def test_newest_file(spark, ledger, tmp_path):
    ledger(fee("A", "a", "2025-01-05", 1.0)).write.parquet(str(tmp_path / "t"))
    newest = monitoring.newest_file(spark.read.parquet(str(tmp_path / "t"))).first()["newest_file"]
    assert abs((newest - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) < 86400


def test_an_unusual_day_stands_out(ledger):
    days = [dt.date(2025, 1, 1) + dt.timedelta(days=i) for i in range(30)]
    raw = ledger(*[fee("A", "a", d, 500.0 if i == 20 else 10.0 + i % 3) for i, d in enumerate(days)])
    found = monitoring.daily_anomalies(raw, days=14).where("anomalous")
    assert rows(found, "fee_date") == [(days[20],)]


def test_counts_and_their_changes(spark, ledger):
    raw = ledger(fee("A", "a", "2025-01-05", 1.0), fee("A", "a", "2025-01-05", 1.0))
    assert rows(monitoring.layer_counts({"raw": raw, "staged": stage_fees(raw)}), "*") == [("raw", 2), ("staged", 1)]
    history = spark.createDataFrame(
        [(1, "raw", 100), (2, "raw", 110), (3, "raw", 50), (1, "dim", 5), (2, "dim", 5)], "run_id int, table string, rows bigint"
    )
    assert rows(monitoring.count_changes(history), "*") == [(3, "raw", 50, 110)]


def test_recorded_counts(spark, ledger, tmp_path):
    history, raw = str(tmp_path / "history"), ledger(*[fee("A", "a", "2025-01-05", float(i)) for i in range(5)])
    for run, rows_kept in (("r1", 5), ("r2", 1), ("r2", 2)):
        monitoring.record_counts({"raw": raw.where(F.col("fee_amount") < rows_kept)}, history, run)
    recorded = spark.read.parquet(history)
    assert rows(recorded, "run_id", "rows") == [("r1", 5), ("r2", 2)]
    assert rows(monitoring.count_changes(recorded), "run_id", "previous_rows") == [("r2", 5)]


def test_rules(ledger):
    raw = ledger(fee("A", "a", "2025-01-05", 1.0), fee(None, "a", "2025-01-05", 200.0), fee("A", "b", "2025-01-05", 3.0))
    rules = [monitoring.Rule("client_id", "not_null"), monitoring.Rule("fee_amount", "between", 0.0, 100.0), monitoring.Rule("client_id", "unique")]
    assert rows(monitoring.rule_violations(raw, rules), "*") == [
        ("between fee_amount", 1), ("not_null client_id", 1), ("unique client_id", 1),
    ]
    with pytest.raises(ValueError):
        monitoring.rule_violations(raw, [monitoring.Rule("client_id", "shiny")])


def test_drift_and_contract(spark, ledger):
    raw = ledger(fee("A", "a", "2025-01-05", 1.0))
    assert monitoring.schema_drift(spark, raw.schema, FEE_SCHEMA).isEmpty()
    drifted = raw.drop("client_nino").withColumn("extra", F.lit(1)).withColumn("fee_amount", F.lit("1"))
    report = monitoring.schema_drift(spark, drifted.schema, FEE_SCHEMA)
    assert rows(report, "column_name", "drift") == [("client_nino", "missing"), ("extra", "extra"), ("fee_amount", "type")]
    with pytest.raises(ValueError, match="client_nino .missing"):
        monitoring.enforce_contract(drifted, FEE_SCHEMA)
    shuffled = raw.select(*reversed(raw.columns))
    assert monitoring.enforce_contract(shuffled, FEE_SCHEMA).columns == FEE_SCHEMA.fieldNames()


def test_matured_clients(spark):
    clients = spark.createDataFrame([("A", dt.date(2025, 1, 31)), ("B", dt.date(2025, 2, 1))], "client_id string, first_fee_date date")
    assert rows(monitoring.matured_clients(clients, dt.date(2025, 7, 31)), "client_id") == [("A",)]


def test_reconciliation_sees_absent_clients(ledger):
    staged = stage_fees(ledger(*[fee(c, "a", "2025-01-05", 1.0) for c in "ABC"]))
    ltv = client_ltv(staged, client_dimension(staged))
    spoiled = ltv.where("client_id <> 'A'").withColumn("ltv_total", F.when(F.col("client_id") == "B", 9.0).otherwise(1.0))
    result = monitoring.reconcile_ltv(staged.where("client_id <> 'C'"), spoiled)
    assert rows(result, "client_id", "status") == [("A", "missing in report"), ("B", "differs"), ("C", "missing in fees")]


def test_compare_builds(ledger):
    before = {"stg": ledger(fee("A", "a", "2025-01-05", 1.5)), "gone": ledger()}
    after = {"stg": ledger(fee("A", "a", "2025-01-05", 1.5), fee("B", "a", "2025-01-05", 2.0))}
    changes = monitoring.compare_builds(before, after, {"stg": "fee_amount"}).collect()
    assert {(r["table"], r["measure"]): r["difference"] for r in changes} == {
        ("stg", "rows"): 1.0, ("stg", "fee_amount"): 2.0, ("gone", "rows"): None,
    }


def test_trace_reaches_the_file(spark, ledger, tmp_path):
    ledger(fee("A", "a", "2025-01-05", 1.0), fee("A", "a", "2025-01-05", 1.0), fee("B", "a", "2025-01-05", 1.0)).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw")).withColumn("source_file", F.col("_metadata.file_path"))
    staged = stage_fees(raw)
    traced = monitoring.trace_to_raw(raw, staged, client_dimension(staged).where("client_id = 'A'"))
    assert rows(traced, "client_id") == [("A",), ("A",)]
    assert all(r["source_file"].endswith(".parquet") for r in traced.collect())


def test_time_weighted_by_hand(ledger):
    """x serves 1 to 11 January (10 days), y 11 January and the last fee day (1 day each... 11 to 16, then one)."""
    staged = stage_fees(ledger(fee("A", "x", "2025-01-01", 50.0), fee("A", "y", "2025-01-11", 20.0), fee("A", "y", "2025-01-16", 10.0)))
    assert rows(attribution.adviser_tenure(staged), "*") == [("A", "x", 10_000_000, 16_000_000), ("A", "y", 6_000_000, 16_000_000)]
    ltv = client_ltv(staged, client_dimension(staged))
    assert rows(attribution.time_weighted_ltv(staged, ltv), "adviser_id", "client_count", "credited_ltv_total") == [
        ("x", 1, 50.0), ("y", 1, 30.0),
    ]


def test_advisers_of_one_day_share_it_and_pennies_add_up(ledger):
    """x, y and z meet on the only day: a third of a day each; of ten pennies the first keeps the one left over."""
    staged = stage_fees(ledger(fee("A", "x", "2025-01-01", 0.04), fee("A", "y", "2025-01-01", 0.03), fee("A", "z", "2025-01-01", 0.03)))
    ltv = client_ltv(staged, client_dimension(staged))
    assert rows(attribution.time_weighted_ltv(staged, ltv), "adviser_id", "client_count", "tenure_days", "credited_ltv_total") == [
        ("x", 1, 0.333333, 0.04), ("y", 1, 0.333333, 0.03), ("z", 1, 0.333333, 0.03),
    ]


def test_fee_weighted_and_last_touch_by_hand(ledger):
    staged = stage_fees(ledger(fee("A", "x", "2025-01-01", 50.0), fee("A", "y", "2025-03-11", 20.0), fee("B", "y", "2025-01-16", 10.0)))
    dimension = client_dimension(staged)
    ltv = client_ltv(staged, dimension)
    columns = ["adviser_id", "client_count", "credited_ltv_1_month", "credited_ltv_total"]
    assert rows(attribution.fee_weighted_ltv(staged, dimension), *columns) == [("x", 1, 50.0, 50.0), ("y", 2, 10.0, 30.0)]
    report = attribution.last_touch_ltv(staged, ltv)
    assert rows(report, "adviser_id", "client_count", "total_client_ltv_all_time") == [("y", 2, 80.0)]


def test_masking_follows_the_tags(ledger):
    raw = ledger(fee("A", "a", "2025-01-05", 1.0, "AB123456C"))
    assert privacy.pii_columns(STAGED_SCHEMA) == ["client_nino"]
    assert privacy.pii_columns(CLIENT_SCHEMA) == []
    assert len(privacy.mask_pii(raw, FEE_SCHEMA).first()["client_nino"]) == 64
    assert privacy.mask_pii(raw, FEE_SCHEMA, "mask").first()["client_nino"] == "XXnnnnnnX"
    assert "client_nino" not in privacy.mask_pii(raw, FEE_SCHEMA, "drop").columns
    with pytest.raises(ValueError):
        privacy.mask_pii(raw, FEE_SCHEMA, "shred")


def test_scan_finds_untagged_personal_data(ledger):
    raw = ledger(fee("jo@example.org", "a", "2025-01-05", 1.0, "AB 12 34 56 C"), fee("B", "a", "2025-01-05", 1.0, "JG123456A"))
    found = {(r["column_name"], r["pattern"]): r["matching_rows"] for r in privacy.scan_for_pii(raw).collect()}
    assert found[("client_id", "email")] == 1
    assert found[("client_nino", "nino")] == 2
    assert found[("adviser_id", "nino")] == 0
