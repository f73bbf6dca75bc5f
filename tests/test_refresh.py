import datetime as dt

import pytest
from pyspark.sql import functions as F

from feeloom.__main__ import main
from feeloom.operators.checks import ChecksFailed
from feeloom.operators.staging import stage_fees
from feeloom.plans.refresh import (
    Warehouse,
    backfill_staging,
    build_reports,
    build_staging,
    register_tables,
    run_refresh,
)
from feeloom.schemas import STAGED_COLUMNS
from feeloom.sinks import overwrite_table
from tests.conftest import fee, rows


@pytest.fixture
def store(tmp_path):
    return Warehouse(str(tmp_path / "store"))


def load(store, raw):
    overwrite_table(raw, store.path("fees"), ["fee_date"])


def staged(spark, store):
    return rows(store.read(spark, "stg_fees"), "client_id", "client_nino", F.col("fee_date").cast("string"), "fee_amount")


def write_csv(folder, name, *fees):
    folder.mkdir(exist_ok=True)
    lines = ["client_id,client_nino,adviser_id,fee_date,fee_amount", *[",".join(map(str, f)) for f in fees]]
    (folder / name).write_text("\n".join(lines) + "\n")
    return f"{folder}/*.csv"


def many(n=80):
    return [fee(f"C{i % 9}", f"a{i % 4}", dt.date(2025, 1, 1) + dt.timedelta(days=3 * i), 10.0 + i) for i in range(n)]


def test_end_to_end(spark, store, tmp_path):
    glob = write_csv(tmp_path / "files", "one.csv", *many(), *many(2))
    results = run_refresh(spark, store, glob)
    assert results.count() == 22
    assert store.read(spark, "fees").count() == 82
    assert store.read(spark, "stg_fees").count() == 80
    assert store.read(spark, "dim_clients").count() == 9
    assert store.read(spark, "rpt_client_ltv").agg(F.sum("ltv_total")).first()[0] == sum(10.0 + i for i in range(80))
    assert store.read(spark, "rpt_adviser_ltv").agg(F.sum("client_count")).first()[0] == 9
    assert store.read(spark, "rpt_cohort_ltv").count() == 1


def test_pii_stays_out_of_reporting(spark, store, tmp_path):
    run_refresh(spark, store, write_csv(tmp_path / "files", "one.csv", *many()))
    for model in ("dim_clients", "rpt_client_ltv", "rpt_cohort_ltv", "rpt_adviser_ltv"):
        assert "client_nino" not in store.read(spark, model).columns


def test_incremental_run_equals_full_refresh_when_nothing_is_late(spark, store, tmp_path):
    folder = tmp_path / "files"
    run_refresh(spark, store, write_csv(folder, "one.csv", *many(40)))
    run_refresh(spark, store, write_csv(folder, "two.csv", *many(80)[40:]))
    incremental = rows(store.read(spark, "stg_fees"), *STAGED_COLUMNS)
    report = rows(store.read(spark, "rpt_adviser_ltv"), "*")
    run_refresh(spark, store, skip_ingest=True, full_refresh=True)
    assert rows(store.read(spark, "stg_fees"), *STAGED_COLUMNS) == incremental
    assert rows(store.read(spark, "rpt_adviser_ltv"), "*") == report


def test_flags(spark, store, tmp_path):
    with pytest.raises(ValueError):
        run_refresh(spark, store)
    assert run_refresh(spark, store, write_csv(tmp_path / "files", "one.csv", *many()), skip_tests=True) is None


def test_failing_checks_leave_tables_published(spark, store, tmp_path):
    twins = [fee("T", "a", "2025-01-05", 1.0, "N1"), fee("T", "a", "2025-01-05", 1.0, "N2")]
    with pytest.raises(ChecksFailed, match="one nino per client: 1"):
        run_refresh(spark, store, write_csv(tmp_path / "files", "one.csv", *many(), *twins))
    assert store.read(spark, "rpt_adviser_ltv").count() > 0


def test_a_gate_keeps_the_old_reports_when_checks_fail(spark, store, tmp_path):
    folder = tmp_path / "files"
    assert run_refresh(spark, store, write_csv(folder, "one.csv", *many()), gate=True).count() == 22
    before = rows(store.read(spark, "rpt_adviser_ltv"), "*")
    twins = [fee("T", "a", "2025-08-29", 1.0, "N1"), fee("T", "b", "2025-08-29", 1.0, "N2")]
    with pytest.raises(ChecksFailed):
        run_refresh(spark, store, write_csv(folder, "two.csv", *twins), gate=True)
    assert rows(store.read(spark, "rpt_adviser_ltv"), "*") == before
    assert [p.name for p in (tmp_path / "store").iterdir() if p.name.startswith("candidate")] == []


def test_lookback(spark, ledger, store):
    load(store, ledger(fee("A", "a", "2025-06-10", 1.0)))
    build_staging(spark, store)
    load(store, ledger(*[fee(c, "a", d, 1.0) for c, d in [("A", "2025-06-10"), ("B", "2025-06-06"), ("C", "2025-06-07"), ("D", "2025-06-11")]]))
    build_staging(spark, store)
    assert [r[0] for r in staged(spark, store)] == ["A", "C", "D"]
    backfill_staging(spark, store, dt.date(2025, 6, 1), dt.date(2025, 6, 6))
    assert [r[0] for r in staged(spark, store)] == ["A", "B", "C", "D"]


def test_corrected_amount_stays_beside_the_old_one_until_full_refresh(spark, ledger, store):
    load(store, ledger(fee("A", "a", "2025-06-10", 5.0)))
    build_staging(spark, store)
    load(store, ledger(fee("A", "a", "2025-06-10", 6.0)))
    build_staging(spark, store)
    assert [r[3] for r in staged(spark, store)] == [5.0, 6.0]
    build_staging(spark, store, full_refresh=True)
    assert [r[3] for r in staged(spark, store)] == [6.0]


def test_nino_refresh(spark, ledger, store):
    load(store, ledger(fee("A", "a", "2025-06-10", 5.0, "old")))
    build_staging(spark, store)
    load(store, ledger(fee("A", "a", "2025-06-10", 5.0, "new")))
    build_staging(spark, store)
    assert staged(spark, store) == [("A", "new", "2025-06-10", 5.0)]


def test_an_incremental_run_keeps_appended_columns(spark, ledger, store):
    raw = ledger(fee("A", "a", "2025-06-10", 5.0))
    overwrite_table(
        stage_fees(raw.withColumn("currency", F.lit("GBP")), extra_columns=["currency"]), store.path("stg_fees"), ["fee_date"]
    )
    load(store, raw.unionAll(ledger(fee("B", "a", "2025-06-10", 6.0))).where("client_id = 'B'"))
    build_staging(spark, store)
    table = spark.read.option("mergeSchema", True).parquet(store.path("stg_fees"))
    assert rows(table, "client_id", "currency") == [("A", "GBP"), ("B", None)]


def test_an_empty_target_stages_everything(spark, ledger, store):
    overwrite_table(stage_fees(ledger()), store.path("stg_fees"), ["fee_date"])
    load(store, ledger(fee("A", "a", "2020-01-01", 1.0), fee("B", "a", "2025-06-10", 1.0)))
    build_staging(spark, store)
    assert len(staged(spark, store)) == 2


def test_a_future_dated_fee_hides_later_rows(spark, ledger, store):
    load(store, ledger(fee("A", "a", "2099-01-01", 1.0)))
    build_staging(spark, store)
    load(store, ledger(fee("A", "a", "2099-01-01", 1.0), fee("B", "a", "2025-06-10", 1.0)))
    build_staging(spark, store)
    assert [r[0] for r in staged(spark, store)] == ["A"]


def test_reports_follow_the_windows_of_the_store(spark, ledger, tmp_path):
    store = Warehouse(str(tmp_path / "w"), windows=(2, 12), cluster_by=["client_id"])
    load(store, ledger(*many()))
    build_staging(spark, store)
    build_reports(spark, store)
    assert "rank_by_ltv_12_month" in store.read(spark, "rpt_adviser_ltv").columns
    assert store.read(spark, "rpt_cohort_ltv").first()["avg_ltv_2_month"] > 0


def test_tables_answer_sql_by_name(spark, ledger, store):
    load(store, ledger(*many()))
    build_staging(spark, store)
    build_reports(spark, store)
    for _ in range(2):
        names = register_tables(spark, store)
    assert names[0] == "raw.fees" and len(names) == 6
    best = spark.sql("SELECT * FROM reporting.rpt_adviser_ltv ORDER BY rank_by_ltv_6_month LIMIT 10")
    assert best.first()["rank_by_ltv_6_month"] == 1
    assert spark.sql("SELECT * FROM staging.stg_fees WHERE fee_date = DATE '2025-01-04'").count() == 1
    assert spark.table("raw.fees").count() == 80
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    assert store.read(spark, "fees").count() == 80


def test_command_line(spark, tmp_path, capsys):
    folder, root = tmp_path / "files", str(tmp_path / "store")
    glob = write_csv(folder, "one.csv", *many())
    assert main([root, glob, "--windows", "1,6"]) == 0
    assert "22 checks passed" in capsys.readouterr().out
    assert main([root, "--skip-ingest", "--skip-tests", "--full-refresh", "--windows", "1,6"]) == 0
    write_csv(folder, "two.csv", fee("T", "a", "2025-08-29", 1.0, "N1"), fee("T", "b", "2025-08-29", 1.0, "N2"))
    assert main([root, glob, "--windows", "1,6"]) == 1
    assert "one nino per client: 1" in capsys.readouterr().err
    with pytest.raises(SystemExit):
        main([root])
