"""Publication by version: what readers see between and after two publications."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feeloom.operators.checks import ChecksFailed
from feeloom.operators.staging import stage_fees
from feeloom.plans.refresh import Warehouse, backfill_staging, build_staging, register_tables, run_refresh
from feeloom.schemas import STAGED_COLUMNS
from feeloom.sinks import versions
from tests.conftest import fee, rows
from tests.test_refresh import many, write_csv


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "staging" / "stg_fees")


def staged(ledger, *fees, **options):
    return stage_fees(ledger(*fees), **options)


def clients(df):
    return [r[0] for r in rows(df, "client_id")]


def test_a_reader_keeps_its_version_until_it_is_pruned(spark, ledger, path):
    versions.replace_table(staged(ledger, fee("A", "a", "2025-01-05", 1.0), fee("B", "a", "2025-01-06", 1.0)), path, "fee_date")
    held = versions.read_snapshot(spark, path)
    versions.replace_table(staged(ledger, fee("C", "a", "2025-01-05", 1.0)), path, "fee_date")
    assert clients(held) == ["A", "B"] and clients(versions.read_snapshot(spark, path)) == ["C"]
    assert versions.read_snapshot(spark, path).columns == STAGED_COLUMNS
    assert versions.prune_versions(spark, path, keep=2) == []
    assert len(versions.prune_versions(spark, path, keep=1)) == 1
    assert clients(versions.read_snapshot(spark, path)) == ["C"]


def test_upsert_names_untouched_partitions_again(spark, ledger, path):
    days = [fee("A", "a", "2025-01-05", 1.0, "old"), fee("B", "a", "2025-01-05", 1.0), fee("C", "a", "2025-01-06", 1.0)]
    first = versions.replace_table(staged(ledger, *days), path, "fee_date")
    new = [fee("A", "a", "2025-01-05", 1.0, "new"), fee("D", "a", "2025-01-05", 2.0), fee("E", "a", "2025-01-09", 1.0)]
    for _ in range(2):
        whole = versions.upsert_table(spark, path, staged(ledger, *new))
        got = versions.read_snapshot(spark, path)
        assert rows(got, "client_id", "client_nino") == [("A", "new"), ("B", "NB"), ("C", "NC"), ("D", "ND"), ("E", "NE")]
        assert whole.folders["fee_date=2025-01-06"] == first.folders["fee_date=2025-01-06"]
    assert clients(versions.read_snapshot(spark, path, versions.snapshot(spark, path, 1))) == ["A", "B", "C"]
    # The first upsert's files and the first version's replaced day go; its other day is still named.
    assert len(versions.prune_versions(spark, path, keep=1)) == 2
    assert clients(versions.read_snapshot(spark, path)) == ["A", "B", "C", "D", "E"]


def test_names_show_whole_versions(spark, ledger, path):
    spark.sql("CREATE DATABASE IF NOT EXISTS versions_test")
    name = "versions_test.stg_fees"
    versions.replace_table(staged(ledger, fee("A", "a", "2025-01-05", 1.0), fee("B", "a", "2025-01-06", 1.0)), path, "fee_date", name=name)
    held = spark.table(name)
    versions.upsert_table(spark, path, staged(ledger, fee("A", "a", "2025-01-05", 1.0, "new"), fee("C", "a", "2025-01-07", 1.0)), name=name)
    assert clients(held) == ["A", "B"]
    assert clients(spark.table(name)) == ["A", "B", "C"]
    assert spark.sql(f"SELECT client_nino FROM {name} WHERE fee_date = DATE '2025-01-05'").first()[0] == "new"
    versions.restore_snapshot(spark, path, 1, name)
    assert rows(spark.table(name), "client_id", "client_nino") == [("A", "NA"), ("B", "NB")]
    spark.sql("DROP DATABASE versions_test CASCADE")
    assert clients(versions.read_snapshot(spark, path)) == ["A", "B"]


def test_tables_without_partitions_and_empty_ones(spark, ledger, path):
    spark.sql("CREATE DATABASE IF NOT EXISTS versions_test")
    for n in (3, 0, 2):
        versions.replace_table(spark.range(n), path, name="versions_test.numbers")
        assert spark.table("versions_test.numbers").count() == n == versions.read_snapshot(spark, path).count()
    versions.replace_table(staged(ledger), path + "2", "fee_date", name="versions_test.empty")
    assert spark.table("versions_test.empty").count() == 0 == versions.read_snapshot(spark, path + "2").count()
    versions.upsert_table(spark, path + "2", staged(ledger, fee("A", "a", "2025-01-05", 1.0)), name="versions_test.empty")
    assert clients(spark.table("versions_test.empty")) == ["A"]
    spark.sql("DROP DATABASE versions_test CASCADE")


def test_a_failing_write_publishes_nothing(spark, ledger, path, tmp_path):
    versions.replace_table(staged(ledger, fee("A", "a", "2025-01-05", 1.0)), path, "fee_date")

    def refuse(written):
        raise ValueError(f"{written.count()} rows")

    with pytest.raises(ValueError, match="2 rows"):
        versions.replace_table(staged(ledger, fee("B", "a", "2025-01-05", 1.0), fee("C", "a", "2025-01-05", 1.0)), path, "fee_date", accept=refuse)
    with pytest.raises(Exception, match="not exact"):
        versions.replace_table(staged(ledger, fee("B", "a", "2025-01-05", 0.001)), path, "fee_date")
    assert clients(versions.read_snapshot(spark, path)) == ["A"]
    assert len([p for p in (tmp_path / "staging" / "stg_fees").iterdir() if p.name.startswith("version=")]) == 1


def test_of_two_writers_one_publishes(spark, ledger, path):
    versions.replace_table(staged(ledger, fee("A", "a", "2025-01-05", 1.0)), path, "fee_date")
    drafts = [versions.write_version(staged(ledger, fee(c, "a", "2025-01-05", 1.0)), path, "fee_date") for c in "BC"]
    versions.publish_snapshot(spark, path, drafts[0], 1)
    with pytest.raises(versions.ConcurrentPublish):
        versions.publish_snapshot(spark, path, drafts[1], 1)
    assert clients(versions.read_snapshot(spark, path)) == ["B"]


def test_a_manifest_that_is_not_whole_is_not_current(spark, ledger, path, tmp_path):
    versions.replace_table(staged(ledger, fee("A", "a", "2025-01-05", 1.0)), path, "fee_date")
    (tmp_path / "staging" / "stg_fees" / "_versions" / "00000002.json").write_text('{"schema": ')
    assert clients(versions.read_snapshot(spark, path)) == ["A"]
    with pytest.raises(versions.ConcurrentPublish):
        versions.replace_table(staged(ledger, fee("B", "a", "2025-01-05", 1.0)), path, "fee_date")


def test_new_columns_are_appended(spark, ledger, path):
    versions.replace_table(staged(ledger, fee("A", "a", "2025-01-05", 1.0), fee("B", "a", "2025-01-06", 1.0)), path, "fee_date")
    raw = ledger(fee("B", "a", "2025-01-06", 1.0), fee("C", "a", "2025-01-07", 1.0)).withColumn("currency", F.lit("GBP"))
    versions.upsert_table(spark, path, stage_fees(raw, extra_columns=["currency"]))
    versions.upsert_table(spark, path, staged(ledger, fee("D", "a", "2025-01-06", 1.0)))
    assert {r["client_id"]: r["currency"] for r in versions.read_snapshot(spark, path).collect()} == {"A": None, "B": "GBP", "C": "GBP", "D": None}


def test_no_file_is_moved(spark, ledger, path, monkeypatch):
    """The versions module never renames: on an object store a rename is a copy."""
    import inspect

    assert "rename(" not in inspect.getsource(versions)


def test_the_batch_job_by_version(spark, ledger, tmp_path):
    store = Warehouse(str(tmp_path / "store"), versioned=True)
    folder = tmp_path / "files"
    assert run_refresh(spark, store, write_csv(folder, "one.csv", *many(40))).count() == 22
    report = spark.table("reporting.rpt_adviser_ltv")
    before = rows(report, "*")
    twins = [fee("T", "a", "2025-08-29", 1.0, "N1"), fee("T", "b", "2025-08-29", 1.0, "N2")]
    with pytest.raises(ChecksFailed):
        run_refresh(spark, store, write_csv(folder, "two.csv", *twins), gate=True)
    assert rows(spark.table("reporting.rpt_adviser_ltv"), "*") == before
    assert len([p for p in (tmp_path / "store/reporting/rpt_adviser_ltv").iterdir() if p.name.startswith("version=")]) == 1
    write_csv(folder, "two.csv", *many(80)[40:])
    run_refresh(spark, store, f"{folder}/*.csv", full_refresh=True, gate=True)
    assert spark.table("staging.stg_fees").count() == 80 == store.read(spark, "stg_fees").count()
    assert rows(spark.table("reporting.rpt_adviser_ltv"), "*") != before == rows(report, "*")
    backfill_staging(spark, store, dt.date(2025, 1, 1), dt.date(2025, 1, 2))
    build_staging(spark, store)
    for layer in ("raw", "staging", "reporting"):
        spark.sql(f"DROP DATABASE {layer} CASCADE")
    assert len(register_tables(spark, store)) == 6
    assert spark.table("staging.stg_fees").count() == 80
    for layer in ("raw", "staging", "reporting"):
        spark.sql(f"DROP DATABASE {layer} CASCADE")
