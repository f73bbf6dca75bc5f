"""What a task holds, and what is sent through an exchange, as the input grows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feeloom.operators import attribution, monitoring
from feeloom.operators.staging import stage_fees
from feeloom.plans import queries
from feeloom.sinks import tables
from feeloom.sinks.tables import AmbiguousUpsert, overwrite_table, upsert_by_partition
from feeloom.sources.tables import read_table
from tests.conftest import fee


def sent(n):
    return [fee(f"c{i % 7}", f"a{i % 3}", dt.date(2025, 1 + i % 12, 1 + i % 5), float(i)) for i in range(n)]


def test_keys_are_hashed_after_the_layout(ledger, tmp_path):
    staged = stage_fees(ledger(*sent(40)), lay_out_by="fee_date")
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("md5") < plan.index("RebalancePartitions")
    overwrite_table(staged, f"{tmp_path}/t", ["fee_date"], laid_out=True)
    back = read_table(staged.sparkSession, f"{tmp_path}/t", staged.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, stage_fees(ledger(*sent(40))).collect()))
    assert all("zstd" in f for f in back.inputFiles())


def test_a_first_load_that_is_laid_out(spark, ledger, tmp_path):
    staged = stage_fees(ledger(*sent(40)), lay_out_by="fee_date")
    upsert_by_partition(spark, f"{tmp_path}/t", staged, laid_out=True)
    assert read_table(spark, f"{tmp_path}/t", staged.schema).count() == 40
    twice = stage_fees(ledger(fee("c", "a", "2025-01-05", 1.0, "N1"), fee("c", "a", "2025-01-05", 1.0, "N2")), lay_out_by="fee_date")
    with pytest.raises(AmbiguousUpsert):
        upsert_by_partition(spark, f"{tmp_path}/u", twice, laid_out=True)


def test_headers_are_made_from_one_pass(spark, ledger, monkeypatch):
    seen, rows = spark.sparkContext.accumulator(0), sent(48)
    counted = spark.sparkContext.parallelize(rows, 2).map(lambda r: (seen.add(1), r)[1])
    monkeypatch.setattr(queries, "fee_ledger", lambda *_: spark.createDataFrame(counted, ledger().schema))
    drift = queries.header_drift(spark, "")
    assert seen.value == len(rows)
    assert {r["month"] for r in drift.collect()} == {f"2025-{m:02d}" for m in range(4, 13)}


@pytest.fixture
def lines(spark, tmp_path):
    orders = [(k, k % 5, dt.datetime(1996, 1 + k % 12, 1 + k % 27)) for k in range(60)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    items = [(i % 60, i % 4, float(1 + i % 50), 100.0 + i, (i % 9) / 100, "RAN"[i % 3]) for i in range(400)]
    names = "l_orderkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_tax double, l_returnflag string"
    spark.createDataFrame(items, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_more_lines_take_more_files(spark, lines, monkeypatch):
    files, sort_out = [], queries.sort_out_fees_csv
    monkeypatch.setattr(queries, "sort_out_fees_csv", lambda spark, glob: (files.append(spark.read.text(glob).inputFiles()), sort_out(spark, glob))[1])
    before = sorted(map(tuple, queries.quarantine_by_column(spark, lines).collect()), key=str)
    monkeypatch.setattr(queries, "LINES_PER_FILE", 10)
    assert sorted(map(tuple, queries.quarantine_by_column(spark, lines).collect()), key=str) == before
    assert [len(f) for f in files] == [16, 40]


def test_records_are_not_sorted_by_outcome(spark, tmp_path):
    setting = spark.conf.get(tables.OPEN_WRITERS)
    records = spark.range(100, numPartitions=1).select("id", F.when(F.col("id") % 3 == 0, "rejected").otherwise("accepted").alias("outcome"))
    tables.write_by_outcome(records, f"{tmp_path}/r")
    back = spark.read.parquet(f"{tmp_path}/r")
    assert back.where("outcome = 'rejected'").count() == 34 and back.count() == 100
    # In the order they came in.
    assert [r["id"] for r in spark.read.parquet(f"{tmp_path}/r/outcome=accepted").collect()] == [i for i in range(100) if i % 3]
    assert spark.conf.get(tables.OPEN_WRITERS) == setting


def test_tenure_is_dealt_to_more_tasks_for_more_rows(ledger, monkeypatch):
    fees = stage_fees(ledger(*sent(84)))
    before = sorted(map(tuple, attribution.adviser_tenure(fees).collect()))
    monkeypatch.setattr(attribution, "SERVED_ROWS_PER_TASK", 4)
    tenure = attribution.adviser_tenure(fees)
    assert tenure.rdd.getNumPartitions() == 21
    assert sorted(map(tuple, tenure.collect())) == before


def test_few_clients_are_traced_without_an_exchange_of_the_fees(spark, ledger):
    raw = ledger(*sent(40))
    # Of rows from an RDD the size is not known.
    clients = spark.createDataFrame(spark.sparkContext.parallelize([("c1",)], 1), "client_id string")
    traced = monitoring.trace_to_raw(raw, stage_fees(raw), clients)
    plan = traced._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [client_id" in plan and "SortMergeJoin [client_id" not in plan
    assert traced.count() == sum(r[0] == "c1" for r in sent(40))


def test_two_builds_join_their_lines_once(spark, lines, monkeypatch):
    calls, fee_lines = [], queries.fee_lines
    monkeypatch.setattr(queries, "fee_lines", lambda *a: (calls.append(a), fee_lines(*a))[1])
    monkeypatch.setattr(queries, "fee_ledger", None)
    found = {(r["table"], r["measure"]): (r["before"], r["after"]) for r in queries.compare_builds(spark, lines).collect()}
    assert len(calls) == 1
    copies = sum(1 + i % 50 == 50 for i in range(400))
    assert found["raw_fees", "rows"] == (400 + copies, 400 + copies)
