"""Bad records with reasons, traces down to the record of a file, and builds compared by fingerprints."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from feeloom.operators.monitoring import changed_rows, row_fingerprints, trace_to_file
from feeloom.operators.staging import stage_fees
from feeloom.schemas import FEE_SCHEMA
from feeloom.sinks import overwrite_table
from feeloom.sources.csv_files import file_freshness, header_contract, read_fees_csv, read_fees_csv_traced, sort_out_fees_csv
from feeloom.sources.tables import read_table
from tests.conftest import fee, rows
from tests.test_plans import plan

HEADER = "client_id,client_nino,adviser_id,fee_date,fee_amount"


def files(folder, **texts):
    folder.mkdir()
    for name, lines in texts.items():
        (folder / f"{name}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    return f"{folder}/*.csv"


BAD = {
    "A,N,a,2025-01-05,1.5": [],
    'B,"N\nN",a,2025-01-05,-2': [],
    "C,N,a,2025-01-05": ["wrong number of columns"],
    "D,N,a,2025-01-05,1.0,x": ["wrong number of columns"],
    ",N,,2025-01-05,1.0": ["client_id: missing", "adviser_id: missing"],
    "E,N,a,2025-02-30,12d": ["fee_date: not a date", "fee_amount: not a number"],
    "F,N,a,soon,": ["fee_date: not a date", "fee_amount: missing"],
    "G,N,a,2025-01-05,NaN": ["fee_amount: not a number"],
    "H,N,a,2025-01-05, 1e2 ": [],
    '"I, and ""J""",N,a,2025-01-05,1.0': [],
}


def test_each_bad_column_has_a_reason(spark, tmp_path):
    glob = files(tmp_path / "files", one=list(BAD)[:5], two=list(BAD)[5:])
    found = sort_out_fees_csv(spark, glob)
    got = found.collect()
    assert sorted(map(str, (r["reasons"] for r in got))) == sorted(map(str, BAD.values()))
    assert {r["client_id"]: r["fee_amount"] for r in got if r["outcome"] == "accepted"} == {"A": 1.5, "B": -2.0, "H": 100.0, 'I, and "J"': 1.0}
    assert all((r["record"] is None) == (r["outcome"] == "accepted") for r in got)
    assert {r["record"] for r in got if r["client_id"] in ("C", "E")} == {"C,N,a,2025-01-05", "E,N,a,2025-02-30,12d"}
    assert {os.path.basename(r["source_file"]) for r in got} == {"one.csv", "two.csv"}
    assert plan(found, "simple").count("FileScan") == 1
    accepted = found.where("outcome = 'accepted'").select(*FEE_SCHEMA.fieldNames())
    assert accepted.dtypes == [(f.name, f.dataType.simpleString()) for f in FEE_SCHEMA.fields]


def test_good_files_are_accepted_as_they_are(spark, tmp_path):
    glob = files(tmp_path / "files", one=[f"C{i},N,a{i},2025-01-0{1 + i % 9},{i}.25" for i in range(50)])
    found = sort_out_fees_csv(spark, glob).where("outcome = 'accepted'").select(*FEE_SCHEMA.fieldNames())
    assert rows(found, "*") == rows(read_fees_csv(spark, glob), "*")


def test_file_freshness_lists_and_does_not_read(spark, tmp_path):
    glob = files(tmp_path / "files", one=["A,N,a,2025-01-05,1.0"], two=[])
    old = dt.datetime.now(dt.UTC) - dt.timedelta(days=10)
    for name in ("one", "two"):
        os.utime(tmp_path / "files" / f"{name}.csv", (old.timestamp(), old.timestamp()))
    found = file_freshness(spark, glob)
    row = found.first()
    assert (row["files"], row["age_days"], row["stale"]) == (2, 10, True) and row["bytes"] == sum(p.stat().st_size for p in (tmp_path / "files").iterdir())
    assert "ReadSchema: struct<modificationTime:timestamp,length:bigint>" in plan(found)
    os.utime(tmp_path / "files" / "one.csv")
    assert file_freshness(spark, glob).first()["stale"] is False


@pytest.mark.parametrize("sizes", [(3, 40, 1), (0, 5)])
def test_a_fee_is_traced_to_its_record(spark, tmp_path, sizes):
    folder, lines = tmp_path / "files", {}
    for k, n in enumerate(sizes):
        lines[f"f{k}"] = [f"C{i % 3},N{i % 3},a,2025-01-{1 + i % 28:02d},{k * 100 + i}.5" for i in range(n)]
    lines["f1"][0] = lines["f1"][0].replace("N0", '"N\n0"')
    path = str(tmp_path / "raw")
    overwrite_table(read_fees_csv_traced(spark, files(folder, **lines)), path, ["fee_date"])
    schema = StructType([*FEE_SCHEMA.fields, StructField("source_file", StringType()), StructField("source_id", LongType())])
    raw = read_table(spark, path, schema)
    clients = spark.createDataFrame([("C0",), ("C2",)], "client_id string")
    got = {(os.path.basename(r["source_file"])[:-4], r["source_row"]): r["fee_amount"] for r in trace_to_file(raw, stage_fees(raw), clients).collect()}
    want = {(name, i + 1): float(line.rsplit(",", 1)[1]) for name, found in lines.items() for i, line in enumerate(found) if line[:2] in ("C0", "C2")}
    assert got == want


def test_fingerprints_do_not_depend_on_order_and_see_copies(ledger):
    fees = [fee(f"C{i}", "a", dt.date(2025, 1, 1 + i % 5), float(i)) for i in range(50)]
    prints = lambda f: rows(row_fingerprints(ledger(*f), "fee_date", "client_id"), "*")
    assert prints(fees) == prints(fees[::-1]) and prints(fees) != prints(fees + fees[:1])
    assert prints([fee(None, "a", "2025-01-01", 1.0, "N")]) != prints([fee("", "a", "2025-01-01", 1.0, "N")])


def test_changed_rows(spark, ledger, tmp_path):
    days = [fee(f"C{i}", "a", dt.date(2025, 1, 1 + i % 10), float(i)) for i in range(60)]
    later = [*days[:-1], fee("new", "a", "2025-01-04", 1.0)]
    later[7] = fee("C7", "a", dt.date(2025, 1, 8), 7.0, "other")
    paths = [str(tmp_path / n) for n in ("before", "after")]
    for path, fees in zip(paths, (days, later), strict=True):
        overwrite_table(stage_fees(ledger(*fees)), path, ["fee_date"])
    before, after = (spark.read.parquet(p) for p in paths)
    found = changed_rows(before, after.withColumn("extra", F.lit(1)))
    names = {r["fee_id"]: r["client_id"] for df in (before, after) for r in df.collect()}
    assert sorted((names[r["fee_id"]], str(r["fee_date"]), r["change"]) for r in found.collect()) == [
        ("C59", "2025-01-10", "removed"), ("C7", "2025-01-08", "changed"), ("new", "2025-01-04", "added"),
    ]
    assert plan(found).count("PartitionFilters: [fee_date") == 2 or "IN" in plan(found)
    assert changed_rows(before, before).isEmpty()
    assert changed_rows(before.where("false"), before).where("change <> 'added'").isEmpty()


def test_headers_are_held_to_the_contract(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    texts = {
        "good": HEADER + "\nA,N,a,2025-01-05,1.0\n", "bom": "﻿" + HEADER.replace("client_id", ' "client_id" ') + "\r\nx\r\n", "only_header": HEADER,
        "renamed": HEADER.replace("adviser_id", "advisor") + "\n", "short": "client_id,client_nino,adviser_id,fee_date\n1,2,3,4\n", "none": "",
        "extra": HEADER + ",a,b\n", "moved": "client_nino,client_id,adviser_id,fee_date,fee_amount\n",
    }
    for name, text in texts.items():
        (folder / f"{name}.csv").write_bytes(text.encode())
    found = header_contract(spark, f"{folder}/*.csv")
    assert sorted((os.path.basename(r["source_file"])[:-4], r["column_name"] or "", r["drift"], r["position"] or 0) for r in found.collect()) == [
        ("extra", "a", "extra", 6), ("extra", "b", "extra", 7), ("moved", "client_id", "moved", 2), ("moved", "client_nino", "moved", 1),
        ("none", "", "empty file", 0), ("renamed", "adviser_id", "renamed", 3), ("short", "fee_amount", "missing", 5),
    ]
