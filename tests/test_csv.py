import pytest

from feeloom.plans.refresh import Warehouse, ingest_fees
from feeloom.sources.csv_files import quarantine_fees_csv, read_fees_csv, require_not_null
from tests.conftest import rows

HEADER = "client_id,client_nino,adviser_id,fee_date,fee_amount\n"
GOOD = HEADER + "A,N1,a1,2025-01-05,1.50\nB,N2,a2,2025-01-06,-2\n"


@pytest.fixture
def files(tmp_path):
    def write(**contents):
        folder = tmp_path / "files"
        folder.mkdir(exist_ok=True)
        for name, text in contents.items():
            (folder / f"{name}.csv").write_text(text)
        return f"{folder}/*.csv"

    return write


def test_reads_every_file_of_the_glob(spark, files):
    fees = read_fees_csv(spark, files(one=GOOD, two=GOOD))
    assert fees.count() == 4
    assert [f.dataType.simpleString() for f in fees.schema] == ["string", "string", "string", "date", "double"]


def test_quoted_newlines_and_doubled_quotes(spark, files):
    text = HEADER + '"A\nx","N""1",a1,2025-01-05,1.5\n'
    fees = read_fees_csv(spark, files(one=text))
    assert rows(fees, "client_id", "client_nino") == [("A\nx", 'N"1')]


TRICKY = {
    "newlines": HEADER + '"A\nx",N1,a1,2025-01-05,1.5\n"A\n\nx","N,2",a1,2025-01-05,2.5\n',
    "carriage returns": HEADER.strip() + '\r\n"A\r\nx",N1,a1,2025-01-05,1.5\r\nB,N2,a1,2025-01-05,1\r\n',
    "stray quote": HEADER + 'a"b,N1,a1,2025-01-05,1\n',
}


@pytest.mark.parametrize("case", TRICKY)
def test_the_size_of_a_file_changes_nothing(spark, files, case):
    glob = files(one=TRICKY[case])
    settings = {"spark.sql.files.maxPartitionBytes": "40", "spark.sql.files.openCostInBytes": "40"}
    before = {k: spark.conf.get(k) for k in settings}
    whole = rows(read_fees_csv(spark, glob), "*")
    assert len(whole) == TRICKY[case].count("2025")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert rows(read_fees_csv(spark, glob), "*") == whole
        accepted, rejected = quarantine_fees_csv(spark, glob)
        assert rows(accepted, "*") == whole and rejected.isEmpty()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_split_files_refuse_quoted_newlines(spark, files):
    plain = files(one=GOOD + '"C, D",N3,a1,2025-01-07,1\n')
    assert read_fees_csv(spark, plain, quoted_newlines=False).count() == 3
    quoted = files(two=TRICKY["newlines"])
    for read in (read_fees_csv, quarantine_fees_csv):
        with pytest.raises(ValueError, match="inside quotes"):
            read(spark, quoted, quoted_newlines=False)


BAD_FILES = {
    "short row": HEADER + "A,N1,a1,2025-01-05\n",
    "extra column": HEADER + "A,N1,a1,2025-01-05,1,2\n",
    "bad number": HEADER + "A,N1,a1,2025-01-05,one\n",
    "bad date": HEADER + "A,N1,a1,someday,1\n",
    "swapped header": "client_nino,client_id,adviser_id,fee_date,fee_amount\nN1,A,a1,2025-01-05,1\n",
}


@pytest.mark.parametrize("case", BAD_FILES)
@pytest.mark.parametrize("quoted_newlines", [True, False])
def test_bad_records_fail(spark, files, case, quoted_newlines):
    fees = read_fees_csv(spark, files(good=GOOD, bad=BAD_FILES[case]), quoted_newlines=quoted_newlines)
    with pytest.raises(Exception, match="(?i)malformed|header|CSV"):
        fees.collect()
    if not case.startswith("bad"):
        with pytest.raises(Exception, match="(?i)malformed|header|CSV"):
            fees.count()


@pytest.mark.parametrize("position", range(5))
def test_a_missing_required_value_fails_the_load(spark, files, position):
    cells = ["A", "N1", "a1", "2025-01-05", "1"]
    cells[position] = ""
    fees = read_fees_csv(spark, files(one=HEADER + ",".join(cells) + "\n"))
    assert fees.count() == 1
    with pytest.raises(Exception, match="NULL in required column"):
        require_not_null(fees).collect()


def test_failed_loads_leave_the_table_as_it_was(spark, files, tmp_path):
    store = Warehouse(str(tmp_path / "store"))
    report = ingest_fees(spark, files(one=GOOD), store).first()
    assert (report["table"], report["rows"], report["files"] >= 2, report["bytes"] > 0) == ("raw.fees", 2, True, True)
    before = rows(store.read(spark, "fees"), "*")
    for text in [*BAD_FILES.values(), HEADER + "A,,a1,2025-01-05,1\n"]:
        with pytest.raises(Exception):  # noqa: B017 - each failure has its own type
            ingest_fees(spark, files(one=text), store)
    with pytest.raises(ValueError, match="0 rows"):
        ingest_fees(spark, files(one=HEADER), store)
    assert rows(store.read(spark, "fees"), "*") == before
    assert [p.name for p in (tmp_path / "store" / "raw").iterdir() if "__" in p.name] == []


def test_reload_replaces_everything(spark, files, tmp_path):
    store = Warehouse(str(tmp_path / "store"))
    ingest_fees(spark, files(one=GOOD, two=GOOD), store)
    assert store.read(spark, "fees").count() == 4
    ingest_fees(spark, files(one=HEADER + "Z,N9,a1,2025-03-01,9\n", two=HEADER), store)
    assert rows(store.read(spark, "fees"), "client_id") == [("Z",)]


def test_quarantine_sets_bad_records_aside(spark, files):
    text = GOOD + "C,N3,a1,2025-01-07\nD,N4,a1,2025-01-08,x\nE,,,2025-01-09,1\n"
    accepted, rejected = quarantine_fees_csv(spark, files(one=text))
    assert rows(accepted, "client_id") == [("A",), ("B",)]
    assert rows(rejected, "reason") == [
        ("malformed record",),
        ("malformed record",),
        ("missing required: client_nino, adviser_id",),
    ]
    assert rejected.where("source_file LIKE '%one.csv'").count() == 3
    assert ("C,N3,a1,2025-01-07",) in [tuple(r) for r in rejected.select("_corrupt_record").collect()]
