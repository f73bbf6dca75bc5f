import pytest

from feeloom.operators.staging import stage_fees
from feeloom.schemas import STAGED_COLUMNS, STAGED_SCHEMA
from feeloom.sources.csv_files import read_fees_csv
from feeloom.sources.tables import read_table
from feeloom.streaming.arrivals import stage_arrivals
from tests.conftest import fee, rows
from tests.test_refresh import write_csv


def test_two_drops_equal_one_batch(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "files", str(tmp_path / "staged"), str(tmp_path / "checkpoint")

    def run():
        stage_arrivals(spark, str(folder), out, checkpoint, max_files_per_batch=1).awaitTermination()
        return rows(read_table(spark, out, STAGED_SCHEMA), *STAGED_COLUMNS)

    write_csv(folder, "one.csv", fee("A", "a", "2025-01-05", 1.0), fee("A", "a", "2025-01-05", 1.0))
    first = run()
    assert len(first) == 1
    assert run() == first  # nothing new arrived
    write_csv(folder, "two.csv", fee("A", "a", "2025-01-05", 1.0), fee("B", "a", "2025-01-05", 2.0))
    glob = write_csv(folder, "three.csv", fee("C", "a", "2024-01-05", 3.0))
    assert run() == rows(stage_fees(read_fees_csv(spark, glob)), *STAGED_COLUMNS)


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    folder, out = tmp_path / "files", str(tmp_path / "staged")
    write_csv(folder, "one.csv", fee("A", "a", "2025-01-05", 1.0), fee("B", "a", "2025-01-06", 1.0))
    for attempt in ("c1", "c2"):  # a lost checkpoint replays all files
        stage_arrivals(spark, str(folder), out, str(tmp_path / attempt)).awaitTermination()
    assert read_table(spark, out, STAGED_SCHEMA).count() == 2


def test_a_missing_required_value_stops_the_stream(spark, tmp_path):
    folder = tmp_path / "files"
    write_csv(folder, "one.csv", ("A", "", "a", "2025-01-05", 1.0))
    with pytest.raises(Exception, match="required column client_nino"):
        stage_arrivals(spark, str(folder), str(tmp_path / "staged"), str(tmp_path / "c")).awaitTermination()
