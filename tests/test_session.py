from types import SimpleNamespace

import pytest

from feeloom.session import cluster_conf, scratch_dir


def session(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: folder or default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_tables_go_to_the_shared_folder():
    first, second = (scratch_dir(session("yarn", "hdfs:///shared/"), "upsert") for _ in range(2))
    assert first.startswith("hdfs:///shared/upsert-")
    assert first != second


def test_only_a_local_session_may_use_a_temporary_folder():
    assert "upsert-" in scratch_dir(session("local[8]"), "upsert")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session("yarn"), "upsert")


def test_a_real_session_is_read(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_dir(spark, "upsert").startswith((folder or "/").rstrip("/"))


def test_the_job_starts_by_path_and_sizes_its_shuffles(tmp_path):
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    (tmp_path / "one.csv").write_text("client_id,client_nino,adviser_id,fee_date,fee_amount\nA,N1,a1,2025-01-05,1.50\n")
    run = subprocess.run(
        [sys.executable, f"{repo}/feeloom/__main__.py", str(tmp_path / "store"), f"{tmp_path}/*.csv"],
        cwd=tmp_path, capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONPATH": ""},
    )
    assert run.returncode == 0, run.stderr[-2000:]
    assert "checks passed" in run.stdout


def test_shuffles_are_sized_from_the_input(spark, tmp_path):
    from feeloom.__main__ import size_shuffles
    from feeloom.plans.refresh import Warehouse

    keys = cluster_conf(1, 1)
    before = {k: spark.conf.get(k) for k in keys}
    try:
        (tmp_path / "a.csv").write_text("x" * 1000)
        size_shuffles(spark, Warehouse(str(tmp_path / "none")), f"{tmp_path}/*.csv")
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 2 * spark.sparkContext.defaultParallelism
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
