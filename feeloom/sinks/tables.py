"""Table writers: full overwrite, and an upsert that rewrites only the partitions it touches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feeloom.sources.files import hadoop_path, size_on_disk
from feeloom.sources.tables import read_partitions, read_table, table_exists


class AmbiguousUpsert(ValueError):
    """Two incoming rows share one key, so the row to keep is undefined."""


# The keys are hexadecimal digits: half the bytes with an entropy coder, which Spark's default lacks.
COMPRESSION = "zstd"


def _laid_out(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str], laid_out: bool = False) -> DataFrame:
    if partition_by and not laid_out:
        # One shuffle gathers each partition value; AQE splits a value that outgrows the advisory size into
        # several tasks (files) and merges the small ones, so a hot day does not end up in one task.
        df = df.hint("rebalance", *partition_by)
    if cluster_by:
        df = df.sortWithinPartitions(*partition_by, *cluster_by)
    return df


# Below this many shuffle partitions, merging the small ones saves less than writing their files in turn costs.
FEW_PARTITIONS = 2000
COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
FEW_VALUES = 8


@contextmanager
def _many_writers(spark: SparkSession, partition_by: Sequence[str]) -> Iterator[None]:
    """Keep small shuffle partitions apart during a partitioned write.

    AQE merges by bytes, but a write of many small days costs by files: merged, one task would write thousands
    of files in turn. With very many shuffle partitions the data is large, and merging is left on.
    """
    before = spark.conf.get(COALESCE)
    if not partition_by or int(spark.conf.get("spark.sql.shuffle.partitions")) > FEW_PARTITIONS:
        yield
        return
    spark.conf.set(COALESCE, "false")
    try:
        yield
    finally:
        spark.conf.set(COALESCE, before)


def overwrite_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    accept: Callable[[DataFrame], None] | None = None,
    laid_out: bool = False,
) -> None:
    """Replace the table at ``path`` by ``df``. ``laid_out``: its partition values are gathered already.

    The new files are written beside the table and swapped in once complete, so a failing job (or a failing
    ``accept`` check, which is given the written rows) leaves the old table as it was, and ``df`` may read it.
    """
    spark = df.sparkSession
    incoming = f"{path}__incoming_{uuid.uuid4().hex[:12]}"
    fs, incoming_path = hadoop_path(spark, incoming)
    try:
        writer = _laid_out(df, partition_by, cluster_by, laid_out).write.mode("errorifexists")
        writer = writer.option("partitionOverwriteMode", "static").option("compression", COMPRESSION)
        with _many_writers(spark, partition_by):
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(incoming)
        if accept is not None:
            accept(read_table(spark, incoming, df.schema))
        publish(spark, incoming, path)
    finally:
        if fs.exists(incoming_path):
            fs.delete(incoming_path, True)


def write_by_outcome(records: DataFrame, path: str, column: str = "outcome") -> None:
    """Write ``records`` in one folder for each of the few values of ``column``.

    A file is kept open for each value, so a task does not sort its records first and holds none of them.
    """
    spark = records.sparkSession
    before = spark.conf.get(OPEN_WRITERS)
    spark.conf.set(OPEN_WRITERS, str(FEW_VALUES))
    try:
        records.write.partitionBy(column).option("compression", COMPRESSION).parquet(path)
    finally:
        spark.conf.set(OPEN_WRITERS, before)


def publish(spark: SparkSession, incoming: str, path: str) -> None:
    """Move the complete table at ``incoming`` to ``path``, replacing the one there."""
    fs, target = hadoop_path(spark, path)
    _, source = hadoop_path(spark, incoming)
    _, retired = hadoop_path(spark, f"{path}__retired_{uuid.uuid4().hex[:12]}")
    fs.mkdirs(target.getParent())
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, retired):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(source, target):
        if replaced:
            fs.rename(retired, target)
        raise OSError(f"could not publish {path}")
    if replaced:
        fs.delete(retired, True)
    spark.catalog.refreshByPath(path)


def align_schema(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows of both; a column only one side has is NULL on the other, new columns come last."""
    return existing.unionByName(incoming, allowMissingColumns=True)


def upsert_by_partition(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    key: str = "fee_id",
    partition_col: str = "fee_date",
    cluster_by: Sequence[str] = (),
    laid_out: bool = False,
) -> None:
    """Update rows whose ``key`` matches, insert the others; only dates present in ``incoming`` are read or rewritten.

    A key determines its date, so every match lies in those partitions. Rows that ``incoming`` lacks are
    never deleted, and keep columns that ``incoming`` lacks. Repeating the call gives the same table. Raises
    AmbiguousUpsert if a key repeats in ``incoming``. ``laid_out``: the dates of ``incoming`` are gathered already, so a
    first load is written without another exchange.
    """
    incoming = incoming.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # One row per touched date: bounded by the calendar, not by the data.
        with _many_writers(spark, [partition_col] if laid_out else []):
            touched = _refuse_repeated_keys(incoming, key, partition_col)
        if not table_exists(spark, path):
            overwrite_table(incoming, path, [partition_col], cluster_by, laid_out=laid_out)
            return
        if not touched:
            return
        merged = incoming
        # Columns come from the files of these dates, so columns appended earlier are never dropped.
        current = read_partitions(spark, path, partition_col, touched)
        if current is not None:
            date = F.col(partition_col).cast(incoming.schema[partition_col].dataType)
            kept = current.withColumn(partition_col, date)
            kept = kept.join(incoming.select(key), key, "left_anti").select(*current.columns)
            merged = align_schema(kept, incoming)
        merged = _laid_out(merged, [partition_col], cluster_by)
        writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
        with _many_writers(spark, [partition_col]):
            writer.partitionBy(partition_col).parquet(path)
        spark.catalog.refreshByPath(path)
    finally:
        incoming.unpersist()


def _refuse_repeated_keys(incoming: DataFrame, key: str, partition_col: str) -> list:
    per_value = (
        incoming.groupBy(partition_col, key)
        .agg(F.count("*").alias("copies"))
        .groupBy(partition_col)
        .agg(F.count_if(F.col("copies") > 1).alias("repeated"))
        .collect()
    )
    repeated = sum(r["repeated"] for r in per_value)
    if repeated:
        raise AmbiguousUpsert(f"{repeated} value(s) of {key} occur more than once in the incoming rows")
    return [r[partition_col] for r in per_value]


def table_report(spark: SparkSession, path: str, name: str, rows: int) -> DataFrame:
    """One row on a table just written: table, rows, bytes, files."""
    size, files = size_on_disk(spark, path)
    return spark.createDataFrame([(name, rows, size, files)], "table string, rows bigint, bytes bigint, files bigint")
