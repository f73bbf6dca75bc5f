"""Publication by version: files are never moved or replaced, so a reader sees a table whole, also on an object store.

A table folder holds ``version=.../`` folders and small manifests ``_versions/<number>.json``. A manifest names, for
each partition, the version folder that holds its current files; creating the next manifest is the one step that
publishes. In the catalog the table's name is a view over an external table of that version, whose partitions lie where
the manifest says; replacing the view is one step too. A reader that has resolved the name keeps the version it has.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feeloom.sinks.tables import COMPRESSION, _laid_out, _many_writers, _refuse_repeated_keys, align_schema
from feeloom.sources.files import hadoop_path

MANIFESTS = "_versions"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
PARTITIONS_A_STATEMENT = 200


class ConcurrentPublish(RuntimeError):
    """Another writer published first; nothing of this write is visible."""


@dataclass(frozen=True)
class Snapshot:
    """What one version of a table consists of.

    ``folders``: version folder by partition folder ("fee_date=2025-01-05"; "" if the table has no partitions): one entry for
    each day. ``written``: how many partitions each version folder was written with.
    """

    number: int
    schema: StructType
    partition_by: str | None
    folders: dict[str, str]
    written: dict[str, int]


def snapshot_numbers(spark: SparkSession, path: str) -> list[int]:
    fs, folder = hadoop_path(spark, f"{path}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def _read_manifest(spark: SparkSession, path: str, number: int) -> Snapshot | None:
    fs, file = hadoop_path(spark, f"{path}/{MANIFESTS}/{number:08d}.json")
    stream = fs.open(file)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        kept = json.loads(text)
    except ValueError:
        return None  # its writer is not done, or was lost
    return Snapshot(number, StructType.fromJson(kept["schema"]), kept["partition_by"], kept["folders"], kept["written"])


def snapshot(spark: SparkSession, path: str, number: int | None = None) -> Snapshot | None:
    """The version ``number`` of the table (default: the current one); None if nothing is published."""
    numbers = snapshot_numbers(spark, path) if number is None else [number]
    return next((s for n in reversed(numbers) if (s := _read_manifest(spark, path, n)) is not None), None)


def read_snapshot(spark: SparkSession, path: str, found: Snapshot | None = None) -> DataFrame:
    """The rows of a version (default: the current one), with its declared columns. Its files are listed, no others."""
    found = found or snapshot(spark, path)
    if found is None:
        raise ValueError(f"nothing is published at {path}")
    referenced = Counter(found.folders.values())
    roots = {f"{path}/{v}" for v, n in referenced.items() if n == found.written.get(v)}
    roots |= {f"{path}/{v}/{p}" for p, v in found.folders.items() if f"{path}/{v}" not in roots}
    if not roots:
        return spark.createDataFrame([], found.schema)
    rows = spark.read.schema(found.schema).option("basePath", path).parquet(*sorted(roots))
    return rows.select(*found.schema.fieldNames())


def write_version(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    cluster_by: Sequence[str] = (),
    accept: Callable[[DataFrame], None] | None = None,
    laid_out: bool = False,
) -> Snapshot:
    """Write ``df`` to a new version folder that no reader sees yet; ``accept`` is given the written rows.

    If the job or ``accept`` fails, the folder is removed.
    """
    spark, keys = df.sparkSession, [partition_by] if partition_by else []
    version = f"version=v{uuid.uuid4().hex[:16]}"
    fs, folder = hadoop_path(spark, f"{path}/{version}")
    try:
        writer = _laid_out(df, keys, cluster_by, laid_out).write.mode("errorifexists")
        writer = writer.option("partitionOverwriteMode", "static").option("compression", COMPRESSION)
        with _many_writers(spark, keys):
            (writer.partitionBy(*keys) if keys else writer).parquet(f"{path}/{version}")
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        parts = [n for n in names if n.startswith(f"{partition_by}=")] if partition_by else [""]
        draft = Snapshot(0, df.schema, partition_by, dict.fromkeys(parts, version), {version: len(parts)})
        if accept is not None:
            accept(read_snapshot(spark, path, draft))
        return draft
    except BaseException:
        fs.delete(folder, True)
        raise


def discard(spark: SparkSession, path: str, draft: Snapshot) -> None:
    """Remove a version that was written and is not to be published."""
    for version in set(draft.written):
        fs, folder = hadoop_path(spark, f"{path}/{version}")
        fs.delete(folder, True)


def publish_snapshot(spark: SparkSession, path: str, draft: Snapshot, after: int, name: str | None = None) -> Snapshot:
    """Make ``draft`` the version that follows number ``after``, and let the catalog ``name`` show it.

    Of two writers that follow the same version, one succeeds; the other gets ConcurrentPublish.
    """
    number = after + 1
    fs, file = hadoop_path(spark, f"{path}/{MANIFESTS}/{number:08d}.json")
    content = {"schema": draft.schema.jsonValue(), "partition_by": draft.partition_by, "folders": draft.folders, "written": draft.written}
    try:
        stream = fs.create(file, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error) or fs.exists(file):
            raise ConcurrentPublish(f"version {number} of {path} was published by another writer") from error
        raise
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    published = Snapshot(number, draft.schema, draft.partition_by, draft.folders, draft.written)
    if name is not None:
        show_by_name(spark, name, path, published)
    return published


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def show_by_name(spark: SparkSession, name: str, path: str, found: Snapshot) -> None:
    """Let ``name`` (database.table) show a version: an external table for its files, then one replacement of the view."""
    backing = f"{name}__v{found.number}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
    folders = sorted(set(found.folders.values()))
    location = f"{path}/{folders[0]}" if not found.partition_by and folders else path
    parts = f" PARTITIONED BY (`{found.partition_by}`)" if found.partition_by else ""
    spark.sql(f"DROP TABLE IF EXISTS {backing}")  # external: its files stay
    spark.sql(f"CREATE TABLE {backing} ({columns}) USING parquet{parts} LOCATION {_quoted(location)}")
    if found.partition_by:
        clauses = []
        for part, version in sorted(found.folders.items()):
            value = unquote(part.split("=", 1)[1])
            literal = "NULL" if value == NO_VALUE else _quoted(value)
            clauses.append(f"PARTITION (`{found.partition_by}`={literal}) LOCATION {_quoted(f'{path}/{version}/{part}')}")
        for first in range(0, len(clauses), PARTITIONS_A_STATEMENT):
            spark.sql(f"ALTER TABLE {backing} ADD " + " ".join(clauses[first : first + PARTITIONS_A_STATEMENT]))
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # a plain external table of before; its files stay
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(f'`{c}`' for c in found.schema.fieldNames())} FROM {backing}")


def replace_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    cluster_by: Sequence[str] = (),
    accept: Callable[[DataFrame], None] | None = None,
    name: str | None = None,
    laid_out: bool = False,
) -> Snapshot:
    """Publish ``df`` as the whole table. The version before stays readable until it is pruned."""
    before = snapshot(df.sparkSession, path)
    draft = write_version(df, path, partition_by, cluster_by, accept, laid_out)
    return _publish_or_discard(df.sparkSession, path, draft, draft, before, name)


def _publish_or_discard(spark, path: str, draft: Snapshot, whole: Snapshot, before: Snapshot | None, name: str | None) -> Snapshot:
    try:
        return publish_snapshot(spark, path, whole, before.number if before else 0, name)
    except ConcurrentPublish:
        discard(spark, path, draft)
        raise


def upsert_table(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    key: str = "fee_id",
    partition_col: str = "fee_date",
    cluster_by: Sequence[str] = (),
    name: str | None = None,
) -> Snapshot | None:
    """Update rows whose ``key`` matches and insert the others, as ``upsert_by_partition`` does, in one published step.

    Only the dates of ``incoming`` are read and written, to a new version folder; the other partitions stay where
    they are and are named again in the manifest. Readers see all the dates change at once.
    """
    incoming = incoming.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = _refuse_repeated_keys(incoming, key, partition_col)  # one row per touched date
        before = snapshot(spark, path)
        if before is None:
            return replace_table(incoming, path, partition_col, cluster_by, name=name)
        if not touched:
            return before
        parts = [f"{partition_col}={d}" for d in touched]
        held = {p: before.folders[p] for p in parts if p in before.folders}
        merged = incoming
        if held:
            current = read_snapshot(spark, path, Snapshot(before.number, before.schema, partition_col, held, {}))
            kept = current.join(incoming.select(key), key, "left_anti").select(*current.columns)
            merged = align_schema(kept, incoming)
        else:
            merged = align_schema(spark.createDataFrame([], before.schema), incoming)
        draft = write_version(merged, path, partition_col, cluster_by)
        folders = before.folders | draft.folders
        written = {v: n for v, n in (before.written | draft.written).items() if v in set(folders.values())}
        whole = Snapshot(0, merged.schema, partition_col, folders, written)
        return _publish_or_discard(spark, path, draft, whole, before, name)
    finally:
        incoming.unpersist()


def restore_snapshot(spark: SparkSession, path: str, number: int, name: str | None = None) -> Snapshot:
    """Publish an earlier version again, as the newest one; no file is written but the manifest."""
    old, newest = snapshot(spark, path, number), snapshot(spark, path)
    if old is None or newest is None:
        raise ValueError(f"{path} has no version {number}")
    return publish_snapshot(spark, path, old, newest.number, name)


def prune_versions(spark: SparkSession, path: str, keep: int = 2, name: str | None = None) -> list[str]:
    """Delete all but the ``keep`` newest versions, and the files that only they name; returns the deleted folders.

    Call it when no reader can still hold an older version, and while no other writer is at work on the table.
    """
    numbers = snapshot_numbers(spark, path)
    kept = [s for n in numbers[-keep:] if (s := _read_manifest(spark, path, n)) is not None]
    if not kept:
        return []
    for number in numbers[:-keep]:
        fs, file = hadoop_path(spark, f"{path}/{MANIFESTS}/{number:08d}.json")
        fs.delete(file, False)
        if name is not None:
            spark.sql(f"DROP TABLE IF EXISTS {name}__v{number}")
    named = {(p, v) for s in kept for p, v in s.folders.items()}
    versions = {v for _, v in named}
    fs, table = hadoop_path(spark, path)
    deleted = []
    for status in fs.listStatus(table):
        version = status.getPath().getName()
        if not version.startswith("version="):
            continue
        if version not in versions:
            deleted.append(version)
        elif ("", version) not in named:
            parts = [s.getPath().getName() for s in fs.listStatus(status.getPath())]
            deleted += [f"{version}/{p}" for p in parts if "=" in p and (p, version) not in named]
    for folder in deleted:
        _, target = hadoop_path(spark, f"{path}/{folder}")
        fs.delete(target, True)
    return deleted
