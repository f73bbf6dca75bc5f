"""Hadoop file system access, so paths work on any store the session is configured for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """(file system, Path) for ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def glob_size(spark: SparkSession, glob: str) -> int:
    """Bytes of the files, and below the folders, that ``glob`` matches."""
    fs, target = hadoop_path(spark, glob)
    return sum(fs.getContentSummary(status.getPath()).getLength() for status in fs.globStatus(target) or [])


def size_on_disk(spark: SparkSession, path: str) -> tuple[int, int]:
    """(bytes, files) below ``path``."""
    fs, target = hadoop_path(spark, path)
    summary = fs.getContentSummary(target)
    return summary.getLength(), summary.getFileCount()
