"""Layered Parquet tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feeloom.sources.files import hadoop_path

DEFAULT_LAYER = "staging"


def table_path(root: str, model: str, layer: str | None = None) -> str:
    """Folder of a model: its declared layer verbatim, else the default layer."""
    return f"{root.rstrip('/')}/{(layer or DEFAULT_LAYER).strip()}/{model}"


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return fs.exists(target)


def read_table(
    spark: SparkSession, path: str, schema: StructType | None = None, merge_schema: bool = False
) -> DataFrame:
    """Read a table. A declared schema fixes types and column order (a partition column would come last, with
    an inferred type) and skips footer merging; ``merge_schema`` finds appended columns when none is declared.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def partition_folder(path: str, column: str, value: dt.date) -> str:
    return f"{path}/{column}={value.isoformat()}"


def read_partitions(spark: SparkSession, path: str, column: str, dates: Sequence[dt.date]) -> DataFrame | None:
    """The rows of the given dates of a table partitioned by ``column``, with every column their files have; None
    if the table has none of the dates.

    Only those folders are listed and opened, so the cost does not depend on the size of the table.
    """
    folders = [f for f in (partition_folder(path, column, d) for d in dates) if table_exists(spark, f)]
    if not folders:
        return None
    return spark.read.option("basePath", path).option("mergeSchema", True).parquet(*folders)


def newest_partition(spark: SparkSession, path: str, column: str = "fee_date") -> dt.date | None:
    """high_water_mark() of a table partitioned by the date ``column``, from its folder names.

    Opens only the newest folder that holds rows, where the aggregate would open every file's footer.
    """
    fs, target = hadoop_path(spark, path)
    prefix = f"{column}="
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    dates = [n.removeprefix(prefix) for n in names if n.startswith(prefix)]
    for date in sorted((d for d in dates if d[0].isdigit()), reverse=True):
        folder = spark.read.schema("_ string").parquet(f"{path}/{prefix}{date}")  # any schema: rows are counted
        if not folder.isEmpty():
            return dt.date.fromisoformat(date)
    return None


def high_water_mark(target: DataFrame, column: str = "fee_date") -> dt.date | None:
    """Largest value of ``column``; None for an empty table, which callers read as 'no bound'."""
    return target.agg(F.max(column)).first()[0]
