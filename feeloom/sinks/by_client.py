"""Tables laid out by client: written with one exchange, so that client-wise models over them need none."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feeloom.operators.skew import ROWS_PER_TASK, heavy_keys


@dataclass(frozen=True)
class ClientLayout:
    """A table in two parts, by name: ``even`` is bucketed and sorted by ``key``; ``heavy`` holds the keys too large for it.

    A bucket is read by one task, so a key with a large share of the rows does not go into a bucket. Models of disjoint
    keys are computed for each part and united.
    """

    name: str
    key: str
    buckets: int

    def even(self, spark: SparkSession) -> DataFrame:
        return spark.table(f"{self.name}_even")

    def heavy(self, spark: SparkSession) -> DataFrame:
        return spark.table(f"{self.name}_heavy")


def write_by_client(
    df: DataFrame, name: str, path: str, buckets: int, key: str = "client_id", sort_by: tuple[str, ...] = (), rows_per_task: int = ROWS_PER_TASK
) -> ClientLayout:
    """Write ``df`` below ``path`` as the catalog tables ``<name>_even`` and ``<name>_heavy``.

    The one exchange deals rows by the hash that buckets use, so each bucket is one file. ``buckets``: choose the bytes
    of the table over the bytes a task should read, and the same number for all tables that meet.
    """
    spark = df.sparkSession
    # At most 16 keys for each shuffle partition.
    heavy = F.broadcast(heavy_keys(df, key, rows_per_task).select(key))
    even = df.join(heavy, key, "left_anti").repartition(buckets, key)
    parts = {"even": even.write.bucketBy(buckets, key).sortBy(key, *sort_by), "heavy": df.join(heavy, key, "left_semi").write}
    for part, writer in parts.items():
        spark.sql(f"DROP TABLE IF EXISTS {name}_{part}")
        writer.mode("overwrite").format("parquet").option("path", f"{path}/{part}").saveAsTable(f"{name}_{part}")
    return ClientLayout(name, key, buckets)


def write_model(even: DataFrame, heavy: DataFrame, like: ClientLayout, name: str, path: str) -> ClientLayout:
    """Write a model of ``like``'s two parts in the same layout; the even part lies by bucket already, so nothing is dealt out."""
    spark = even.sparkSession
    for part, writer in {"even": even.write.bucketBy(like.buckets, like.key).sortBy(like.key), "heavy": heavy.write}.items():
        spark.sql(f"DROP TABLE IF EXISTS {name}_{part}")
        writer.mode("overwrite").format("parquet").option("path", f"{path}/{part}").saveAsTable(f"{name}_{part}")
    return ClientLayout(name, like.key, like.buckets)
