"""File-arrival ingest: stage the fees of files that were not seen before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from feeloom.operators.staging import stage_fees
from feeloom.schemas import FEE_SCHEMA
from feeloom.sinks.tables import upsert_by_partition
from feeloom.sources.csv_files import require_not_null
from feeloom.sources.tables import table_exists


def stage_arrivals(
    spark: SparkSession,
    folder: str,
    staged_path: str,
    checkpoint: str,
    max_files_per_batch: int = 1000,
    quoted_newlines: bool = True,
) -> StreamingQuery:
    """Process the CSV files that arrived in ``folder`` since the last run, then stop.

    The batch load replaces raw by *all* files each time; this equals it only while files are immutable. A
    replayed batch upserts the same rows again, so a restart after a failure leaves the same table. The
    checkpoint must be on storage all executors see.
    """
    arriving = (
        spark.readStream.schema(FEE_SCHEMA)
        .options(header=True, enforceSchema=False, multiLine=quoted_newlines, escape='"', mode="FAILFAST")
        .option("columnPruning", False)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .csv(folder)
    )

    def upsert(batch: DataFrame, _batch_id: int) -> None:
        first = not table_exists(batch.sparkSession, staged_path)
        # Only a first load is written as it comes; later rows are gathered with those that they join.
        staged = stage_fees(require_not_null(batch), lay_out_by="fee_date" if first else None)
        upsert_by_partition(batch.sparkSession, staged_path, staged, laid_out=first)

    return (
        arriving.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
