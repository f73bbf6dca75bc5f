"""A training-data pipeline over the documents table: five stages, each written as Parquet before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feeloom.llm import decontamination, jaccard_join, line_dedup, mixing, toxicity
from feeloom.llm.common import materialize, packed_row, read_table, unpacked


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model does not reject; it learns from the labels of documents outside the held-out fold."""
    scores = toxicity.train_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, scores)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the multi-line chunks that occurred before; n_chars follows the text."""
    cut = line_dedup.dedup_lines(docs.select("doc_id", "text", packed_row(docs).alias("row")))
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return cut.select(*unpacked(docs, **{c: v for c, v in changed.items() if c in docs.columns}))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return jaccard_join.keep_first_of_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: doc_id, source, size, source_size, target, taken."""
    return mixing.mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_repeated_lines),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mix", mix),
]

# Models, tokens and alignments are beyond SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; every result is written to the shared scratch folder and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
