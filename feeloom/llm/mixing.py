"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact cuts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeloom.llm.common import WORD, materialize, prefix_sums

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3


def _source_key(source):
    """Null sources come last and form a source of their own."""
    return [F.col(source).isNull().alias("no_source"), F.coalesce(F.col(source), F.lit("")).alias("source_name")]


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (no_source, source_name, source_size) with ahead (words of the sources before), target and budget.

    Weights go round the sources in code point order. Sorted by cap / weight, the share of one unit of weight is the
    largest (total - caps so far) / (weights left): capped sources are exactly those whose cap lies below it.
    """
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    numbered = prefix_sums(sources.withColumn("one", F.lit(1).cast("bigint")), [F.col("no_source"), F.col("source_name")],
                           ["one", "source_size"], "mix-sources")
    weighted = numbered.select(
        "no_source", "source_name", "source_size", F.col("before_source_size").alias("ahead"),
        F.element_at(cycle, (F.col("before_one") % len(weights) + 1).cast("int")).cast("bigint").alias("weight"),
    ).withColumn("cap", F.col("source_size") * max_epochs)
    weighted = materialize(weighted, "mix-weights")
    order = [(F.col("cap") / F.col("weight")), F.col("no_source"), F.col("source_name")]
    filled = prefix_sums(weighted, order, ["cap", "weight"], "mix-levels")
    # Each of the two is one row.
    totals = weighted.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    words, left = F.lit(totals["words"]) - F.col("before_cap"), F.lit(totals["weight"]) - F.col("before_weight")
    levels = filled.select(words.cast("bigint").alias("words"), left.cast("bigint").alias("left"))
    best = levels.agg(F.max_by(F.struct("words", "left"), F.struct(F.col("words") / F.col("left"), "left")).alias("level")).first()["level"]
    level_words, level_left = (F.lit(best[i] if best else 1).cast("decimal(38,0)") for i in ("words", "left"))
    share = F.col("weight") * level_words
    capped = F.col("cap") * level_left <= share
    target = F.when(capped, F.col("cap").cast("double")).otherwise(share.cast("double") / level_left.cast("double"))
    planned = weighted.withColumn("target", target)
    return planned.select(
        "no_source", "source_name", "source_size", "ahead", "target",
        F.least(F.floor(F.col("target") + 0.5).cast("bigint"), F.col("cap")).alias("budget"),
    )


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "mix") -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): doc_id, source, size, source_size, target, taken.

    Every source is put into a random order (md5 of seed, doc_id and text), summed up by distributed prefix sums, and cut
    exactly at its budget, the rounded target. A budget beyond the source repeats it in whole epochs first; the row
    at the cut gives only its first words. Null texts have size 0; a null source is a source, last in order; equal rows
    stand next to each other. No rows: an empty result. Columns beside the three are ignored.
    """
    sized = docs.select(
        "doc_id", "source", *_source_key("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        # The text tells apart rows without an id, or of one id, which would else meet in one range.
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce("text", F.lit(""))))).alias("key"),
    )
    # Written first: the range sort reads its input twice, and needs no texts.
    sized = materialize(sized, "mix-sizes")
    order = [F.col("no_source"), F.col("source_name"), F.col("key"), F.col("doc_id"), F.col("size")]
    placed = materialize(prefix_sums(sized, order, ["size"], "mix-order"), "mix-placed")
    sources = placed.groupBy("no_source", "source_name").agg(F.sum("size").alias("source_size"))
    plan = materialize(source_targets(sources, weights, max_epochs), "mix-plan")
    joined = placed.join(plan, ["no_source", "source_name"])
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    rest = F.col("budget") - F.col("epochs") * F.col("source_size") - (F.col("before_size") - F.col("ahead"))
    part = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), rest))
    return joined.withColumn("epochs", epochs).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).alias("taken")
    )
