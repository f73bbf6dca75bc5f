"""Line dedup by content-defined chunks: boundaries follow rolling hashes of line hashes; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feeloom.llm.common import materialize, packed_row, row_key, unpacked

# A line ends a chunk when the hash of it and the line before it is 0 modulo this: chunks of three lines on average.
DIVISOR = 3
HASH_BASE = 1_000_003
HASH_MODULUS = 2_147_483_647


def _chunks(text: Column, divisor: int) -> Column:
    """Chunks of a text: arrays of consecutive lines that concatenate to all lines of it."""
    lines = F.split(text, "\n", -1)
    hashes = F.transform(lines, lambda line: F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("bigint"))

    def cut(h: Column) -> Column:
        # i counts from 0; a roll spans line i and the line before it, so it moves with the text around it.
        rolled = F.transform(h, lambda x, i: F.when(i == 0, F.lit(1)).otherwise((F.get(h, i - 1) * HASH_BASE + x) % HASH_MODULUS % divisor))
        ends = F.filter(F.transform(rolled, lambda r, i: F.when((r == 0) | (i == F.size(h) - 1), i)), lambda i: i.isNotNull())
        return ends

    # The one-element arrays bind an expression once, as a lambda variable.
    bound = F.struct(lines.alias("lines"), cut_once(hashes, cut).alias("ends"))
    return F.flatten(F.transform(F.array(bound), lambda b: F.transform(
        b["ends"],
        lambda end, k: F.slice(
            b["lines"],
            (F.when(k == 0, F.lit(0)).otherwise(F.get(b["ends"], k - 1) + 1) + 1).cast("int"),
            (end - F.when(k == 0, F.lit(-1)).otherwise(F.get(b["ends"], k - 1))).cast("int"),
        ),
    )))


def cut_once(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _long(chunk: Column) -> Column:
    """Chunks of two lines or more that are not all blank."""
    return (F.size(chunk) >= 2) & F.exists(chunk, lambda line: F.trim(line) != "")


def dedup_lines(docs: DataFrame, divisor: int = DIVISOR, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` (all columns kept) with text cut and n_lines, n_removed_lines, n_removed_chunks added.

    A chunk of two or more lines, not all blank, that occurs more than once in the corpus stays at its first
    occurrence, by (doc_id, place), and is removed everywhere else; rows without an id come last. Digests find the
    candidates; occurrences are the same only if their bytes are. Rows of one doc_id and text, or of one text without
    an id, count as one document; other texts of a repeated id are documents of their own, by hash. Null texts stay null with 0 lines, empty
    ones have one line; a document may lose all lines and then has an empty text. No rows: an empty result. The three
    added columns replace columns of the same names.
    """
    docs = docs.drop("n_lines", "n_removed_lines", "n_removed_chunks")
    base = docs.select(packed_row(docs).alias("row"), row_key(F.col(id_col), F.col("text")).alias("key"), F.col(id_col).alias("id"), "text")
    keyed = base.select("key", "id", "text").where(F.col("text").isNotNull() & F.contains("text", F.lit("\n")))
    cut = keyed.select("key", F.posexplode(_chunks(F.col("text"), divisor)).alias("place", "chunk"))
    digests = cut.where(_long(F.col("chunk"))).select("key", "place", F.md5(F.array_join("chunk", "\n")).alias("digest"))
    digests = materialize(digests, "line-digests")
    often = digests.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    marks = digests.join(often, "digest").groupBy("key").agg(F.collect_set("place").alias("places"))
    marked = keyed.join(marks, "key").select("key", "id", "places", _chunks(F.col("text"), divisor).alias("chunks"))
    spots = marked.select("key", "id", "chunks", F.explode("places").alias("place")).select(
        "key", "id", "place", F.array_join(F.get("chunks", F.col("place")), "\n").alias("chunk")
    )
    spots = materialize(spots, "line-candidates")
    spot = F.struct(F.col("id").isNull().alias("no_id"), "id", "key", "place")
    # Grouping by the text itself compares bytes.
    first = spots.groupBy(F.md5("chunk").alias("digest"), "chunk").agg(
        F.min(spot).alias("first"), F.count("*").alias("n")
    ).where("n > 1").select("digest", F.col("chunk").alias("same"), "first")
    again = spots.withColumn("digest", F.md5("chunk")).join(first, "digest").where(
        (F.col("chunk") == F.col("same")) & ((F.col("first.key") != F.col("key")) | (F.col("first.place") != F.col("place")))
    )
    removal = materialize(again.groupBy(F.col("key").alias("removal_key")).agg(F.collect_set("place").alias("removed_places")), "line-removals")
    joined = base.join(removal, F.col("key") == F.col("removal_key"), "left")
    chunks = _chunks(F.col("text"), divisor)
    gone = F.col("removed_places")
    kept = F.filter(F.transform(chunks, lambda c, i: F.when(~F.array_contains(gone, i), c)), lambda c: c.isNotNull())
    lost = F.filter(F.transform(chunks, lambda c, i: F.when(F.array_contains(gone, i), F.size(c))), lambda n: n.isNotNull())
    counted = joined.withColumns({
        "n_lines": F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(F.split("text", "\n", -1))).cast("bigint"),
        "lost_lines": F.when(gone.isNotNull(), lost),
        "kept_text": F.when(gone.isNull(), F.col("text")).otherwise(F.array_join(F.flatten(kept), "\n")),
    })
    lines_lost = F.aggregate("lost_lines", F.lit(0), lambda a, x: a + x)
    return counted.select(
        *unpacked(docs, text=F.col("kept_text")), "n_lines",
        F.coalesce(lines_lost, F.lit(0)).cast("bigint").alias("n_removed_lines"),
        F.coalesce(F.size("lost_lines"), F.lit(0)).cast("bigint").alias("n_removed_chunks"),
    )
