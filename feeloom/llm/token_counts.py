"""Token counts by an exact length histogram: one row per length answers every context limit."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeloom.llm.common import materialize, prefix_sums

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# Fixed value: the code points that the pattern's \s matches. The runs of it that are split before the encoder sees them.
LONG_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")


def count_tokens(encoder, text: str) -> int:
    """Tokens of a text under PATTERN, of any length.

    The pattern backtracks over a run of white space, and overflows its stack on a run of a million. A run is one piece
    up to its last character, which goes with what follows, or up to its end at the end of the text: so it is encoded as that
    piece, without the pattern, and the count stays the same.
    """
    total = start = 0
    for run in LONG_BLANKS.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        total += len(encoder.encode_ordinary(text[start : run.start()]))
        total += len(encoder._encode_single_piece(text[run.start() : end]))
        start = end
    return total + len(encoder.encode_ordinary(text[start:]))


def _encoder(ranks: str, pattern: str):
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def token_lengths(docs: DataFrame, ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """n_tokens of every whole text, a row for each row; null and empty texts have 0.

    ``ranks`` is a local path on every executor. Texts may be of any length under PATTERN; a pattern of your own must
    itself bear long runs. Repeated rows count each time.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks, pattern)
        for batch in batches:
            texts = (t.as_py() or "" for t in batch.column(0))
            lengths = [count_tokens(encoder, t) if pattern == PATTERN else len(encoder.encode_ordinary(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], ["n_tokens"])

    return docs.select("text").mapInArrow(count, "n_tokens bigint")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """From rows with n_tokens: one row per length L, which also holds the answers for a context limit of L.

    n_docs: documents of this length. docs_within, tokens_within: documents of at most L tokens and their tokens.
    docs_over, tokens_over: the longer ones. tokens_truncated: what is left of all when each is cut after L tokens.
    quantile: share of documents of at most L tokens. total_docs, total_tokens: of all. Between two lengths the
    answers follow from the row below: tokens_truncated grows by docs_over per token.
    """
    counts = materialize(
        lengths.where(F.col("n_tokens").isNotNull()).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))
        .withColumn("tokens", F.col("n_docs") * F.col("n_tokens")), "lengths",
    )
    # Suffix sums are prefix sums of the descending order.
    summed = prefix_sums(counts, [F.col("n_tokens").desc()], ["n_docs", "tokens"], "length-sums")
    totals = counts.agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("tokens")).first()  # one row
    rows = summed.withColumns({
        "docs_over": F.col("before_n_docs"), "tokens_over": F.col("before_tokens"),
        "total_docs": F.lit(totals["docs"]).cast("bigint"), "total_tokens": F.lit(totals["tokens"]).cast("bigint"),
    })
    return rows.select(
        F.col("n_tokens").alias("context_limit"), "n_docs",
        (F.col("total_docs") - F.col("docs_over")).alias("docs_within"),
        (F.col("total_tokens") - F.col("tokens_over")).alias("tokens_within"),
        "docs_over", "tokens_over",
        (F.col("total_tokens") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens")).alias("tokens_truncated"),
        ((F.col("total_docs") - F.col("docs_over")) / F.col("total_docs")).alias("quantile"),
        "total_docs", "total_tokens",
    )


def token_counts(docs: DataFrame, ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """The length histogram of ``docs`` (text). No rows: an empty result. Other columns are ignored."""
    return length_histogram(token_lengths(docs, ranks, pattern))
