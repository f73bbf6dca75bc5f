"""Token counts of very long and odd texts, and the whole histogram against brute force."""

from __future__ import annotations

import random
import time
from collections import Counter

import pytest

from feeloom.llm import token_counts
from feeloom.llm.queries import QUERIES

ENCODER = token_counts._encoder(token_counts.RANKS, token_counts.PATTERN)


def test_split_runs_count_as_the_encoder_does():
    rng = random.Random(9)
    blanks = ["\n", " ", "\t", "\xa0", " ", "\r\n", "\x1c", "\x85"]
    for _ in range(300):
        text = "".join(rng.choice(["", "word", " 12", "?!", "é", "\U0001f600", "'s"]) + rng.choice(blanks) * rng.choice([1, 2, 999, 1000, 1001, 1500]) for _ in range(rng.randrange(1, 5)))
        text += rng.choice(["", "end", " end", "."])
        assert token_counts.count_tokens(ENCODER, text) == len(ENCODER.encode_ordinary(text)), repr(text[:50])


@pytest.mark.parametrize("text", ["a" + " " * 1_000_000, " " * 1_000_000 + "a", "x\n" + "\n" * 1_000_000 + "\ty", "a" * 1_000_000, "7" * 1_000_000, "." * 1_000_000, "\U0001f600" * 300_000, "a 1 ." * 200_000])
def test_a_million_characters_of_one_class(text):
    began = time.process_time()
    assert token_counts.count_tokens(ENCODER, text) > 0
    assert time.process_time() - began < 20


def test_histogram_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    lengths = [len(ENCODER.encode_ordinary(t)) for t in texts]
    got = {r["context_limit"]: r for r in QUERIES["op9_token_counts"](spark, sf).collect()}
    assert {k: r["n_docs"] for k, r in got.items()} == Counter(lengths)
    for limit, r in got.items():
        assert r["docs_within"] == sum(n <= limit for n in lengths) and r["tokens_over"] == sum(n for n in lengths if n > limit)
        assert r["tokens_truncated"] == sum(min(n, limit) for n in lengths) and r["total_tokens"] == sum(lengths)
        assert r["quantile"] == sum(n <= limit for n in lengths) / len(lengths)


def test_a_long_run_of_blanks_is_a_row(spark):
    docs = spark.createDataFrame([(1, "a" + " " * 1_000_000), (2, None), (2, None), (3, "a")], "doc_id long, text string")
    assert sorted(r["n_tokens"] for r in token_counts.token_lengths(docs).collect())[:3] == [0, 0, 1]
