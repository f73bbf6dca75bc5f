"""Secret scan of very long texts: results do not depend on where the blocks of an array end."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from feeloom.llm import secrets
from tests.llm.test_operators import brute_spans

BLOCK = secrets.BLOCK


@pytest.mark.parametrize("count", [0, 1, BLOCK - 1, BLOCK, BLOCK + 1, 5 * BLOCK + 3])
def test_many_matches_against_brute_force(spark, count):
    rng = random.Random(count)
    parts = [rng.choice(["%032x" % rng.getrandbits(128), "é token=%s" % ("ab" * 5), "AKIA" + "Q7" * 8]) for _ in range(count)]
    text = " - ".join(parts)
    row = secrets.scan_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string"), [0.0] * secrets.WIDTH**2).first()
    want = ",".join(f"{k}:{a}:{b}" for a, _, k, b in brute_spans(text))
    assert row["spans"] == want and row["n_random"] == 0


def test_tokens_in_one_long_run(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ratios = secrets.train_ratios(secrets.labelled_samples(spark, docs))
    rng = random.Random(2)
    word = "the_documentation_of_the_international_organization_and_other_information_"
    text, places = "", []
    for _ in range(3 * BLOCK // 16):
        text += word
        places.append(len(text))
        text += "".join(rng.choice(secrets.ALPHABET[:62]) for _ in range(40)) + "/"
    row = secrets.scan_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string"), ratios).first()
    spans = [tuple(map(int, s.split(":")[1:])) for s in row["spans"].split(",")]
    assert len(spans) == len(places)
    assert all(abs(a - p) <= 8 and abs(b - p - 40) <= 8 for (a, b), p in zip(spans, places, strict=True))


def test_pieces_between_base_spans_of_one_run(spark):
    rng = random.Random(4)
    hexes = 2 * BLOCK + 5
    text = "".join("%032x" % rng.getrandbits(128) + "GHIJ" * rng.randint(1, 6) for _ in range(hexes))
    frame = spark.createDataFrame([(text,)], "text string")
    runs, base = (secrets._matches(F.col("text"), p, p) for p in (secrets.RUN, secrets.HEX))
    pieces = frame.select(secrets._outside(runs, base).alias("p")).first()["p"]
    covered = [False] * len(text)
    for a, _, _, b in brute_spans(text):
        covered[a:b] = [True] * (b - a)
    want, start = [], None
    for i, gone in enumerate([*covered, True]):
        if not gone and start is None:
            start = i
        elif gone and start is not None:
            if i - start >= 16:
                want.append((start, i, text[start:i]))
            start = None
    assert [(p["start"], p["end"], p["bytes"].decode()) for p in pieces] == want
    assert all(p["cut"] for p in pieces)


def test_a_megabyte_takes_seconds(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices(secrets.ALPHABET[:62], k=1_000_000)), " ".join("%040x" % rng.getrandbits(160) for _ in range(20_000)), "-" * 1_000_000]
    ratios = [0.7] * secrets.WIDTH**2
    begin = time.time()
    rows = secrets.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), ratios).drop("text").collect()
    assert {r["doc_id"]: (r["n_hex"], r["n_random"]) for r in rows} == {0: (0, 1), 1: (20_000, 0), 2: (0, 0)}
    assert time.time() - begin < 120  # minutes to hours when the work grew with the square
