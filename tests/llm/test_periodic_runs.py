"""The periodic run detector against brute force."""

from __future__ import annotations

import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from feeloom.llm import periodic_runs


def brute_runs(words, least=12):
    """Every diagonal in full; of those with the same ends the shortest period counts."""
    n, shortest = len(words), {}
    for lag in range(1, n // 2 + 1):
        i = lag
        while i < n:
            first = i
            while i < n and words[i] == words[i - lag]:
                i += 1
            if i - first + lag >= max(least, 2 * lag):
                shortest.setdefault((first - lag, i), lag)
            i += 1
    return sorted((a, b - a, lag) for (a, b), lag in shortest.items())


def made(rng):
    letters = rng.choice([1, 2, 2, 3, 4])
    words = [rng.randrange(letters) for _ in range(rng.randrange(1, 60))] if rng.random() < 0.3 else []
    while len(words) < rng.randrange(20, 300):
        block = [rng.randrange(letters) for _ in range(rng.randrange(1, 12))] * rng.randrange(1, 6)
        words += block[: rng.randrange(1, 70)]
        if rng.random() < 0.2:
            words += words[-rng.randrange(1, len(words) + 1) :]
    return words[:400]


def test_runs_against_brute_force():
    rng = random.Random(11)
    for _ in range(1500):
        words, least = made(rng), rng.choice([12, 12, 2, 3, 5, 8, 13])
        assert periodic_runs.find_runs(np.array(words, dtype=np.int64), least) == brute_runs(words, least), (words, least)


def test_strings_with_many_runs():
    a, b = [0], [1]
    while len(b) < 500:
        a, b = b, b + a
    assert periodic_runs.find_runs(np.array(b), 2) == brute_runs(b, 2)
    flips = [bin(i).count("1") % 2 for i in range(512)]
    assert periodic_runs.find_runs(np.array(flips), 2) == brute_runs(flips, 2)


@pytest.mark.parametrize("words", [
    [0] * 300_000, [*range(20)] * 15_000, ([0] * 12 + [*range(1, 9)]) * 15_000,
    sum([[*range(10)] + [10 + i] * (i % 19) for i in range(15_000)], []),
], ids=["one word", "one line", "runs in a run", "a line at uneven gaps"])
def test_long_texts_take_seconds(words):
    began = time.process_time()
    runs = periodic_runs.find_runs(np.array(words))
    assert time.process_time() - began < 20
    if len(set(words)) < 21:
        assert (0, len(words), {1: 1, 9: 20, 20: 20}[len(set(words))]) in runs
    assert all(words[a : a + n - q] == words[a + q : a + n] for a, n, q in random.Random(1).sample(runs, min(20, len(runs))))


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = min(((-b, a, q) for a, b, q in runs), default=None)
    gone = {i for a, b, q in runs for i in range(a + q, a + b)}
    lines = "".join(f"{a},{b},{q}\n" for a, b, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    longest = (best[1], -best[0], best[2], -best[0] * 1000 // best[2]) if best else (None,) * 4
    return (len(runs), *longest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(), n)


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words"]


def digests(docs):
    return periodic_runs.run_digests(periodic_runs.periodic_runs(periodic_runs.with_repeated_tail(docs)))


def test_query_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 6000").select("doc_id", "text")
    tails = [i for i in range(20_000, 20_400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rng = random.Random(5)
    hard = [(i, " ".join(str(rng.randrange(k % 7 + 1)) for _ in range(rng.randrange(1, 300)))) for k, i in enumerate(tails)]
    hard += [(1_000_000 + i, " ".join(map(str, made(rng)))) for i in range(60)]
    docs = docs.unionByName(spark.createDataFrame(hard, "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = digests(docs).collect()
    assert len(got) == len(texts) and len(tails) > 20
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == expected(r["doc_id"], texts[r["doc_id"]]), r["doc_id"]
    assert sum(r["n_runs"] for r in got) > 100


def test_awkward_rows(spark):
    line = "una línea ü \U0001f600\t"
    rows = [(1, None), (2, ""), (3, " \n\t\x0b "), (4, "one"), (5, line * 30), (5, line * 30), (None, "x " * 40), (6, "a b " * 50), (7, "w" * 100_000)]
    schema = "doc_id long, text string, runs int, n_words string, collapsed int, start int"
    docs = spark.createDataFrame([(i, t, 7, "k", 7, 7) for i, t in rows], schema)
    got = sorted(((r["doc_id"] or 0, *(r[c] for c in COLUMNS)) for r in digests(docs).collect()), key=repr)
    assert got == sorted(((i or 0, *expected(i, t)) for i, t in rows), key=repr)
    found = {r["doc_id"]: r for r in periodic_runs.periodic_runs(docs).collect()}
    assert found[None]["collapsed"] == "x" and found[1]["collapsed"] == "" and found[1]["runs"] == []
    assert digests(spark.createDataFrame([], schema)).count() == 0
