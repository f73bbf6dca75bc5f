"""The prefix trie against brute force: rebuilt conversations, deep chains, many copies, awkward rows."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from feeloom.llm import prefix_trie
from feeloom.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, rebuild=True):
    own: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    convs = dict(own)
    if rebuild:
        for c, v in own.items():
            h = zlib.crc32(str(c).encode()) % 6
            convs[c] = own.get(c - c % 100, [])[:h] + v[h:]
    members: dict[tuple, list] = {}
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    kids: dict[tuple, list] = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    totals, out = {}, []
    for node in sorted(members, key=len, reverse=True):
        below = [totals[k] for k in kids.get(node, [])]
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        totals[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    for node, convs_here in members.items():
        ends = ",".join(map(str, sorted(c for c in convs_here if len(convs[c]) == len(node))))
        out.append((min(convs_here), len(node), min(members[node[:-1]]) if node else None, len(convs_here), len(kids.get(node, [])),
                    *totals[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def report(paths):
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie.trie_report(paths).collect()), key=repr)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_prefix_trie"](spark, sf).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=repr) == brute(rows)


def made(rng):
    """Chains, combs and stars: one conversation of 90 turns, its cut and forked copies, and many that share a beginning."""
    long = [("user", f"turn {i}") for i in range(90)]
    convs = [long[:k] + [("user", "x")] * (k % 3) for k in (90, 90, 45, 30, 3)] + [long[:k] for k in range(0, 20, 3)]
    convs += [[("system", "same"), ("user", str(rng.randrange(9)))] + [("user", str(rng.randrange(2)))] * rng.randrange(4) for _ in range(80)]
    convs += [[("user", str(rng.randrange(2))) for _ in range(rng.randrange(9))] for _ in range(60)]
    ids = rng.sample(range(900), len(convs))
    return [(c, i, *turn) for c, v in zip(ids, convs, strict=True) for i, turn in enumerate(v)]


@pytest.mark.parametrize("rebuild", [False, True])
def test_made_tries(spark, rebuild):
    rows = made(random.Random(7))
    turns = spark.createDataFrame(rows, SCHEMA).repartition(5)
    paths = prefix_trie.rebuild_conversations(turns) if rebuild else prefix_trie.conversation_paths(turns)
    assert report(paths) == brute(rows, rebuild)


def test_awkward_rows(spark):
    rows = [
        (0, 1, None, "one"), (0, None, "user", None), (0, 2, "user", "two"), (0, 2, "user", "two"), (0, 2, "", "two"),
        (100, 5, "user", "ü\U0001f600" * 50), (7, 0, "user", "short"), (230, 1, "a", ""), (None, 1, "user", "of no conversation"),
        (101, 1, "user", "long " * 50_000), (101, 2, "user", "end"), (101, 3, "user", "end"), (101, 4, "x", "end"), (2**40 + 3, 1, "user", "far"),
    ] + [(100 + k, 9, "user", "z") for k in range(2, 12)]
    schema = SCHEMA + ", place string, depth int, size string, a int, b int, u int, leaves string, one string"
    turns = spark.createDataFrame([(*r, "k", 7, "k", 7, 7, 7, "k", "k") for r in rows], schema)
    assert report(prefix_trie.rebuild_conversations(turns)) == brute(rows)
    assert report(prefix_trie.conversation_paths(turns)) == brute(rows, rebuild=False)
    assert prefix_trie.trie_report(prefix_trie.rebuild_conversations(spark.createDataFrame([], schema))).count() == 0


def test_one_conversation_is_cut_over_many_tasks(spark):
    turns = spark.range(4000).select(F.lit(5).cast("long").alias("conv_id"), (4000 - F.col("id")).alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    placed = prefix_trie.number_turns(turns)
    assert sorted(r["place"] for r in placed.collect()) == list(range(4000))
    rows = placed.withColumn("part", F.spark_partition_id())
    summed = prefix_trie.running_totals(rows.select("conv_id", "place"), "conv_id", [F.col("place")], ["place"], "test-totals")
    assert summed.where(F.col("run_place") != F.col("place") * (F.col("place") + 1) / 2).count() == 0


def test_members_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    members = spark.range(1000).select((F.col("id") % 3).alias("u"), F.lit(0).cast("long").alias("v"), (F.col("id") * 37 % 1009).alias("conv_id"))
    got = {r["u"]: r["ends_sha256"] for r in prefix_trie.digest_members(members).collect()}
    for u in range(3):
        ids = sorted(i * 37 % 1009 for i in range(1000) if i % 3 == u)
        assert got[u] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_contraction_takes_few_rounds(spark):
    """A chain of 600 nodes: rounds grow with the logarithm of the depth."""
    nodes = spark.range(600).select(
        F.col("id").alias("u"), F.lit(1).cast("long").alias("v"), F.when(F.col("id") > 0, F.col("id") - 1).alias("pu"),
        F.when(F.col("id") > 0, F.lit(1)).cast("long").alias("pv"), F.col("id").alias("depth"), F.col("id").alias("weight"),
    )
    calls = []
    write = prefix_trie.materialize

    def counted(df, purpose):
        calls.append(purpose)
        return write(df, purpose)

    prefix_trie.materialize, kept = counted, write
    try:
        got = {r["u"]: (r["n_leaves"], r["total"]) for r in prefix_trie.contract(nodes).collect()}
    finally:
        prefix_trie.materialize = kept
    assert got == {u: (1, sum(range(u, 600))) for u in range(600)}
    assert calls.count("trie-raked") <= 12
