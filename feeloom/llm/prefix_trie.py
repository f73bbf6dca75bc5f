"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns; its key is 128 bits of position-wise turn hashes summed along the
conversation, so that keys come from distributed prefix sums and a conversation of any length is cut over many
tasks. The tree is contracted in join rounds. A round rakes: every leaf adds what it has gathered to its parent and goes.
Then it compresses: of a chain of nodes with one child each, every second one is spliced out, and the edge around
it carries what it had gathered. Rounds grow with the logarithm of the nodes, not with the depth. When the root alone
is left the rounds are undone in reverse: a spliced node's subtree total is its own gathering plus its child's total.
Keys, counts and sizes are moved, never texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feeloom.llm.common import materialize, shuffle_partitions

GROUP, MOST = 100, 5  # conversations that share a beginning, and how many turns of it at most
PIECE_IDS = 1 << 16
HEAD = 64


def running_totals(df: DataFrame, group: str, order: list[Column], values: list[str], purpose: str) -> DataFrame:
    """``df`` with ``run_<value>``: the sum over the rows of ``group`` (never null) up to and with this one in ``order``.

    Rows are dealt out by ranges of (group, order), so a large group is cut over many tasks. Only the first group of a
    range can have begun before it, so the table of shifts has two rows for each shuffle partition at most.
    """
    n = shuffle_partitions(df.sparkSession)
    ranged = materialize(df.repartitionByRange(n, F.col(group), *order).withColumn("range_id", F.spark_partition_id()), purpose)
    pieces = ranged.groupBy("range_id", group).agg(*[F.sum(v).alias(f"sum_{v}") for v in values])
    pieces = materialize(pieces, f"{purpose}-pieces")
    begun_before = pieces.groupBy("range_id").agg(F.min(group).alias(group)).select(group).distinct()
    ahead = Window.partitionBy(group).orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    shifts = pieces.join(F.broadcast(begun_before), group).select(  # one row for each shuffle partition
        "range_id", group, *[F.sum(f"sum_{v}").over(ahead).alias(f"shift_{v}") for v in values]
    )
    within = Window.partitionBy("range_id", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = ranged.withColumns({f"inside_{v}": F.sum(v).over(within) for v in values})
    joined = inside.join(F.broadcast(shifts), ["range_id", group], "left")
    totals = [(F.col(f"inside_{v}") + F.coalesce(f"shift_{v}", F.lit(0))).alias(f"run_{v}") for v in values]
    return joined.select(*df.columns, *totals)


def number_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 0), a, b (hashes of role and text), chars: the turns of every conversation in order.

    Null turns come first; turns of one number are ordered by role, the first characters of the text and its hash.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digests = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), F.substring(text, 1, HEAD).alias("head"),
        F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"),
        F.length(text).cast("bigint").alias("chars"), F.rand().alias("salt"), F.lit(1).alias("one"),
    )
    # Written, so that the salt, which parts equal rows of one conversation, is drawn once.
    digests = materialize(digests, "trie-turns")
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("a"), F.col("b"), F.col("salt")]
    numbered = running_totals(digests, "conv_id", order, ["one"], "trie-order")
    return materialize(numbered.select("conv_id", (F.col("run_one") - 1).alias("place"), "a", "b", "chars"), "trie-places")


def _root() -> Column:
    return F.struct(*[F.lit(0).cast("bigint").alias(c) for c in ("depth", "a", "b", "chars")])


def conversation_paths(turns: DataFrame) -> DataFrame:
    """conv_id, depth, a, b, chars, is_end: the root (depth 0) and every turn of each conversation of ``turns``."""
    placed = number_turns(turns)
    sizes = materialize(placed.groupBy("conv_id").agg(F.count("*").alias("size")), "trie-sizes")
    roots = sizes.select("conv_id", "size", _root().alias("x")).select("conv_id", "size", "x.*")
    rows = placed.join(sizes, "conv_id").select("conv_id", "size", (F.col("place") + 1).alias("depth"), "a", "b", "chars")
    return roots.unionByName(rows).select("conv_id", "depth", "a", "b", "chars", (F.col("depth") == F.col("size")).alias("is_end"))


def rebuild_conversations(turns: DataFrame, group: int = GROUP, most: int = MOST) -> DataFrame:
    """The paths (see ``conversation_paths``) of conversations that begin with turns of the first one of their group.

    Conversation c begins with the first h turns of c - c % group (all if it has fewer, none if it is absent), and goes on
    with its own turns after its first h; h is the crc32 of c modulo most + 1. It may be left without turns.
    """
    placed = number_turns(turns)
    sizes = placed.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    turn = F.struct("place", "a", "b", "chars")
    # ``most`` rows of a conversation at most are gathered.
    firsts = placed.where((F.col("conv_id") % group == 0) & (F.col("place") < most)).groupBy(F.col("conv_id").alias("base"))
    firsts = firsts.agg(F.sort_array(F.collect_list(turn)).alias("first"))
    convs = sizes.withColumns({
        "h": (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int"), "base": F.col("conv_id") - F.col("conv_id") % group,
    })
    convs = convs.join(firsts, "base", "left").withColumn("begin", F.slice(F.coalesce("first", F.array().cast("array<struct<place:bigint,a:bigint,b:bigint,chars:bigint>>")), F.lit(1), F.col("h")))
    convs = convs.withColumn("n_begin", F.size("begin").cast("bigint"))
    size = F.col("n_begin") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))
    convs = materialize(convs.select("conv_id", "h", "begin", "n_begin", size.alias("size")), "trie-convs")
    begun = F.transform("begin", lambda x: F.struct((x["place"] + 1).alias("depth"), x["a"].alias("a"), x["b"].alias("b"), x["chars"].alias("chars")))
    head = convs.select("conv_id", "size", F.explode(F.concat(F.array(_root()), begun)).alias("x")).select("conv_id", "size", "x.*")
    tail = placed.join(convs.drop("begin"), "conv_id").where(F.col("place") >= F.col("h"))
    tail = tail.select("conv_id", "size", (F.col("n_begin") + F.col("place") - F.col("h") + 1).alias("depth"), "a", "b", "chars")
    return head.unionByName(tail).select("conv_id", "depth", "a", "b", "chars", (F.col("depth") == F.col("size")).alias("is_end"))


def key_paths(paths: DataFrame) -> DataFrame:
    """conv_id, depth, u, v (key of the node), pu, pv (key of its parent, null for the root), chars, is_end."""
    low = F.lit(0xFFFFFFFF).cast("bigint")
    sums = ["s1", "s2", "s3", "s4"]
    x, y = (F.xxhash64(F.lit(seed), "depth", "a", "b") for seed in (3, 4))
    # Halves of 32 bits: their sums over a conversation stay far from the ends of a long.
    halves = [x.bitwiseAND(low), F.shiftrightunsigned(x, 32), y.bitwiseAND(low), F.shiftrightunsigned(y, 32)]
    is_root = F.col("depth") == 0
    hashed = paths.select("conv_id", "depth", "chars", "is_end", *[F.when(is_root, F.lit(0).cast("bigint")).otherwise(h).alias(s) for s, h in zip(sums, halves, strict=True)])
    summed = running_totals(materialize(hashed, "trie-hashes"), "conv_id", [F.col("depth")], sums, "trie-paths")

    def key(seed: int, depth: Column, values: list[Column]) -> Column:
        return F.xxhash64(F.lit(seed), depth, *values)

    here = [F.col(f"run_{s}") for s in sums]
    before = [F.col(f"run_{s}") - F.col(s) for s in sums]
    keys = {"u": key(5, F.col("depth"), here), "v": key(6, F.col("depth"), here)}
    parents = {p: F.when(~is_root, key(seed, F.col("depth") - 1, before)) for p, seed in (("pu", 5), ("pv", 6))}
    keyed = summed.select("conv_id", "depth", "chars", "is_end", *[c.alias(n) for n, c in (keys | parents).items()])
    return materialize(keyed, "trie-keys")


def contract(nodes: DataFrame) -> DataFrame:
    """u, v, n_children, n_leaves, total: the totals of each node's subtree, itself included.

    ``nodes`` (u, v, pu, pv, depth, weight) is one tree; the parent of its root is null.
    """
    kids = nodes.where(F.col("pu").isNotNull()).groupBy(F.col("pu").alias("u"), F.col("pv").alias("v")).agg(F.count("*").alias("n"))
    zero = F.lit(0).cast("bigint")
    n = F.coalesce("n", zero)
    start = nodes.join(kids, ["u", "v"], "left").select(
        "u", "v", "pu", "pv", "depth", n.alias("n"), F.when(n == 0, 1).otherwise(0).cast("bigint").alias("leaves"),
        F.col("weight").alias("total"), zero.alias("edge_leaves"), zero.alias("edge_total"),
    )
    tree = start = materialize(start, "trie-tree")
    bits = max(1, int(start.agg(F.max("depth")).first()[0] or 0).bit_length())  # one row
    rounds = []
    while (left := tree.count()) > 1:
        is_leaf = F.col("n") == 0
        gained = tree.where(F.col("pu").isNotNull()).groupBy(F.col("pu").alias("gu"), F.col("pv").alias("gv")).agg(
            F.sum(F.when(is_leaf, 1).otherwise(0)).alias("raked"),
            F.sum(F.when(is_leaf, F.col("leaves") + F.col("edge_leaves")).otherwise(0)).alias("more_leaves"),
            F.sum(F.when(is_leaf, F.col("total") + F.col("edge_total")).otherwise(0)).alias("more"),
            F.max(F.when(~is_leaf, F.struct("u", "v"))).alias("child"),
        )
        rest = tree.where(~is_leaf).join(gained, (F.col("u") == F.col("gu")) & (F.col("v") == F.col("gv"))).select(
            "u", "v", "pu", "pv", "depth", (F.col("n") - F.col("raked")).alias("n"), (F.col("leaves") + F.col("more_leaves")).alias("leaves"),
            (F.col("total") + F.col("more")).alias("total"), "edge_leaves", "edge_total", "child",
        )
        rest = materialize(rest, "trie-raked")
        # Of two neighbours in a chain one is spliced, as told apart by a bit of the depth.
        marked = (F.col("n") == 1) & F.col("pu").isNotNull() & (F.shiftright("depth", len(rounds) % bits).bitwiseAND(F.lit(1).cast("bigint")) == 1)
        below = rest.select(F.col("u").alias("cu"), F.col("v").alias("cv"), marked.alias("child_marked"), F.col("edge_leaves").alias("c_leaves"), F.col("edge_total").alias("c_total"))
        spliced = rest.where(marked).join(below, (F.col("child.u") == F.col("cu")) & (F.col("child.v") == F.col("cv"))).where(~F.col("child_marked"))
        spliced = spliced.select(
            "u", "v", "pu", "pv", "cu", "cv", (F.col("leaves") + F.col("edge_leaves")).alias("add_leaves"), (F.col("total") + F.col("edge_total")).alias("add_total"),
            (F.col("leaves") + F.col("c_leaves")).alias("leaves"), (F.col("total") + F.col("c_total")).alias("total"),
        )
        spliced = materialize(spliced, "trie-spliced")
        rounds.append((tree, spliced))
        changes = spliced.select("u", "v", F.lit(True).alias("gone"), F.col("pu").alias("nu"), F.col("pv").alias("nv"), zero.alias("add_leaves"), zero.alias("add_total")).unionByName(
            spliced.select(F.col("cu").alias("u"), F.col("cv").alias("v"), F.lit(False).alias("gone"), F.col("pu").alias("nu"), F.col("pv").alias("nv"), "add_leaves", "add_total")
        )
        tree = rest.join(changes, ["u", "v"], "left").where(~F.coalesce("gone", F.lit(False))).select(
            "u", "v", F.coalesce("nu", "pu").alias("pu"), F.coalesce("nv", "pv").alias("pv"), "depth", "n", "leaves", "total",
            (F.col("edge_leaves") + F.coalesce("add_leaves", zero)).alias("edge_leaves"), (F.col("edge_total") + F.coalesce("add_total", zero)).alias("edge_total"),
        )
        tree = materialize(tree, "trie-tree")
    known = [tree.select("u", "v", "leaves", "total")]
    for tree, spliced in reversed(rounds):
        # The child of a spliced node went in a later round, so its total is known.
        if not spliced.isEmpty():
            totals = reduce(DataFrame.unionByName, known).select(F.col("u").alias("cu"), F.col("v").alias("cv"), F.col("leaves").alias("c_leaves"), F.col("total").alias("c_total"))
            expanded = spliced.join(totals, ["cu", "cv"]).select("u", "v", (F.col("leaves") + F.col("c_leaves")).alias("leaves"), (F.col("total") + F.col("c_total")).alias("total"))
            known.append(materialize(expanded, "trie-expanded"))
        known.append(tree.where(F.col("n") == 0).select("u", "v", "leaves", "total"))
    totals = reduce(DataFrame.unionByName, known).withColumnRenamed("leaves", "n_leaves")
    return start.select("u", "v", F.col("n").alias("n_children")).join(totals, ["u", "v"])


def digest_members(members: DataFrame) -> DataFrame:
    """u, v, ends_sha256: SHA-256 of the ids of each node in numeric order, comma-joined, for members (u, v, conv_id).

    Ranges of (node, id) are written as pieces of joined ids, and a node's pieces go through one hash in order: a
    task streams them, and holds one piece at a time.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["u", "v", "first", "ids"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        key, ids, rows, held = None, [], [], 0

        def close() -> None:
            if ids:
                rows.append((*key, ids[0], ",".join(map(str, ids))))

        for batch in batches:
            for u, v, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (u, v) != key or len(ids) >= PIECE_IDS:
                    close()
                    key, ids = (u, v), []
                ids.append(conv_id)
                held += 1
            if held > 4 * PIECE_IDS and rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                rows, held = [], 0
        close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, key, sha, rows = ["u", "v", "ends_sha256"], None, None, []
        types = [pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            for i, (u, v) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                ids = batch.column(3)[i].as_py().encode()
                if (u, v) == key:
                    sha.update(b",")
                else:
                    if key is not None:
                        rows.append((*key, sha.hexdigest()))
                    key, sha = (u, v), hashlib.sha256()
                sha.update(ids)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                rows = []
        if key is not None:
            rows.append((*key, sha.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    n = shuffle_partitions(members.sparkSession)
    order = ["u", "v", "conv_id"]
    joined = members.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(pieces, "u bigint, v bigint, first bigint, ids string")
    dealt = joined.repartition(n, "u", "v").sortWithinPartitions("u", "v", "first")
    return dealt.mapInArrow(digest, "u bigint, v bigint, ends_sha256 string")


def trie_report(paths: DataFrame) -> DataFrame:
    """One row for each node of the trie of ``paths`` (see ``conversation_paths`` and ``rebuild_conversations``).

    conv_id: smallest member. depth. parent_conv_id: smallest member of the parent (root: null). n_convs: members.
    n_children. n_leaves: nodes without children in the subtree. saved_tokens: summed over the subtree, the code points
    of a node's last text times the members but one. ends_sha256: digest of the ids of the conversations that end here.

    Turns of no conversation (null conv_id) take no part; null roles and texts are empty ones; repeated rows are turns of
    their own; no conversations, no rows. Other columns are ignored, whatever their names.
    """
    keyed = key_paths(paths)
    nodes = keyed.groupBy("u", "v").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.count("*").alias("n_convs"), F.max("pu").alias("pu"),
        F.max("pv").alias("pv"), F.max("chars").alias("chars"),
    )
    nodes = materialize(nodes, "trie-nodes")
    totals = contract(nodes.select("u", "v", "pu", "pv", "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("weight")))
    ends = materialize(digest_members(keyed.where("is_end")), "trie-ends")
    parents = nodes.select(F.col("u").alias("pu"), F.col("v").alias("pv"), F.col("conv_id").alias("parent_conv_id"))
    report = nodes.join(totals, ["u", "v"]).join(ends, ["u", "v"], "left").join(parents, ["pu", "pv"], "left")
    return report.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("total").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
