"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix with itself."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feeloom.llm.common import WORD, lower_ascii, materialize, mix64, packed_row, row_key, shingles_of, shuffle_partitions, text_slices, unpacked, words_of
from feeloom.llm.components import components

SHINGLE_WORDS = 4
PERCENT = 85
BLOCK_DOCS = 1024
BLOCK_COLUMNS = 4096
# Small sets have as many spare blocks as they may have differences, up to this; large ones a third as many.
SPARE_BLOCKS = 24
# The low bits of a key tell how many of the most frequent keys of a set are passed over, up to this.
SPARE_MASK = 0xFFF
# A key that occurs so often or more counts as one that occurs so often.
MOST_OFTEN = 1 << 16


def sorted_sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, offsets, hashes): the distinct shingle hashes of each text of the slice, sorted, offsets per text."""
    for first, end, data, offsets in text_slices(batch):
        _, _, hashes, firsts = words_of(lower_ascii(data), offsets)
        rows, values = shingles_of(hashes, firsts, size)
        order = np.lexsort((values, rows))
        rows, values = rows[order], values[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
        rows, values = rows[new], values[new]
        yield first, np.searchsorted(rows, np.arange(end - first + 1)), values


def most_differences(n: np.ndarray, percent: int) -> np.ndarray:
    """How many shingles two linked sets can differ by, if the smaller has ``n``: they share ``percent`` of the union."""
    return (100 - percent) * (n * 100 // percent) // 100


def size_class(n: np.ndarray, percent: int) -> np.ndarray:
    """Sizes of linked sets lie in one class or in neighbouring ones."""
    bounds = [1]
    top = int(n.max()) if len(n) else 1
    while bounds[-1] <= top:
        bounds.append(bounds[-1] * 100 // percent + 1)
    return np.searchsorted(np.array(bounds), n, side="right") - 1


def class_top(c: np.ndarray, percent: int) -> np.ndarray:
    """The largest size of each class."""
    bounds = [1]
    for _ in range(int(c.max()) + 1 if len(c) else 0):
        bounds.append(bounds[-1] * 100 // percent + 1)
    return np.array(bounds)[c + 1] - 1


def spare_blocks(apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many of the emptiest blocks give no key, and how many of the most frequent keys are passed over; linked sets agree in more blocks than both."""
    spare = np.maximum(apart // 3, np.minimum(apart, SPARE_BLOCKS))
    often = np.minimum(spare * 2 // 3, SPARE_MASK)
    return spare - often, often


def block_keys(firsts: np.ndarray, values: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): signatures of column blocks. Two linked rows share more keys of one class than their low bits tell.

    The columns (shingle hashes) fall into more blocks than two linked sets can have differences, so in some blocks the
    sets are equal. A set takes part as the smaller one of its own size class and as the larger one of the class below.
    """
    counts = np.diff(firsts)
    rows = np.flatnonzero(counts > 0)
    out_rows, out_keys = [], []
    if len(rows) == 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    classes = size_class(counts[rows], percent)
    for below in (0, 1):
        c = classes - below
        ok = c >= 0
        some, c = rows[ok], c[ok]
        if len(some) == 0:
            continue
        apart = most_differences(class_top(c, percent), percent)
        spare, often = spare_blocks(apart)
        blocks = apart + 1 + spare + often
        starts = np.cumsum(blocks) - blocks
        total = int(blocks.sum())
        local = np.full(len(counts), -1)
        local[some] = np.arange(len(some))
        row_of = np.repeat(np.arange(len(counts)), counts)
        used = local[row_of] >= 0
        mine, value = local[row_of][used], values[used]
        # The upper half of a hash picks the block.
        block = ((value >> np.uint64(32)) * blocks[mine].astype(np.uint64)) >> np.uint64(32)
        slot = starts[mine] + block.astype(np.int64)
        sums, sizes = np.zeros(total, np.uint64), np.bincount(slot, minlength=total)
        np.add.at(sums, slot, mix64(value))
        slot_row = np.repeat(np.arange(len(some)), blocks)
        nth = np.arange(total) - starts[slot_row]
        empty = np.bincount(slot_row[sizes == 0], minlength=len(some))
        # Two linked sets agree in more blocks than are spare. The fullest of these are not among the spare ones that are
        # emptiest in either set, so those give no key; an empty block does only where equal ones beyond them might be empty.
        ranked = np.lexsort((nth, sizes, slot_row))
        place = np.empty(total, np.int64)
        place[ranked] = np.arange(total) - starts[slot_row[ranked]]
        wanted = (place >= spare[slot_row]) & ((sizes > 0) | (empty > spare)[slot_row])
        key = mix64(sums + mix64(sizes.astype(np.uint64) * np.uint64(2654435761) + nth.astype(np.uint64)))
        key = mix64(key + mix64(c[slot_row].astype(np.uint64) + np.uint64(77)))
        out_rows.append(some[slot_row[wanted]])
        mask = np.uint64(SPARE_MASK)
        out_keys.append((key[wanted] & ~mask) | often[slot_row[wanted]].astype(np.uint64))
    return np.concatenate(out_rows), np.concatenate(out_keys)


def _signatures(firsts: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums over each set."""
    out = []
    for salt in (1, 2):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(values ^ mix64(np.array([salt], np.uint64))), dtype=np.uint64)])
        out.append(mix64(total[firsts[1:]] - total[firsts[:-1]]).view(np.int64))
    return out


def _sets(docs: DataFrame, size: int, with_text: bool = False) -> DataFrame:
    """doc_id, n_shingles, and a 128-bit signature of the whole set; the text too, if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, firsts, values in sorted_sets(batch, size):
                n = np.diff(firsts)
                ids = batch.column("doc_id").slice(first, len(n))
                sums = map(pa.array, _signatures(firsts, values))
                texts = [batch.column("text").slice(first, len(n))] if with_text else []
                yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), *sums, *texts], names)

    names = ["doc_id", "n_shingles", "s1", "s2", *(["text"] if with_text else [])]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_shingles bigint, s1 bigint, s2 bigint" + (", text string" if with_text else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _keys(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(key, doc_id) of block_keys(). A task gives the keys of equal sets once, so copies shrink before the exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            for first, firsts, values in sorted_sets(batch, size):
                new = np.zeros(len(firsts) - 1, bool)
                for i, name in enumerate(zip(np.diff(firsts).tolist(), *(s.tolist() for s in _signatures(firsts, values)), strict=True)):
                    if name not in seen:
                        seen.add(name)
                        new[i] = True
                rows, keys = block_keys(firsts, values, percent)
                rows, keys = rows[new[rows]], keys[new[rows]]
                for at in range(0, len(rows), 100_000):
                    ids = batch.column("doc_id").take(pa.array(rows[at : at + 100_000] + first))
                    yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + 100_000].view(np.int64)), ids], ["key", "doc_id"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"key bigint, doc_id {kind}")


def _rare(keys: DataFrame) -> DataFrame:
    """(key, doc_id) of the keys that occur again, without the most frequent ones of each document.

    A key's low bits tell how many keys with the same low bits a document passes over. All documents rank keys alike, so
    of the keys that two linked ones share no more than that are lost, and one at least is left. What documents share
    without being near copies, such as a common passage, mostly makes no candidates.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(rows: pa.RecordBatch, often: np.ndarray) -> pa.RecordBatch:
            again = often > 1
            kept = rows.filter(pa.array(again))
            return pa.RecordBatch.from_arrays([*kept.columns, pa.array(often[again], pa.int32())], names)

        held, frequent = None, None  # rows of the last key so far; a key that was seen MOST_OFTEN times
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if held is not None:
                batch = pa.concat_batches([held, batch])
            key = batch.column("key").to_numpy()
            begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            sizes = np.diff(np.append(begins, len(key)))
            often = np.minimum(sizes, MOST_OFTEN)
            if key[0] == frequent:
                often[0] = MOST_OFTEN
            last = len(key) if often[-1] == MOST_OFTEN else int(begins[-1])
            frequent = key[-1] if last == len(key) else None
            held = batch.slice(last) if last < len(key) else None
            yield counted(batch.slice(0, last), np.repeat(often, sizes)[:last])
        if held is not None:
            yield counted(held, np.full(held.num_rows, held.num_rows))

    names = [*keys.columns, "often"]
    kind = keys.schema["doc_id"].dataType.simpleString()
    dealt = keys.repartition(shuffle_partitions(keys.sparkSession), "key").sortWithinPartitions("key")
    shared = materialize(dealt.mapInArrow(run, f"key bigint, doc_id {kind}, often int"), "jaccard-shared")
    shared = shared.withColumn("spare", F.col("key").bitwiseAND(SPARE_MASK))
    # A document that comes twice in a key ranks it once.
    order = Window.partitionBy("doc_id", "spare").orderBy(F.desc("often"), "key")
    return shared.withColumn("nth", F.dense_rank().over(order)).where("nth > spare").select("key", "doc_id")


def _first_of_run(keys: DataFrame) -> DataFrame:
    """(a, b): each further document of a key with the first one. Sorted partitions are streamed, no group is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last_id = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            key = batch.column("key").to_numpy()
            ids = batch.column("doc_id")
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            begins = np.flatnonzero(new)
            head = begins[np.cumsum(new) - 1]
            hubs = ids.take(pa.array(head))
            carried = last_key is not None and key[0] == last_key
            end = begins[1] if len(begins) > 1 else len(key)
            if carried:
                hubs = pa.concat_arrays([pa.array([last_id] * int(end), ids.type), hubs.slice(int(end))])
            again = ~new
            if carried:
                again[0] = True
            if again.any():
                yield pa.RecordBatch.from_arrays([ids.filter(pa.array(again)), hubs.filter(pa.array(again))], ["a", "b"])
            if len(begins) > 1 or not carried:
                last_id = ids[int(begins[-1])].as_py()
            last_key = key[-1]

    kind = keys.schema["doc_id"].dataType.simpleString()
    dealt = keys.repartition(shuffle_partitions(keys.sparkSession), "key").sortWithinPartitions("key", "doc_id")
    return dealt.mapInArrow(run, f"a {kind}, b {kind}")


def block_product(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """[i, j] whether left[i] and right[j] link. Overlaps add up over blocks of columns; hopeless pairs are dropped early."""
    n, m = (np.array([len(s) for s in part]) for part in (left, right))
    # With overlap o, 100 * o >= percent * (n + m - o).
    need = -(-percent * (n[:, None] + m[None, :]) // (100 + percent))
    alive = np.minimum(n[:, None], m[None, :]) >= need
    columns = np.intersect1d(np.concatenate(left), np.concatenate(right))
    overlap = np.zeros(need.shape, np.float32)
    where = [[np.searchsorted(columns, s) for s in part] for part in (left, right)]
    inside = [[w[(w < len(columns)) & (columns[np.minimum(w, len(columns) - 1)] == s)] if len(columns) else w[:0] for w, s in zip(ws, part, strict=True)]
              for ws, part in zip(where, (left, right), strict=True)]
    rest = [np.array([len(w) for w in part]) for part in inside]
    for at in range(0, len(columns), BLOCK_COLUMNS):
        if not alive.any():
            break
        rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        parts = []
        for part, side, chosen in ((inside[0], 0, rows), (inside[1], 1, cols)):
            dense = np.zeros((len(chosen), min(BLOCK_COLUMNS, len(columns) - at)), np.float32)
            for r, i in enumerate(chosen):
                w = part[i]
                a, b = np.searchsorted(w, (at, at + BLOCK_COLUMNS))
                dense[r, w[a:b] - at] = 1
                rest[side][i] -= b - a
            parts.append(dense)
        overlap[np.ix_(rows, cols)] += parts[0] @ parts[1].T
        alive &= overlap + np.minimum(rest[0][:, None], rest[1][None, :]) >= need
    return alive & (overlap >= need)


def forest(ids_left: list, ids_right: list, linked: np.ndarray, same: bool) -> list[tuple]:
    """Links that connect the same documents as all of ``linked``: one fewer than documents at most."""
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(np.triu(linked, 1) if same else linked), strict=True):
        a, b = find(ids_left[i]), find(ids_right[j])
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((ids_left[i], ids_right[j]))
    return out


def jaccard_links(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT, block_docs: int = BLOCK_DOCS) -> tuple[DataFrame, DataFrame]:
    """(sets, links): doc_id, n_shingles, rep for each row with an id, and links (a, b) between representatives.

    Equal sets are one class with its smallest id as representative. Blocks of columns in which two representatives
    agree put them into one candidate group; inside a group the incidence matrix is multiplied with its transpose block
    by block, and the links kept are a spanning forest of all links of each block pair, so no pair table is written.
    """
    docs = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    sets = materialize(_sets(docs, size), "jaccard-sets")
    reps = sets.where("n_shingles > 0").groupBy("n_shingles", "s1", "s2").agg(F.min("doc_id").alias("rep"))
    named = sets.join(reps, ["n_shingles", "s1", "s2"], "left").select("doc_id", "n_shingles", "rep")
    named = materialize(named, "jaccard-classes")
    hubs = materialize(_first_of_run(_rare(_keys(docs, size, percent))).where("a != b").distinct(), "jaccard-candidates")
    rep_of = named.where("rep is not null").select("doc_id", "rep").distinct()
    between = hubs.join(rep_of.select(F.col("doc_id").alias("a"), F.col("rep").alias("ra")), "a").join(
        rep_of.select(F.col("doc_id").alias("b"), F.col("rep").alias("rb")), "b"
    )
    groups = components(between.select(F.col("ra").alias("a"), F.col("rb").alias("b")), "jaccard-groups")
    # A document with several texts may stand for several classes, so a member is a document and a set.
    groups = groups.join(reps.withColumnRenamed("rep", "node"), "node")
    counts = groups.groupBy("component").agg(F.count("*").alias("members"))
    groups = groups.join(counts, "component").withColumn("blocks", F.ceil(F.col("members") / block_docs).cast("int"))
    groups = groups.withColumn("block", F.pmod(F.xxhash64("node", "n_shingles", "s1", "s2"), F.col("blocks")).cast("int"))
    # The same join at every size, so that plans measured on small inputs hold on large ones.
    members = _sets(docs, size, True).join(groups.withColumnRenamed("node", "doc_id").hint("merge"), ["doc_id", "n_shingles", "s1", "s2"])
    members = members.select("doc_id", "component", "block", "blocks", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, firsts, values in sorted_sets(batch, size):
                n = len(firsts) - 1
                own = batch.slice(start, n)
                packed = pa.array([values[firsts[i] : firsts[i + 1]].tobytes() for i in range(n)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(own.column(c) for c in ("doc_id", "component", "block", "blocks")), packed],
                                                 ["doc_id", "component", "block", "blocks", "shingles"])

    packed = members.mapInArrow(pack, f"doc_id {kind}, component {kind}, block int, blocks int, shingles binary")
    # Block pair (i, j), i <= j, gets the rows of both.
    low = F.transform(F.sequence(F.lit(0), F.col("block")), lambda i: F.struct(i.alias("i"), F.col("block").alias("j")))
    high = F.transform(F.sequence(F.col("block"), F.col("blocks") - 1), lambda j: F.struct(F.col("block").alias("i"), j.alias("j")))
    dealt = packed.withColumn("pair", F.explode(F.array_distinct(F.concat(low, high)))).select(
        "component", "pair.i", "pair.j", "doc_id", "block", "shingles"
    )

    def multiply(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        rows = rows.drop_duplicates(["doc_id", "shingles"]).sort_values("doc_id")
        sides = []
        for b in (i, j):
            part = rows[rows["block"] == b]
            sides.append((part["doc_id"].tolist(), [np.frombuffer(s, np.uint64) for s in part["shingles"]]))
        (left, ls), (right, rs) = sides
        if not left or not right:
            return pd.DataFrame({"a": [], "b": []})
        return pd.DataFrame(forest(left, right, block_product(ls, rs, percent), i == j), columns=["a", "b"])

    links = dealt.groupBy("component", "i", "j").applyInPandas(multiply, f"a {kind}, b {kind}")
    return named, materialize(links, "jaccard-links")


def jaccard_components(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Words are runs of other than ASCII white space, A-Z in lower case; a set holds the distinct shingles of ``size``
    words, or the whole sequence of a shorter text. Two documents link when they share ``percent`` per cent of the
    union or more. component_id is the smallest doc_id reachable. Null and empty texts have 0 shingles and link with
    nothing. Rows of one doc_id are one document that has the links of each. A null doc_id has a null component_id.
    No rows: an empty result. Other columns are ignored. Shingles are told apart by 64-bit hashes.
    """
    sets, links = jaccard_links(docs, size, percent)
    own = sets.where("rep is not null and doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = components(links.unionByName(own), "jaccard-components")
    named = sets.join(found, sets["doc_id"] == found["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
    lost = docs.where(F.col("doc_id").isNull()).select("doc_id", "text")
    return named.unionByName(_sets(lost, size).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def keep_first_of_group(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with only the document of the smallest id of each group of near copies; all columns kept.

    Rows of one doc_id and text are one document, other texts of the id are judged on their own. Rows without an id
    come last; of equal texts without an id one row stays. Texts without words are never copies.
    """
    key = row_key(F.col("doc_id"), F.col("text"))
    groups = jaccard_components(docs.select(key.alias("doc_id"), "text"), size, percent)
    grouped = groups.where("n_shingles > 0").select(F.col("doc_id").alias("row"), "component_id").distinct()
    ids = docs.select(key.alias("row"), F.col("doc_id").isNull().alias("no_id"), "doc_id").distinct()
    ranked = materialize(grouped.join(ids, "row"), "jaccard-ranked")
    first = ranked.groupBy("component_id").agg(F.min(F.struct("no_id", "doc_id", "row")).alias("first"))
    drop = ranked.join(first, "component_id").where(F.col("row") != F.col("first.row")).select(F.col("row").alias("drop_key"))
    rows = docs.select(packed_row(docs).alias("row"), key.alias("row_key"), "doc_id", "text")
    kept = rows.join(drop, F.col("row_key") == F.col("drop_key"), "left_anti")
    named, unnamed = kept.where("doc_id is not null"), kept.where("doc_id is null")
    words = F.regexp_like(F.coalesce("text", F.lit("")), F.lit(WORD))
    fields = [F.col("row").getField(c) for c in docs.columns]
    order = Window.partitionBy("text").orderBy(*[F.xxhash64(c) for c in fields], *[F.col("row").getField(c) for c in docs.columns if c != "text"])
    one = unnamed.where(words).withColumn("nth_copy", F.row_number().over(order)).where("nth_copy = 1").drop("nth_copy")
    return named.unionByName(unnamed.where(~words)).unionByName(one).select(*unpacked(docs))
