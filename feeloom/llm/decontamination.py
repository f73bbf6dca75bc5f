"""Benchmark decontamination: CGK embedding of item-sized windows, bit-sampling LSH, exact edit distance."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeloom.llm.common import materialize, mix64, packed_row, powers, row_key, text_slices, unpacked, words_of

# Edits allowed for each word of an item: similarity 0.8 or more.
EDIT_SHARE = 0.2
# Random walks, and bit samples of each; a sample compares so many places of the embedding.
WALKS = 8
SAMPLES = 6
PLACES = 2
# Items go to the executors in sets of at most so many bytes of text; more items take more passes.
ITEM_BYTES = 8 << 20
# Windows that are looked up at a time.
WINDOWS = 2048
GRAMS = (3, 2, 1)
# Lower case, and ASCII punctuation and white space as blanks.
FOLD = np.array([c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256)], np.uint8)


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    p = powers(size + 1, np.uint64(0xA0761D6478BD642F))
    total = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for j in range(size):
        total += words[j : len(words) - size + 1 + j] * p[j]
    return mix64(total + np.uint64(size))


def cgk(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, walk: int, places: np.ndarray) -> np.ndarray:
    """CGK random walk over windows of ``words``: the word under the pointer at each of ``places`` (steps, ascending), 0 beyond the end.

    The pointer moves on by a random bit of (walk, step, word), the same for equal words, so windows that differ by few
    edits fall into step again: edit distance becomes Hamming distance. Only the places asked for are kept, so memory
    does not grow with the length of a window.
    """
    out = np.zeros((len(starts), len(places)), np.uint64)
    at = np.zeros(len(starts), np.int64)
    wanted = 0
    for step in range(int(places[-1]) + 1):
        inside = at < lengths
        word = np.where(inside, words[np.minimum(starts + at, len(words) - 1)], np.uint64(0))
        while wanted < len(places) and places[wanted] == step:
            out[:, wanted] = word
            wanted += 1
        seed = np.uint64((walk * 1_000_003 + step * 7919 + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        at += inside & ((mix64(word ^ seed) & np.uint64(1)) == 1)
    return out


def signatures(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """[window, table]: hashes of sampled places of the embeddings of windows of at most ``size`` words.

    Places are drawn from the part of the embedding where the pointer is still inside the words.
    """
    tables = []
    for walk in range(WALKS):
        rng = np.random.default_rng(1000 * walk + size)
        samples = [rng.choice(max(1, 2 * size * 3 // 4), size=PLACES, replace=True) for _ in range(SAMPLES)]
        places = np.unique(np.concatenate(samples))
        embedded = cgk(words, starts, lengths, walk, places)
        for sample, own in enumerate(samples):
            value = np.full(len(starts), np.uint64(walk * SAMPLES + sample + 1))
            for p in np.searchsorted(places, own):
                value = mix64(value * np.uint64(0x9E3779B97F4A7C15) + embedded[:, p])
            tables.append(value)
    return np.column_stack(tables)


def fitting_distance(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end) of the stretch of ``words`` that is nearest to ``item`` in word edits, the first of the nearest."""
    n = len(words)
    # Cost and start share one number, so the smallest number is the least cost and then the first start.
    unit = n + 2
    rise = unit * np.arange(n + 1)
    state = np.arange(n + 1)
    for i, w in enumerate(item, 1):
        new = np.empty_like(state)
        new[0] = i * unit
        new[1:] = np.minimum(state[:-1] + unit * (words != w), state[1:] + unit)
        state = np.minimum.accumulate(new - rise) + rise
    end = int(np.argmin(state // unit))
    return int(state[end] // unit), int(state[end] % unit), end


def _reached(hits: np.ndarray, before: int, after: int, n: int) -> np.ndarray:
    """Places of 0 to ``n`` - 1 that lie at most ``before`` ahead of one of the ascending ``hits``, or ``after`` behind it."""
    apart = np.flatnonzero(np.diff(hits) > before + after) + 1
    low = np.maximum(hits[np.append(0, apart)] - before, 0)
    count = np.minimum(hits[np.append(apart - 1, len(hits) - 1)] + after + 1, n) - low
    return np.arange(count.sum()) + np.repeat(low - np.cumsum(count) + count, count)


@dataclass
class Item:
    item_id: int
    words: np.ndarray
    edits: int
    gram: int
    least: int


@dataclass
class ItemSet:
    """Items of one pass: by length, the LSH tables; by gram size, the grams and the lengths of the items they are from."""

    items: list[Item]
    grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    by_size: dict[int, tuple[np.ndarray, np.ndarray, Item]]

    @staticmethod
    def build(rows: list[tuple[int, str]]) -> ItemSet:
        items = []
        for item_id, text in rows:
            data = FOLD[np.frombuffer((text or "").encode(), np.uint8)]
            words = words_of(data, np.array([0, len(data)]))[2]
            if len(words) == 0:
                continue  # an item without words matches nothing
            edits = int(EDIT_SHARE * len(words) + 1e-9)
            # Counting lemma: a stretch within so many edits shares at least this many grams with the item.
            gram, least = next((q, t) for q in GRAMS if (t := len(words) - q + 1 - edits * q) > 0)
            items.append(Item(item_id, words, edits, gram, least))
        grams = {}
        for q in GRAMS:
            pairs = {(int(g), len(i.words)) for i in items if i.gram == q for g in _grams(i.words, q)}
            if pairs:
                gram, size = (np.array(c, t) for c, t in zip(zip(*sorted(pairs), strict=True), (np.uint64, np.int64), strict=True))
                distinct, first = np.unique(gram, return_index=True)
                grams[q] = distinct, np.append(first, len(gram)), size
        by_size = {}
        for size in sorted({len(i.words) for i in items}):
            own = np.array([k for k, i in enumerate(items) if len(i.words) == size])
            table = signatures(np.concatenate([items[k].words for k in own]), size * np.arange(len(own)), np.full(len(own), size), size)
            keys = (table + np.arange(table.shape[1], dtype=np.uint64)).ravel()
            order = np.argsort(keys, kind="stable")
            by_size[size] = (keys[order], np.repeat(own, table.shape[1])[order], items[own[0]])
        return ItemSet(items, grams, by_size)

    def windows(self, words: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(size, starts) of the windows that hold as many grams of items of their size as a near copy must.

        ``words`` are those of several texts, which begin at ``firsts``; no gram or window runs over from one to the next.
        """
        text_end = np.repeat(firsts[1:], np.diff(firsts))
        text_begin = np.repeat(firsts[:-1], np.diff(firsts))
        for q, (grams, first, sizes) in self.grams.items():
            own = _grams(words, q)
            if len(own) == 0:
                continue
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            hits = np.flatnonzero((grams[at] == own) & (np.arange(len(own)) + q <= text_end[: len(own)]))
            count = first[at[hits] + 1] - first[at[hits]]
            places = np.repeat(hits, count)
            sizes_hit = sizes[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[at[hits]], count)]
            for size in np.unique(sizes_hit):
                item, hit = self.by_size[int(size)][2], places[sizes_hit == size]
                if len(hit) < item.least:
                    continue
                # Only starts near enough to a hit can reach the count.
                starts = _reached(hit, int(size) + item.edits, item.edits, len(words))
                low = np.maximum(starts - item.edits, text_begin[starts])
                high = np.minimum(starts + int(size) + item.edits, text_end[starts])
                within = np.searchsorted(hit, high) - np.searchsorted(hit, low)
                if (found := starts[within >= item.least]).size:
                    yield int(size), found

    def matches(self, words: np.ndarray, firsts: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int]]:
        """(text, item number) -> (distance, start, end) for the items that the texts contain."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        text_of = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        for size, starts in self.windows(words, firsts):
            keys, numbers, any_item = self.by_size[size]
            own = np.unique(numbers).tolist()
            edits = any_item.edits
            done: dict[tuple[int, int], int] = {}
            for at in range(0, len(starts), WINDOWS):
                part = starts[at : at + WINDOWS]
                # Windows inside stretches that have been aligned with every item of their size need no look-up.
                texts, inverse = np.unique(text_of[part], return_inverse=True)
                settled = np.array([min(done.get((t, k), -1) for k in own) for t in texts.tolist()])
                part = part[part >= settled[inverse]]
                if len(part) == 0:
                    continue
                lengths = np.minimum(size, firsts[text_of[part] + 1] - part)
                table = signatures(words, part, lengths, size)
                table = table + np.arange(table.shape[1], dtype=np.uint64)
                low, high = np.searchsorted(keys, table, "left"), np.searchsorted(keys, table, "right")
                rows, tables = np.nonzero(high > low)
                found = {(r, k) for r, t in zip(rows.tolist(), tables.tolist(), strict=True) for k in numbers[low[r, t] : high[r, t]].tolist()}
                for r, k in sorted(found):
                    s, text = int(part[r]), int(text_of[part[r]])
                    if s < done.get((text, k), -1):
                        continue  # inside a stretch that has been aligned
                    begin, end = int(firsts[text]), int(firsts[text + 1])
                    a, b = max(begin, s - size // 2 - edits), min(end, s + 2 * size + 2 * edits)
                    # The alignment settles every window that starts in the first half of a size from here.
                    done[text, k] = s + size // 2 + 1
                    distance, first, last = fitting_distance(self.items[k].words, words[a:b])
                    near = (distance, a - begin + first, a - begin + last)
                    if distance <= edits and near < best.get((text, k), (1 << 30, 0, 0)):
                        best[text, k] = near
        return best


def item_sets(benchmark: DataFrame, limit: int = ITEM_BYTES) -> Iterator[list[tuple[int, str]]]:
    """Items in sets of at most ``limit`` bytes of text (at least one item); the driver holds one set at a time."""
    some: list[tuple[int, str]] = []
    size = 0
    rows = benchmark.select("item_id", "text").where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).orderBy("item_id", "text")
    for row in rows.toLocalIterator():
        length = len(row["text"].encode())
        if some and size + length > limit:
            yield some
            some, size = [], 0
        some.append((row["item_id"], row["text"]))
        size += length
    if some:
        yield some


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, limit: int = ITEM_BYTES) -> DataFrame:
    """Per document and benchmark item it contains: doc_id, item_id, distance, start_word, end_word, n_item_words.

    A document contains an item if some stretch of its words lies within one edit for each five words of the item
    (insertions, deletions, replacements; letters folded to lower case, punctuation ignored). Windows of the item's
    size are embedded by CGK walks and looked up in bit-sampling LSH tables of the items; exact alignment decides and
    gives the nearest stretch. Windows that share too few word grams with any item of their size to lie within its
    edits are skipped, which loses none (counting lemma). Items and texts may be of any length: memory grows with the
    words of a text and of the items of one pass, never with windows times words. Null and empty texts and items match nothing; rows of one
    doc_id or item_id count as one, the nearest match. No rows: an empty result. Other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    spark = docs.sparkSession
    schema = f"doc_id {kind}, item_id bigint, distance int, start_word bigint, end_word bigint, n_item_words int"
    found = None
    for rows in item_sets(benchmark, limit):
        shared = spark.sparkContext.broadcast(cloudpickle.dumps(ItemSet.build(rows)))  # bounded by ``limit``

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = pickle.loads(shared.value)
            for batch in batches:
                out: list[tuple] = []
                ids = batch.column("doc_id")
                for first, _, data, offsets in text_slices(batch):
                    _, _, hashes, firsts = words_of(FOLD[data], offsets)
                    for (i, k), (distance, a, b) in items.matches(hashes, firsts).items():
                        item = items.items[k]
                        out.append((ids[first + i].as_py(), item.item_id, distance, a, b, len(item.words)))
                if out:
                    columns = [list(c) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0], batch.schema.field("doc_id").type), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()),
                         pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64()), pa.array(columns[5], pa.int32())],
                        ["doc_id", "item_id", "distance", "start_word", "end_word", "n_item_words"],
                    )

        one = materialize(docs.select("doc_id", "text").mapInArrow(scan, schema), "benchmark-matches")
        found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], schema)
    best = F.min(F.struct("distance", "start_word", "end_word", "n_item_words")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that contain a benchmark item, whatever their id; all columns kept."""
    key = row_key(F.col("doc_id"), F.col("text"))
    bad = benchmark_matches(docs.select(key.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("bad_key")).distinct()
    rows = docs.select(packed_row(docs).alias("row"), key.alias("row_key"))
    return rows.join(bad, F.col("row_key") == F.col("bad_key"), "left_anti").select(*unpacked(docs))
