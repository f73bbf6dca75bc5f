"""Benchmark items of many words: bounded memory, and the same matches as the definition."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest

from feeloom.llm import decontamination
from feeloom.llm.common import words_of


def hashed(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return words_of(data, np.array([0, len(data)]))[2]


def plain_distance(item: list[str], text: list[str]) -> int:
    """Fewest word edits between ``item`` and any stretch of ``text``."""
    last = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        row = [i]
        for j, y in enumerate(text, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
        last = row
    return min(last)


def test_reached_places():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        hits = np.sort(rng.integers(0, n, int(rng.integers(1, 8))))
        before, after = (int(x) for x in rng.integers(0, 9, 2))
        want = [s for s in range(n) if any(h - before <= s <= h + after for h in hits)]
        assert decontamination._reached(hits, before, after, n).tolist() == want


def test_signature_of_a_window_is_that_of_its_words():
    rng = np.random.default_rng(2)
    words = rng.integers(1, 1 << 60, 400).astype(np.uint64)
    starts = np.array([0, 5, 90, 380, 395])
    lengths = np.minimum(25, len(words) - starts)
    table = decontamination.signatures(words, starts, lengths, 25)
    for row, s, n in zip(table, starts, lengths, strict=True):
        alone = decontamination.signatures(words[s : s + n].copy(), np.array([0]), np.array([n]), 25)
        assert (row == alone[0]).all()


def test_memory_does_not_grow_with_the_window():
    words = np.random.default_rng(3).integers(1, 1 << 60, 30_000).astype(np.uint64)
    starts = np.arange(decontamination.WINDOWS // 8)
    tracemalloc.start()
    decontamination.signatures(words, starts, np.full(len(starts), 20_000), 20_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 << 20


@pytest.mark.parametrize("size", [500, 4000])
def test_long_item_in_bounded_memory(size):
    rng = random.Random(size)
    item = [f"w{rng.randrange(3000)}" for _ in range(size)]
    copy = list(item)
    edits = size // 20
    for _ in range(edits):
        copy[rng.randrange(len(copy))] = "changed"
    items = decontamination.ItemSet.build([(7, " ".join(item))])
    texts = [["before"] * 50 + copy + ["after"] * 50, [f"w{rng.randrange(3000)}" for _ in range(size)], item[: size // 2]]
    firsts = np.cumsum([0, *map(len, texts)])
    words = hashed(" ".join(" ".join(t) for t in texts))
    tracemalloc.start()
    found = items.matches(words, firsts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert list(found) == [(0, 0)]
    distance, first, last = found[0, 0]
    assert 0 < distance <= edits and (first, last) == (50, 50 + size)
    assert peak < 100 << 20


def test_two_long_items_of_one_size(spark):
    rng = random.Random(9)
    items = [[f"w{rng.randrange(500)}" for _ in range(600)] for _ in range(2)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    texts = [items[0] + items[1], items[1], items[0][:-50] + items[1][50:], ["x"] * 700]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    found = decontamination.benchmark_matches(docs, bench).collect()
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in found}
    want = {(d, i): plain_distance(w, t) for d, t in enumerate(texts) for i, w in enumerate(items)}
    assert got == {pair: n for pair, n in want.items() if n <= 0.2 * 600} and len(got) == 5
    for r in found:
        if r["distance"] == 0:
            assert texts[r["doc_id"]][r["start_word"] : r["end_word"]] == items[r["item_id"]]
