"""Periodic runs of words by an online sparse diagonal DP, and texts with the repeats of each run cut out.

Each word looks at its earlier occurrences: an equal word ``lag`` places back lengthens the match on that diagonal by
one. A diagonal ends at the first word that differs, and at once yields a run if its matches, together with the ``lag``
words before them, are long enough. Three rules keep the diagonals few without losing a run:

- A run with period q matches on max(least - q, q) words at least, so a diagonal is opened only where the last L words
  occur q words earlier too; L is half of ``least`` for small lags and doubles as the lags do.
- While a shorter period p holds and has held for two periods, no diagonal of a longer lag is opened: a run with
  a longer period that starts there must outlive the shorter one, and is opened where that one ends.
- A diagonal that is opened late is first lengthened to the left.

So at most a few diagonals for each doubling of the lag are active at a word, and the work of a text of n words is
about n log n, also where one word or line makes up the whole of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feeloom.llm.common import WORD

LEAST = 12  # words of the shortest run
OUT_BYTES = 8 << 20
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class _Numbers(dict):
    """Numbers the words of a text in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def number_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_Numbers().__getitem__, words), np.int64, len(words))


def gram_levels(ids: np.ndarray, least: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(L, previous, begins) for L = least / 2, doubling while an L-gram repeats.

    ``begins`` lists the words where a diagonal may begin. ``previous`` has, by the last word of an L-gram, that of its previous occurrence fewer than 2 L words ago, or -1.
    Grams are compared by a 64-bit hash; what is opened for them is compared word by word.
    """
    n, size, levels = len(ids), -(-least // 2), []
    if n < least:
        return levels
    grams = np.zeros(n - size + 1, np.uint64)
    for j in range(size):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + ids[j : n - size + 1 + j].astype(np.uint64)
        grams ^= grams >> np.uint64(29)
    while len(grams):
        order = np.argsort(grams, kind="stable")
        same = grams[order[1:]] == grams[order[:-1]]
        if not same.any():
            break
        previous = np.full(n, -1, np.int32)
        near = same & (order[1:] - order[:-1] < 2 * size)
        previous[order[1:][near] + size - 1] = order[:-1][near] + size - 1
        # A lag is new at a word if the words before it and its occurrence do not match on that diagonal already.
        new = previous >= 0
        new[1:] &= (previous[:-1] < 0) | (previous[:-1] != previous[1:] - 1)
        # Occurrences of one gram that follow a new one within 2 L words may see it at a greater distance.
        rank = np.where(new[order + size - 1], np.arange(len(order)), -1)
        group = np.concatenate([[0], np.cumsum(~same)])
        last = np.maximum.accumulate(rank)
        seen = (last >= 0) & (group[last] == group) & (order - order[last] < 2 * size)
        levels.append((size, previous, np.sort(order[seen]) + size - 1))
        if len(grams) <= size:
            break
        grams = grams[:-size] * np.uint64(0xD1342543DE82EF95) + (grams[size:] ^ (grams[size:] >> np.uint64(31)))
        size *= 2
    return levels


def first_match(ids: np.ndarray, i: int, lag: int) -> int:
    """First word of the stretch up to ``i`` whose words all equal those ``lag`` places before; i + 1 if word i does not."""
    high, step = i + 1, 64
    while high > lag:
        low = max(lag, high - step)
        differ = np.flatnonzero(ids[low:high] != ids[low - lag : high - lag])
        if len(differ):
            return low + int(differ[-1]) + 1
        high, step = low, step * 4
    return lag


def first_difference(ids: np.ndarray, i: int, stop: int, lag: int) -> int:
    """First word of [i, stop) that differs from the one ``lag`` places before, else ``stop``."""
    step = 64
    while i < stop:
        high = min(stop, i + step)
        differ = np.flatnonzero(ids[i:high] != ids[i - lag : high - lag])
        if len(differ):
            return i + int(differ[0])
        i, step = high, step * 4
    return stop


def find_runs(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every maximal run of at least ``least`` words and two periods, in this order."""
    n = len(ids)
    levels = gram_levels(ids, least)
    if not levels:
        return []
    places = np.concatenate([begins for _, _, begins in levels])
    order = np.argsort(places, kind="stable")
    marks = [*places[order].tolist(), n]
    mark_levels = np.repeat(np.arange(len(levels)), [len(begins) for _, _, begins in levels])[order].tolist()
    runs: list[tuple[int, int, int]] = []
    active: dict[int, int] = {}  # lag: start of its run
    ends: dict[int, int] = {}  # lag: the word that ends its diagonal, as far as looked at

    def end(lags: list[int], at: int) -> int:
        """Ends diagonals before word ``at``; returns the first place where one of their runs had held for two periods."""
        starts: dict[int, int] = {}
        held = n
        for lag in sorted(lags):
            start = active.pop(lag)
            del ends[lag]
            if at - start >= 2 * lag:
                held = min(held, start + 2 * lag)
                if at - start >= least and start not in starts:  # a multiple of a period has the same ends
                    starts[start] = lag
        runs.extend((start, at - start, lag) for start, lag in starts.items())
        return held

    i = marks[0]
    mark = 0
    while i < n:
        over = [lag for lag, stop in ends.items() if stop == i]
        held = end(over, i) if over else n
        looked = []
        while marks[mark] == i:
            looked.append(mark_levels[mark])
            mark += 1
        if held < n:
            looked = range(len(levels))
        for level in looked:
            size, previous, _ = levels[level]
            j = int(previous[i])
            if j < 0:
                continue
            # A run not opened so far matches from here on at the earliest.
            since = min(i - size + 1, held)
            limit = min([2 * size, *(lag for lag, start in active.items() if start + 2 * lag <= since)])
            while j >= 0 and i - j < limit:
                lag = i - j
                if lag not in active and (lag >= size or level == 0):
                    first = first_match(ids, i, lag)
                    if first <= i:
                        active[lag] = first - lag
                        ends[lag] = first_difference(ids, i + 1, n, lag)
                j = int(previous[j])
        i = min([marks[mark], *ends.values()])
    end(list(active), n)
    return sorted(runs)


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay when each run is cut after its first period."""
    kept = np.ones(n, bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return kept


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (start word, length, period; by start, then period) and collapsed for every row of ``docs``.

    Words are separated by ASCII white space. ``collapsed`` holds the words that no run contains after its first
    period, joined by one blank. Null, empty and blank texts have no words, no runs and an empty ``collapsed``; a null
    doc_id and repeated rows are kept as they are, each row by itself; other columns are ignored, whatever their names.
    Whole texts are read, of any length, and no row leaves its task: there is no shuffle.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows):
            columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (kind, pa.int64(), found, pa.large_string()), strict=True)]
            return pa.RecordBatch.from_arrays([*columns[:3], columns[3].cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

        found = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            kind = batch.column(0).type
            rows, size = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = (text.as_py() or "").encode().split()  # bytes split at ASCII white space only
                n = len(words)
                runs = find_runs(number_words(words), least) if n >= least else []
                if runs:
                    words = [words[k] for k in np.flatnonzero(kept_words(n, runs)).tolist()]
                collapsed = b" ".join(words).decode()
                rows.append((doc_id, n, [{"start": a, "length": b, "period": q} for a, b, q in runs], collapsed))
                size += len(collapsed) + 24 * len(runs) + 32
                if size > OUT_BYTES:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {doc_type}, n_words bigint, runs {RUNS}, collapsed string")


def with_repeated_tail(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the texts (by crc32 of doc_id) end in a repeated passage of their own words.

    With h the crc32 and g = h div 10, a text of n words whose h ends in 0 repeats, from word a = g mod n on, the
    p = 1 + (n - a) div (3 + g mod 8) words that stand there. Rows without doc_id or words keep their text.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("bigint")

    def repeat(words: Column) -> Column:
        n = F.nullif(F.size(words), F.lit(0)).cast("bigint")
        a = (g % n).cast("int")
        times = (g % 8 + 3).cast("int")
        rest = (n - a).cast("int")
        block = F.slice(words, a + 1, (F.floor(rest / times) + 1).cast("int"))
        tail = F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), rest)
        return F.when(n.isNotNull(), F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " "))

    # The words are bound once, as the one element of an array.
    repeated = F.transform(F.array(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))), repeat)[0]
    return docs.select("doc_id", F.when(h % 10 == 0, F.coalesce(repeated, "text")).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """One row for each row of ``periodic_runs``: how many runs, the longest (ties: first start, then period), digests."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("minus"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
    length = -F.col("best.minus")
    return rows.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"), F.col("best.period").alias("period"),
        F.floor(length * 1000 / F.col("best.period")).cast("bigint").alias("exponent_milli"), "runs_sha256", "collapsed_sha256", "n_words",
    )
