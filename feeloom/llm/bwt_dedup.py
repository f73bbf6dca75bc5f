"""Exact byte repeats by hash refinement of windows: windows of the wanted length are grouped by their blocks, step by
step, until only groups of equal windows remain.

This stands in for merged Burrows-Wheeler transforms, of which none is built here; the README says why. Two things keep
the work small. Only windows that can repeat are grouped: every window owns the smallest seed hash in it (a minimizer),
so equal windows have equal seeds, and seeds that occur once rule theirs out. And a step takes a block of several bytes,
so few rounds suffice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeloom.llm.common import BASE, BYTE_VALUES, materialize, mix64, shuffle_partitions, text_slices

LENGTH = 400
SEED = 32
# Bytes of one step of the refinement; the last step takes what is left.
STEP = 80
PIECE_BYTES = 1 << 20
# Windows of more contexts of one seed than this are grouped in several tasks, and the open ones then joined.
GROUP_CONTEXTS = 2048


def rolling(data: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of the ``length`` bytes from each place on, by doubling; places too near the end are left out."""
    have, power = BYTE_VALUES[data], BASE
    size, out, done = 1, None, 0
    rest = length
    while True:
        if rest & 1:
            tail = have[done:]
            out = tail if out is None else out[: len(tail)] * power + tail[: len(out)]
            done += size
        rest >>= 1
        if not rest:
            return mix64(out[: max(0, len(data) - length + 1)])
        have = have[:-size] * power + have[size:]
        with np.errstate(over="ignore"):
            power = power * power
        size *= 2


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbouring values, by prefix and suffix minima of blocks."""
    n = len(values) - width + 1
    full = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[: len(values)] = values
    blocks = full.reshape(-1, width)
    head = np.minimum.accumulate(blocks, axis=1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n], head[width - 1 : width - 1 + n])


def owned_windows(data: np.ndarray, ends: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """(seed key, first start, last start) of the runs of windows that own the same seed.

    ``ends`` holds for each byte the end of its text; windows that run over it are left out.
    """
    none = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    if len(data) < length:
        return none
    hashes = rolling(data, seed)
    # Of equal hashes the last one counts.
    place = np.uint64(0xFFFFFFFF) - np.arange(len(hashes), dtype=np.uint64)
    least = sliding_least((hashes & np.uint64(0xFFFFFFFF00000000)) | place, length - seed + 1)
    starts = np.flatnonzero(np.arange(len(least)) + length <= ends[: len(least)])
    if len(starts) == 0:
        return none
    owner = np.int64(0xFFFFFFFF) - (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)
    begins = np.flatnonzero(new)
    lasts = np.append(begins[1:], len(starts)) - 1
    return hashes[owner[begins]], starts[begins], starts[lasts]


def _pieces(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, end of its text per byte, row per byte, place in its text per byte); long texts come in overlapping pieces."""
    for first, end, data, offsets in text_slices(batch):
        if end - first == 1 and len(data) > 2 * PIECE_BYTES:
            for at in range(0, len(data) - length + 1, PIECE_BYTES):
                piece = data[at : at + PIECE_BYTES + length - 1]
                yield piece, np.full(len(piece), len(piece)), np.full(len(piece), first), at + np.arange(len(piece))
        else:
            sizes = np.diff(offsets)
            rows = np.repeat(np.arange(first, end), sizes)
            yield data, np.repeat(offsets[1:], sizes), rows, np.arange(len(data)) - np.repeat(offsets[:-1], sizes)


def _seeds(texts: DataFrame, length: int, seed: int) -> DataFrame:
    """(key, doc_id, tid, lo, hi): runs of window starts per owned seed. A task passes over texts that it has seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            tids = batch.column("tid").to_numpy()
            new = np.zeros(len(tids), bool)
            for i, t in enumerate(tids.tolist()):
                if t not in seen:
                    seen.add(t)
                    new[i] = True
            for data, ends, rows, places in _pieces(batch, length):
                keys, low, high = owned_windows(data, ends, length, seed)
                keep = new[rows[low]] if len(low) else np.zeros(0, bool)
                keys, low, high = keys[keep], low[keep], high[keep]
                if len(keys):
                    row = pa.array(rows[low])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.view(np.int64)), batch.column("doc_id").take(row), batch.column("tid").take(row),
                         pa.array(places[low].astype(np.int64)), pa.array(places[high].astype(np.int64))],
                        ["key", "doc_id", "tid", "lo", "hi"],
                    )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"key bigint, doc_id {kind}, tid bigint, lo bigint, hi bigint")


def equal_windows(symbols: list[np.ndarray]) -> np.ndarray:
    """Places of the windows that share all their symbols with another one.

    symbols[d][i] is the hash of the d-th block of window i. All windows begin as one group. Round d splits every group
    by the d-th symbol; windows alone in their group leave.
    """
    z = np.arange(len(symbols[0]))
    interval = np.zeros(len(z), np.uint64)
    for symbol in symbols:
        key = symbol[z] ^ mix64(interval)
        order = np.argsort(key)
        z, key = z[order], key[order]
        new = np.ones(len(z), bool)
        new[1:] = key[1:] != key[:-1]
        number = np.cumsum(new)
        again = (~new) | np.append(~new[1:], False)
        z, interval = z[again], number[again].astype(np.uint64)
        if len(z) == 0:
            break
    return z


def _intervals(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def _group_contexts(rows: pa.Table, length: int) -> Iterator[pa.RecordBatch]:
    """Repeated spans of contexts (doc_id, tid, lo, salts, context), and the windows left open where a seed was salted."""
    contexts = rows.column("context").combine_chunks().cast(pa.large_binary())
    _, offsets, data = contexts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[contexts.offset : contexts.offset + len(contexts) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    sizes = np.diff(offsets)
    windows = sizes - length + 1
    first = np.cumsum(windows) - windows
    row = np.repeat(np.arange(len(sizes)), windows)
    start = np.arange(windows.sum()) - first[row] + offsets[row]
    steps = [STEP] * (length // STEP) + ([length % STEP] if length % STEP else [])
    symbols, at = [], 0
    hashes = {s: rolling(data, s) for s in set(steps)}
    for s in steps:
        symbols.append(hashes[s][start + at])
        at += s
    repeated = np.zeros(len(start), bool)
    repeated[equal_windows(symbols)] = True
    lo = rows.column("lo").to_numpy()
    salts = rows.column("salts").to_numpy()
    names = ["doc_id", "tid", "a", "b", "w1", "w2"]
    # Runs of starts, cut where the context changes.
    flags = np.insert(repeated, first[1:], False) if len(first) > 1 else repeated
    a, b = _intervals(flags)
    owner = np.searchsorted(first + np.arange(len(first)), a, side="right") - 1
    base = first[owner] + owner
    take = pa.array(owner)
    none = pa.nulls(len(owner), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [rows.column("doc_id").combine_chunks().take(take), rows.column("tid").combine_chunks().take(take),
         pa.array(lo[owner] + a - base), pa.array(lo[owner] + b - base - 1 + length), none, none], names,
    )
    salted = salts[row] > 1
    if salted.any():
        open_ones = np.flatnonzero(salted)
        one = mix64(sum(symbols[d][open_ones] * np.uint64(2 * d + 3) for d in range(len(symbols))))
        two = mix64(sum(mix64(symbols[d][open_ones] + np.uint64(d)) * np.uint64(4 * d + 5) for d in range(len(symbols))))
        # A window that is settled here is passed on once, for the other tasks of the seed; an open one always.
        settled = repeated[open_ones]
        _, once = np.unique(one, return_index=True)
        keep = ~settled
        keep[once] = True
        open_ones, one, two, settled = open_ones[keep], one[keep], two[keep], settled[keep]
        r = row[open_ones]
        at = lo[r] + start[open_ones] - offsets[r]
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id").combine_chunks().take(pa.array(r)), rows.column("tid").combine_chunks().take(pa.array(r)),
             pa.array(at), pa.array(at + length), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))], names,
        )


def repeated_spans(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(doc_id, tid, a, b): byte spans [a, b) covered by strings of ``length`` bytes that also start elsewhere.

    ``docs`` has doc_id and text; tid is xxhash64 of the text. Spans of one text may overlap. Copies of whole texts
    are left to the caller: of each only some are looked at.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.where(F.octet_length("text") >= length).select("doc_id", F.xxhash64("text").alias("tid"), "text")
    seeds = materialize(_seeds(texts, length, seed), "repeat-seeds")
    counts = seeds.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # Written, so that both sides of the join come from exchanges and a hot seed can be split.
    counts = materialize(counts.select("key", F.ceil(F.col("n") / GROUP_CONTEXTS).cast("int").alias("salts")), "repeat-counts")
    runs = seeds.join(counts, "key").groupBy("doc_id", "tid").agg(F.collect_list(F.struct("key", "lo", "hi", "salts")).alias("runs"))
    same = F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("tid"))
    # The same join at every size, so that plans measured on small inputs hold on large ones.
    owners = runs.select(F.col("doc_id").alias("d"), F.col("tid").alias("t"), "runs").hint("merge")
    cut = texts.join(owners, same).select("doc_id", "tid", F.col("text").cast("binary").alias("bytes"), F.explode("runs").alias("run"))
    contexts = cut.select(
        "run.key", F.pmod(F.xxhash64("doc_id", "tid", "run.lo"), F.col("run.salts")).cast("int").alias("salt"),
        "doc_id", "tid", "run.lo", "run.salts",
        F.substring("bytes", (F.col("run.lo") + 1).cast("int"), (F.col("run.hi") - F.col("run.lo") + length).cast("int")).alias("context"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, 512)
                at += part.num_rows
                key, salt = part.column("key").to_numpy(), part.column("salt").to_numpy()
                if held and size > PIECE_BYTES:
                    last = held[-1]
                    same_group = (key == last.column("key")[-1].as_py()) & (salt == last.column("salt")[-1].as_py())
                    stays = int(np.argmin(same_group)) if not same_group.all() else len(key)
                    if stays < len(key):
                        if stays:
                            held.append(part.slice(0, stays))
                        yield from _group_contexts(pa.Table.from_batches(held), length)
                        held, size, part = [], 0, part.slice(stays)
                held.append(part)
                size += part.column("context").nbytes if part.num_rows else 0
        if held:
            yield from _group_contexts(pa.Table.from_batches(held), length)

    dealt = contexts.repartition(shuffle_partitions(spark), "key", "salt").sortWithinPartitions("key", "salt")
    found = materialize(dealt.mapInArrow(run, f"doc_id {kind}, tid bigint, a bigint, b bigint, w1 bigint, w2 bigint"), "repeat-spans")
    spans = found.where("w1 is null").select("doc_id", "tid", "a", "b")
    windows = found.where("w1 is not null")
    often = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2")
    return spans.unionByName(windows.join(often, ["w1", "w2"]).select("doc_id", "tid", "a", "b"))


def dedup_bytes(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes), removed spans.

    A byte of the UTF-8 text is removed if a string of ``length`` bytes that covers it also starts anywhere else, in
    this text or another; overlaps count, and no string crosses texts. Every row is a text of its own: equal rows are
    copies of each other and go entirely. Null texts count as empty, shorter ones are kept whole. A null doc_id is
    kept. No rows: an empty result. Other columns are ignored. Strings are told apart by five 64-bit hashes.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = rows.where(F.octet_length("text") >= length).select(
        "doc_id", F.xxhash64("text").alias("tid"), F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").cast("bigint").alias("n")
    )
    names = materialize(names, "repeat-names")
    copied = names.groupBy("digest").agg(F.count("*").alias("copies")).where("copies > 1").select("digest")
    whole = names.join(copied, "digest").select("doc_id", "tid", F.lit(0).cast("bigint").alias("a"), F.col("n").alias("b"))
    spans = repeated_spans(rows, length, seed).unionByName(whole)
    per_text = spans.groupBy(F.col("doc_id").alias("d"), F.col("tid").alias("t")).agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    joined = rows.withColumn("tid", F.xxhash64("text")).join(
        per_text.hint("merge"), F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("tid")), "left"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out: list[tuple] = []
                for text, spans in zip(part.column("text"), part.column("spans"), strict=True):
                    data = text.as_py().encode()
                    kept, runs, end = [], [], 0
                    for span in sorted((s["a"], s["b"]) for s in spans.as_py() or ()):
                        if runs and span[0] <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], span[1])
                        else:
                            runs.append([*span])
                    for a, b in runs:
                        kept.append(data[end:a])
                        end = b
                    left = b"".join([*kept, data[end:]])
                    out.append((len(data), len(data) - len(left), len(runs), hashlib.sha256(left).hexdigest(), left,
                                ",".join(f"{a}:{b}" for a, b in runs)))
                columns = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                                                 ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary, spans string"
    return joined.select("doc_id", "text", "spans").mapInArrow(cut, schema)
