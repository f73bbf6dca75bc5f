"""Helpers shared by the operators: scratch tables, distributed prefix sums, word hashes of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feeloom.session import scratch_dir

# ASCII white space; a word is a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20
_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts the lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed_row(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct, so that no name in it can clash with those an operator adds."""
    return F.struct(*[docs[c] for c in docs.columns])


def unpacked(docs: DataFrame, row: str = "row", **replaced: Column) -> list[Column]:
    """The columns of ``docs`` out of its ``packed_row``, in order; some may be replaced."""
    return [replaced[c].alias(c) if c in replaced else F.col(row).getField(c).alias(c) for c in docs.columns]


def row_key(id_col: Column, text: Column) -> Column:
    """64-bit key of a row by id and text, never null: rows without an id and differing texts of one id are told apart."""
    return F.xxhash64(id_col.isNull(), id_col, text.isNull(), text)


def shuffle_partitions(spark) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def prefix_sums(df: DataFrame, order: list[Column], values: list[str], purpose: str) -> DataFrame:
    """``df`` with ``before_<value>`` per value: the sum over all rows ahead of this one in ``order``.

    One range sort deals the rows out, each range sums its own rows, and the totals of the ranges (one row for
    each shuffle partition) shift them. ``order`` must be total, else tied rows come in any order.
    """
    ranged = df.repartitionByRange(shuffle_partitions(df.sparkSession), *order).withColumn(
        "range_id", F.spark_partition_id()
    )
    ranged = materialize(ranged, purpose)
    totals = ranged.groupBy("range_id").agg(*[F.sum(v).alias(f"sum_{v}") for v in values])
    ahead = Window.orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("range_id", *[F.coalesce(F.sum(f"sum_{v}").over(ahead), F.lit(0)).alias(f"shift_{v}") for v in values])
    within = Window.partitionBy("range_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumns({f"inside_{v}": F.coalesce(F.sum(v).over(within), F.lit(0)) for v in values})
    # One row for each shuffle partition: small at any input.
    joined = inside.join(F.broadcast(shifts), "range_id")
    return joined.select(*df.columns, *[(F.col(f"inside_{v}") + F.col(f"shift_{v}")).alias(f"before_{v}") for v in values])


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = np.uint64(0x5851F42D4C957F2D)


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets) over slices of about ``limit`` bytes; a longer text is its own slice."""
    texts = batch.column(column).cast(pa.large_string()).fill_null("")
    n = len(texts)
    if n == 0:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(n, max(first + 1, end))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return np.where(upper, data + 32, data).astype(np.uint8)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of concatenated texts: (starts, ends, hashes, first word of each text plus the total).

    Words never run over from one text into the next. A hash depends on the bytes of the word alone.
    """
    n = len(data)
    none = np.empty(0, np.int64)
    if n == 0:
        return none, none, np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    begins = ~space
    inner = offsets[(offsets > 0) & (offsets < n)]
    after = np.empty(n, bool)
    after[0] = True
    after[1:] = space[:-1]
    after[inner] = True
    starts = np.flatnonzero(begins & after)
    if len(starts) == 0:
        return none, none, np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    until = np.empty(n, bool)
    until[-1] = True
    until[:-1] = space[1:]
    until[inner - 1] = True
    ends = np.flatnonzero(begins & until) + 1
    at = np.arange(starts[0], n) - np.repeat(starts, np.diff(np.append(starts, n)))
    parts = BYTE_VALUES[data[starts[0] :]]
    parts *= powers(int(at.max()) + 1)[at]
    parts[space[starts[0] :]] = 0
    hashes = np.add.reduceat(parts, starts - starts[0])
    hashes = mix64(hashes + (ends - starts).astype(np.uint64))
    return starts, ends, hashes, np.searchsorted(starts, offsets)


def shingles_of(hashes: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word shingle; a text with fewer words has its whole sequence as the one shingle."""
    n, counts = len(hashes), np.diff(firsts)
    p = powers(size + 1, np.uint64(0xD1342543DE82EF95))
    rows = np.repeat(np.arange(len(counts)), counts)
    out_rows, out = [], []
    if n >= size:
        total = np.zeros(n - size + 1, np.uint64)
        for j in range(size):
            total += hashes[j : n - size + 1 + j] * p[j]
        whole = rows[: n - size + 1] == rows[size - 1 :]
        out_rows.append(rows[: n - size + 1][whole])
        out.append(mix64(total[whole] + np.uint64(size)))
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        value = np.zeros(len(short), np.uint64)
        for j in range(size - 1):
            has = counts[short] > j
            value[has] += hashes[firsts[short[has]] + j] * p[j]
        out_rows.append(short)
        out.append(mix64(value + counts[short].astype(np.uint64)))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(out_rows), np.concatenate(out)
