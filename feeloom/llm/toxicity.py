"""Toxicity by a subsequence string kernel, Nystroem landmarks and a linear support vector machine."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The model is fitted on at most so many labelled documents of each class, chosen by hash.
SAMPLE_TOXIC = 3000
SAMPLE_CLEAN = 6000
LANDMARKS = 64
CANDIDATES = 400
# A landmark's document shares differ by so many standard errors between the classes.
MIN_GAIN = 4.0
# Subsequences of three characters; a gap character costs this factor.
ORDER = 3
DECAY = 0.7
# A word takes part against a landmark if it holds this share of its letters.
LETTER_SHARE = 0.75
WINDOW = 32
THRESHOLD = 0.3
CACHE_WORDS = 200_000


def _codes(words: list[str], width: int, pad: int) -> np.ndarray:
    """Code points of the words, one row each, filled up with ``pad``."""
    out = np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width).astype(np.int32)
    out[out == 0] = pad
    return out


def _decay(n: int) -> np.ndarray:
    """Weights of the earlier places: DECAY ** (gap) strictly below the diagonal."""
    gap = np.arange(n)[:, None] - 1 - np.arange(n)[None, :]
    return np.where(gap >= 0, DECAY ** np.maximum(gap, 0), 0.0).astype(np.float32)


def subsequence_kernel(a: list[str], b: list[str]) -> np.ndarray:
    """Gap-weighted subsequence kernel of the pairs (a[i], b[i]), not normalised."""
    out = np.zeros(len(a))
    lengths = np.array([max(len(x), 1) for x in a])
    others = max([1, *(len(x) for x in b)])
    for low, high in ((0, 8), (8, 16), (16, WINDOW)):
        chosen = np.flatnonzero((lengths > low) & (lengths <= high))
        step = max(1, 500_000 // (high * others))
        for at in range(0, len(chosen), step):
            part = chosen[at : at + step]
            x = _codes([a[i] for i in part], high, -1)
            y = _codes([b[i] for i in part], others, -2)
            same = (x[:, :, None] == y[:, None, :]).astype(np.float32) * np.float32(DECAY**2)
            ends = same
            for _ in range(ORDER - 1):
                ends = same * (_decay(high) @ ends @ _decay(others).T)
            out[part] = ends.sum(axis=(1, 2))
    return out


def _mask(words: list[str]) -> np.ndarray:
    """Letters of each word as bits; two letters may share a bit, which only adds pairs."""
    if not words:
        return np.zeros(0, np.uint64)
    codes = _codes(words, max(1, max(map(len, words))), -1)
    bits = np.left_shift(np.uint64(1), (codes % 61).astype(np.uint64))
    return np.bitwise_or.reduce(np.where(codes < 0, np.uint64(0), bits), axis=1)


@dataclass
class WordKernel:
    """Normalised kernel values of words against the landmarks, with the words seen lately kept."""

    landmarks: list[str]
    own: np.ndarray = field(init=False)
    masks: np.ndarray = field(init=False)
    seen: dict[str, int] = field(default_factory=dict)
    rows: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self):
        self.own = subsequence_kernel(self.landmarks, self.landmarks)
        self.masks = _mask(self.landmarks)

    def values(self, words: list[str]) -> np.ndarray:
        """[word, landmark]; a word longer than WINDOW is covered by overlapping windows."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        if not words or not self.landmarks:
            return out
        pieces = [(i, w[s : s + WINDOW]) for i, w in enumerate(words) for s in range(0, max(1, len(w) - WINDOW // 2), WINDOW // 2)]
        owner, parts = np.array([i for i, _ in pieces]), [p for _, p in pieces]
        need = np.ceil(LETTER_SHARE * np.bitwise_count(self.masks)).astype(np.int64)
        shared = np.bitwise_count(_mask(parts)[:, None] & self.masks[None, :])
        u, j = np.nonzero((shared >= need[None, :]) & (np.array([len(p) for p in parts]) >= ORDER)[:, None])
        if len(u) == 0:
            return out
        active, back = np.unique(u, return_inverse=True)
        names = [parts[i] for i in active]
        self_kernel = subsequence_kernel(names, names)
        cross = subsequence_kernel([names[i] for i in back], [self.landmarks[i] for i in j])
        norm = np.sqrt(self_kernel[back] * self.own[j])
        np.maximum.at(out, (owner[u], j), np.where(norm > 0, cross / np.maximum(norm, 1e-300), 0).astype(np.float32))
        return out

    def text(self, words: list[set[str]]) -> np.ndarray:
        """[text, landmark]: the largest value over the words of each text."""
        new = list({w for some in words for w in some if w not in self.seen})
        if new:
            if len(self.seen) > CACHE_WORDS:
                self.seen, self.rows = {}, []
                new = list({w for some in words for w in some})
            stripped = [w if w.isalnum() else "".join(c for c in w if c.isalnum()) for w in new]
            value = self.values(stripped)
            hit = np.flatnonzero(value.any(axis=1))
            at = np.full(len(new), -1)
            at[hit] = np.arange(len(hit)) + len(self.rows)
            self.rows.extend(value[hit])
            self.seen.update(zip(new, at.tolist(), strict=True))
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        for i, some in enumerate(words):
            rows = [r for r in map(self.seen.__getitem__, some) if r >= 0]
            if rows:
                out[i] = np.max([self.rows[r] for r in rows], axis=0)
        return out


SPACED = re.compile(r"(?<!\S)\S(?: \S){3,}(?!\S)")


def words_in(text: str | None) -> set[str]:
    """Lower-cased words of a whole text; runs of four or more single characters also count as one word ("i d i o t")."""
    tokens = (text or "").lower().split()
    words = set(tokens)
    words.update(m.group().replace(" ", "") for m in SPACED.finditer(" ".join(tokens)))
    return words


@dataclass
class ToxicityModel:
    landmarks: list[str]
    projection: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, kernel: np.ndarray) -> np.ndarray:
        margin = (kernel @ self.projection) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -40, 40)))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id, as text, is 2 modulo 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> tuple[DataFrame, float]:
    """(doc_id, text, label) of the bounded training sample, and the share of label 1 among all training labels.

    A document with several labels counts as toxic if one of them says so; null labels are none.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("label"))
    known = known.where(~held_out(F.col("doc_id")))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    chosen = None
    for label, most in ((1, toxic), (0, clean)):
        some = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = some if chosen is None else chosen.unionByName(some)
    # At most toxic + clean rows of two numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    total = sum(counts.values())
    return rows, counts.get(1, 0) / total if total else 0.0


def _kernel_rows(rows: DataFrame, landmarks: list[str], columns: list[str], schema: str, finish) -> DataFrame:
    """mapInArrow over (columns..., text): ``finish`` makes the last column from the kernel values of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = WordKernel(landmarks)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                values = kernel.text([words_in(t.as_py()) for t in part.column("text")])
                arrays = [part.column(c) for c in columns] + [finish(values)]
                yield pa.RecordBatch.from_arrays(arrays, [*columns, "made"])

    return rows.select(*columns, "text").mapInArrow(run, schema)


def choose_landmarks(rows: DataFrame, n: int = LANDMARKS, candidates: int = CANDIDATES) -> list[str]:
    """Words of the training sample that tell the classes apart best, none too like one chosen before."""
    words = F.array_distinct(F.transform(F.split(F.lower("text"), r"\s+"), lambda w: F.regexp_replace(w, r"[^\p{L}\p{N}]", "")))
    counts = rows.select("label", F.explode(words).alias("word")).where(F.length("word").between(4, 16))
    counts = counts.groupBy("word").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("q")).where("p >= 3")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    p, q = F.col("p") / max(1, sizes.get(1, 0)), F.col("q") / max(1, sizes.get(0, 0))
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    pooled = (F.col("p") + F.col("q")) / max(1, n1 + n0)
    # How many standard errors the two shares of documents lie apart.
    gain = (p - q) / F.sqrt(pooled * (1 - pooled) * (1 / max(1, n1) + 1 / max(1, n0)) + 1e-12)
    top = counts.where((p > 2 * q) & (gain >= MIN_GAIN)).orderBy(gain.desc(), "word").limit(candidates).select("word").collect()
    chosen: list[str] = []
    for word in (r["word"] for r in top):
        if len(chosen) == n:
            break
        if not chosen or WordKernel(chosen).values([word]).max() < 0.6:
            chosen.append(word)
    return chosen


def _fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 10.0) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton's method."""
    x1 = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x1.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-3
    cost = cost / max(1.0, weight.sum()) * len(w)
    for _ in range(30):
        inside = 1 - y * (x1 @ w) > 0
        a = x1[inside] * weight[inside, None]
        step = np.linalg.solve(ridge + 2 * cost * a.T @ x1[inside], 2 * cost * a.T @ y[inside])
        if np.allclose(step, w, atol=1e-8):
            break
        w = step
    return w[:-1], float(w[-1])


def _fit_sigmoid(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of label 1 given the margin."""
    x = np.column_stack([margin, np.ones(len(margin))])
    t = (y > 0).astype(float)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (weight * (t - p)) - 1e-3 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def train_toxicity(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> ToxicityModel | None:
    """The model, from labels outside the held-out fold; None if they do not hold both classes or no word tells them apart.

    The driver gets at most ``candidates`` words and one row of LANDMARKS numbers for each sampled document.
    """
    rows, share = training_rows(docs, labels, toxic, clean)
    landmarks = choose_landmarks(rows)
    if not landmarks:
        return None
    encode = lambda values: pa.array(list(values.astype(np.float64)), pa.list_(pa.float64()))
    sample = _kernel_rows(rows, landmarks, ["label"], "label int, made array<double>", encode).toPandas()
    y = np.where(sample["label"].to_numpy() == 1, 1.0, -1.0)
    if len(set(y)) < 2:
        return None
    kernel = np.array(sample["made"].tolist())
    z = WordKernel(landmarks).values(landmarks).astype(np.float64)
    values, vectors = np.linalg.eigh((z + z.T) / 2)
    keep = values > 1e-6
    projection = vectors[:, keep] / np.sqrt(values[keep])
    # The sample holds the classes in other shares than the labels do.
    weight = np.where(y > 0, share / (y > 0).mean(), (1 - share) / (y < 0).mean())
    weights, bias = _fit_svm(kernel @ projection, y, weight)
    slope, offset = _fit_sigmoid((kernel @ projection) @ weights + bias, y, weight)
    return ToxicityModel(landmarks, projection, weights, bias, slope, offset)


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Null and empty texts are scored like a text without words. Without a model every score is 0. No rows: an empty
    result. Rows of one doc_id are scored each on its own; other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    if model is None:
        scored = docs.select("doc_id", F.lit(0.0).alias("score"))
    else:
        finish = lambda values: pa.array(model.score(values.astype(np.float64)), pa.float64())
        made = _kernel_rows(docs, model.landmarks, ["doc_id"], f"doc_id {kind}, made double", finish)
        scored = made.select("doc_id", F.col("made").alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """score_toxicity() by a model trained from ``labels`` (doc_id, toxic) on the same documents."""
    return score_toxicity(docs, train_toxicity(docs, labels))


def keep_clean(docs: DataFrame, model: ToxicityModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``, with all their columns; without a model, all of them.

    Each row is judged by its own text, so rows with null or equal ids are no special case.
    """
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = WordKernel(model.landmarks)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                scores = model.score(kernel.text([words_in(t.as_py()) for t in part.column("text")]).astype(np.float64))
                yield part.filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema)
