"""Secret scan: fixed patterns, and Markov models of random strings against ordinary identifiers.

DataFrame functions only. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the contract: the base patterns, in the order in which kinds are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
# The characters that keys and tokens are written in, and the shortest run that is scored.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
RUN = r"[A-Za-z0-9+/_=-]{16,}"
SAMPLE_DOCS = 4000
SAMPLE_STRINGS = 4096
# Log-likelihood ratio, in nats: of the whole run, and on average for each of its characters.
MIN_RATIO = 12.0
MIN_MEAN_RATIO = 0.6
# Different characters in a part of a run; 16 random hexadecimal digits have fewer about once in 30,000.
MIN_DISTINCT = 6
WIDTH = len(ALPHABET)
# Arrays are passed over in blocks of so many elements.
BLOCK = 256


def _once(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _emitted(items: Column, first: Column, step, emit, kind: str) -> Column:
    """What ``emit(state, item)`` gives (null: nothing) over ``items`` from left to right, of type ``kind``.

    ``step(state, item)`` is the state after an item, ``first`` the one before all. An aggregate copies its state at every
    step, so a list that grows in it would cost the square of its length: one pass takes the state before each
    block of items, and a second one emits block by block.
    """
    none = F.array().cast(f"array<{kind}>")

    def collect(acc: Column, x: Column) -> Column:
        out = _once(emit(acc["state"], x), lambda e: F.when(e.isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(e))))
        return F.struct(step(acc["state"], x).alias("state"), out.alias("out"))

    def passed(own: Column) -> Column:
        last = F.greatest(F.ceil(F.size(own) / BLOCK).cast("int") - 1, F.lit(0))
        block = lambda b: F.slice(own, b * BLOCK + 1, F.lit(BLOCK))
        begin = F.struct(first.alias("state"), F.array(first).alias("all"))
        states = F.aggregate(
            F.slice(F.sequence(F.lit(0), last), F.lit(1), last), begin,
            lambda acc, b: _once(F.aggregate(block(b), acc["state"], step), lambda s: F.struct(s.alias("state"), F.concat(acc["all"], F.array(s)).alias("all"))),
            lambda acc: acc["all"],
        )
        return F.flatten(F.transform(states, lambda state, b: F.aggregate(
            block(b), F.struct(state.alias("state"), none.alias("out")), collect, lambda acc: acc["out"]
        )))

    return _once(items, passed)


def _matches(text: Column, pattern: str, gate: str, value_group: bool = False) -> Column:
    """Matches of ``pattern`` as structs (start, end, value), leftmost and not overlapping; null without a match.

    Every match is taken together with the gap before it, so running sums of lengths give the places. The end of the
    text matches too, which keeps the search linear. ``gate`` spares texts without a match the rest.
    """
    search = f"(?s)(.*?)({pattern}|\\z)"
    part = [F.regexp_extract_all(text, F.lit(search), F.lit(i)) for i in ((1, 2, 3) if value_group else (1, 2, 2))]
    rows = F.arrays_zip(part[0].alias("gap"), part[1].alias("hit"), part[2].alias("value"))

    def found(at: Column, row: Column) -> Column:
        start = at + F.length(row["gap"])
        return F.when(row["hit"] != "", F.struct(start.alias("start"), (start + F.length(row["hit"])).alias("end"), row["value"].alias("value")))

    step = lambda at, row: at + F.length(row["gap"]) + F.length(row["hit"])
    kind = "struct<start:int,end:int,value:string>"
    return F.when(F.regexp_like(text, F.lit(gate)), _emitted(rows, F.lit(0), step, found, kind))


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and the base matches per kind, failing ones dropped; the added columns replace others."""
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    found = docs.select("doc_id", text.alias("text"))
    return found.select(
        "doc_id", "text",
        F.coalesce(F.filter(_matches(F.col("text"), ASSIGN, ASSIGN, True), lambda m: F.length(m["value"]) >= 8), none).alias("assign"),
        F.coalesce(_matches(F.col("text"), ACCESS, ACCESS), none).alias("access"),
        F.coalesce(_matches(F.col("text"), HEX, HEX), none).alias("hex"),
    )


def _steps(run: Column) -> Column:
    """Numbers of the transitions between neighbouring characters of a run."""
    # The characters are split once: a substring would walk from the start of the run for each of them.
    codes = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    return _once(codes, lambda own: F.transform(
        F.slice(own, F.lit(2), F.greatest(F.size(own) - 1, F.lit(0))), lambda code, i: F.get(own, i) * WIDTH + code
    ))


def labelled_samples(spark: SparkSession, docs: DataFrame, sample_docs: int = SAMPLE_DOCS, strings: int = SAMPLE_STRINGS) -> DataFrame:
    """Labelled samples (run, is_random): what the models are trained from.

    Random: digests written in hexadecimal, base 64, and upper-case letters with digits, ``strings`` of each. Ordinary:
    the runs of the alphabet that hold a letter, in ``sample_docs`` documents chosen by hash, without base matches.
    """
    digest = F.sha2(F.concat(F.lit("sample-"), F.col("id").cast("string")), 256)
    coded = F.base64(F.unhex(digest))
    made = spark.range(strings).select(F.explode(F.array(
        F.substring(digest, 1, 40), F.substring(coded, 1, 40),
        F.substring(F.regexp_replace(F.upper(F.base64(F.unhex(F.sha2(coded, 512)))), "[^A-Z0-9]", ""), 1, 40),
    )).alias("run"))
    clean = docs.where(F.col("text").isNotNull() & (F.col("text") != "")).where(
        ~F.regexp_like("text", F.lit(ASSIGN)) & ~F.regexp_like("text", F.lit(ACCESS)) & ~F.regexp_like("text", F.lit(HEX))
    )
    chosen = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    # At most sample_docs ids.
    sample = clean.join(F.broadcast(chosen), "doc_id", "left_semi")
    runs = sample.select(F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9+/_=-]{2,}"), F.lit(0))).alias("run"))
    ordinary = runs.where(F.regexp_like("run", F.lit("[A-Za-z]")))
    return made.select("run", F.lit(1).alias("is_random")).unionByName(ordinary.select("run", F.lit(0).alias("is_random")))


def train_ratios(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of every transition, random over ordinary: WIDTH * WIDTH numbers, whatever the input.

    Both first-order models are smoothed by half a count, so unseen transitions stay finite.
    """
    counts = samples.where(F.length("run") >= 2).select("is_random", F.explode(_steps(F.col("run"))).alias("step"))
    rows = counts.groupBy("step", "is_random").agg(F.count("*").alias("n")).collect()  # at most 2 * WIDTH ** 2 rows
    seen = {(r["step"], r["is_random"]): r["n"] for r in rows}
    ratios = []
    for a in range(WIDTH):
        total = [sum(seen.get((a * WIDTH + b, k), 0) for b in range(WIDTH)) + 0.5 * WIDTH for k in (0, 1)]
        for b in range(WIDTH):
            p = [(seen.get((a * WIDTH + b, k), 0) + 0.5) / total[k] for k in (0, 1)]
            ratios.append(math.log(p[1] / p[0]))
    return ratios


def _stretches(scores: Column, bias: float) -> Column:
    """Stretches (start, end, within the run) with the largest sums of ``scores`` less ``bias``, from left to right.

    A stretch is closed where its sum falls to 0 or by more than MIN_RATIO below its largest, and cut at the largest.
    """
    zero = F.lit(0.0)

    def after(state: Column, score: Column) -> tuple[Column, Column]:
        total = state["total"] + score - F.lit(bias)
        return total, (total <= 0) | (total < state["best"] - MIN_RATIO)

    def found(state: Column, score: Column) -> Column:
        made = F.struct(state["start"].alias("start"), state["end"].alias("end"))
        return F.when(after(state, score)[1] & (state["end"] - state["start"] >= 16), made)

    def step(state: Column, score: Column) -> Column:
        total, shut = after(state, score)
        more = total > state["best"]
        at = state["at"] + 1
        return F.struct(
            at.alias("at"),
            F.when(shut, at).otherwise(state["start"]).alias("start"),
            F.when(shut, at).when(more, at + 1).otherwise(state["end"]).alias("end"),
            F.when(shut, zero).otherwise(total).alias("total"),
            F.when(shut, zero).when(more, total).otherwise(state["best"]).alias("best"),
        )

    first = F.struct(F.lit(0).alias("at"), F.lit(0).alias("start"), F.lit(0).alias("end"), zero.alias("total"), zero.alias("best"))
    # A last score without bottom closes what is open.
    return _emitted(F.concat(scores, F.array(F.lit(-1e300))), first, step, found, "struct<start:int,end:int>")


def random_runs(text: Column, ratios: list[float], min_ratio: float = MIN_RATIO, min_mean: float = MIN_MEAN_RATIO, base: Column | None = None) -> Column:
    """Random stretches of 16 characters or more, as structs (start, end, value); those without a letter are none.

    Base spans are cut out of the runs first. What is left is taken whole if it passes as a whole; else its best
    stretches that pass are taken, and if none does, those that lie above the mean asked for. Parts of a run must hold
    MIN_DISTINCT different characters: one character repeated is rare in ordinary text, but not random.
    """
    table = F.array(*[F.lit(float(r)) for r in ratios])
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    runs = _outside(_matches(text, RUN, RUN), none if base is None else base)

    def passing(run: Column, scores: Column, found: Column) -> Column:
        def good(f: Column) -> Column:
            total = F.aggregate(F.slice(scores, f["start"] + 1, f["end"] - f["start"] - 1), F.lit(0.0), lambda a, s: a + s)
            value = _part(run["bytes"], f["start"], f["end"])
            part = run["cut"] | (f["end"] - f["start"] < run["end"] - run["start"])
            varied = ~part | (F.size(F.array_distinct(F.split(value, ""))) >= MIN_DISTINCT)
            return varied & (total >= F.greatest(F.lit(min_ratio), F.lit(min_mean) * (f["end"] - f["start"]))) & F.regexp_like(value, F.lit("[A-Za-z]"))

        return F.transform(F.filter(found, good), lambda f: F.struct(
            (run["start"] + f["start"]).alias("start"), (run["start"] + f["end"]).alias("end"),
            _part(run["bytes"], f["start"], f["end"]).alias("value"),
        ))

    def judged(run: Column) -> Column:
        def parts(scores: Column) -> Column:
            whole = F.array(F.struct(F.lit(0).alias("start"), (run["end"] - run["start"]).alias("end")))
            tries = [whole, _stretches(scores, 0.0), _stretches(scores, min_mean)]
            first, second, third = (passing(run, scores, t) for t in tries)
            some = lambda a, b: _once(a, lambda x: F.when(F.size(x) > 0, x).otherwise(b))
            return some(first, some(second, third))

        return _once(F.transform(_steps(run["bytes"].cast("string")), lambda s: F.get(table, s)), parts)

    lettered = F.filter(runs, lambda m: F.regexp_like(m["bytes"].cast("string"), F.lit("[A-Za-z]")))
    return F.flatten(F.transform(lettered, judged))


def _part(run: Column, start: Column, end: Column) -> Column:
    """Characters of a run, which is ASCII and kept as bytes, so that a part is cut without a walk from its start."""
    return F.substring(run, start + 1, end - start).cast("string")


def _outside(runs: Column, base: Column) -> Column:
    """The pieces of ``runs`` of 16 characters or more outside all base spans, as structs (start, end, bytes, cut).

    One pass over runs and spans in order of their starts. A run stays open until the next one begins; spans that
    began before it or inside it move the place from which its next piece is taken.
    """
    ranges = F.transform(runs, lambda r: F.struct(
        r["start"].alias("start"), r["end"].alias("end"), F.lit(True).alias("is_run"), r["value"].cast("binary").alias("bytes")
    ))
    spans = F.transform(base, lambda b: F.struct(
        b["start"].alias("start"), b["end"].alias("end"), F.lit(False).alias("is_run"), F.lit(None).cast("binary").alias("bytes")
    ))
    # A last run, beyond any text, closes the one before it.
    last = F.array(F.struct(
        F.lit(2**31 - 1).alias("start"), F.lit(2**31 - 1).alias("end"), F.lit(True).alias("is_run"), F.lit(None).cast("binary").alias("bytes")
    ))
    none = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(False).alias("is_run"), F.lit(None).cast("binary").alias("bytes"))

    def found(state: Column, e: Column) -> Column:
        run, at = state["run"], state["at"]
        # A run ends its predecessor; a span ends the piece that it begins in.
        end = F.when(e["is_run"], run["end"]).otherwise(F.least(e["start"], run["end"]))
        return F.when(end - at >= 16, F.struct(
            at.alias("start"), end.alias("end"), F.substring(run["bytes"], at - run["start"] + 1, end - at).alias("bytes"),
            (end - at < run["end"] - run["start"]).alias("cut"),
        ))

    def step(state: Column, e: Column) -> Column:
        covered = F.greatest(state["covered"], F.when(~e["is_run"], e["end"]).otherwise(F.lit(0)))
        return F.struct(
            F.when(e["is_run"], e).otherwise(state["run"]).alias("run"),
            F.when(e["is_run"], F.greatest(e["start"], covered)).otherwise(F.greatest(state["at"], e["end"])).alias("at"),
            covered.alias("covered"),
        )

    first = F.struct(none.alias("run"), F.lit(0).alias("at"), F.lit(0).alias("covered"))
    events = F.concat(F.array_sort(F.concat(ranges, spans)), last)
    kind = "struct<start:int,end:int,bytes:binary,cut:boolean>"
    return F.when(F.size(runs) > 0, _emitted(events, first, step, found, kind))


def _written(kinds: dict[str, str]) -> Column:
    """kind:start:end of all spans, by start and then by kind as listed, comma-joined."""
    def one(nth: int, kind: str, column: str) -> Column:
        return F.transform(F.col(column), lambda m: F.struct(
            m["start"].alias("start"), F.lit(nth).alias("nth"), F.concat_ws(":", F.lit(kind), m["start"], m["end"]).alias("span")
        ))

    listed = [one(i, kind, column) for i, (kind, column) in enumerate(kinds.items())]
    return F.array_join(F.transform(F.array_sort(F.concat(*listed)), lambda s: s["span"]), ",")


def scan_secrets(docs: DataFrame, ratios: list[float] | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random, text.

    Base kinds are assign, access and hex; the models add kind random for stretches of runs outside all base spans. Null texts
    count as empty: no spans, the digest of nothing. Work is in proportion to a text's length, however many matches it
    has or however long a run is. Rows that repeat an id or a text are judged each on its own. No rows: an empty
    result. Other columns are ignored.
    """
    if ratios is None:
        ratios = train_ratios(labelled_samples(docs.sparkSession, docs))
    found = base_spans(docs)
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    runs = random_runs(F.col("text"), ratios, base=F.concat("assign", "access", "hex"))
    found = found.withColumn("random", F.coalesce(runs, none))
    base = {"assign": "assign", "access": "access", "hex": "hex"}
    return found.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in base],
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(base | {"random": "random"}).alias("spans"),
        F.size("random").cast("bigint").alias("n_random"),
        "text",
    )
