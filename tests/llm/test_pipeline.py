"""The pipeline: stages in order, their decisions take effect, clean documents stay."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from feeloom.llm import decontamination, jaccard_join, line_dedup, toxicity

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "decontamination", "mix"]
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], SF).cache())
    for made in frames[1:-1]:
        assert made.columns == docs.columns
    ids = [{r["doc_id"] for r in f.select("doc_id").collect()} for f in frames]
    assert all(b <= a for a, b in zip(ids[:-1], ids[1:], strict=True))
    # Toxicity drops exactly what its scores reject, and the line stage drops no document.
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rejected = {r["doc_id"] for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    assert rejected and ids[0] - ids[1] == rejected and ids[1] == ids[2]
    # One document of each group stays.
    groups = jaccard_join.jaccard_components(frames[2], 5, 80).collect()
    assert ids[3] == {r["component_id"] for r in groups}
    # No document with a benchmark item is left, and nothing else went.
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = {r["doc_id"] for r in decontamination.benchmark_matches(frames[3], bench).collect()}
    assert ids[3] - ids[4] == found
    assert frames[5].count() == frames[4].count()


def test_run_agrees_with_itself(spark):
    first, second = (sorted(map(tuple, corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect())) for _ in range(2))
    assert first == second and first


def test_rows_without_an_id_and_texts_of_one_id_are_judged(spark):
    kind = "doc_id long, text string, key string"
    lines = "\n".join(f"shared line {i}" for i in range(40))
    mine = "\n".join(f"my own line {i}" for i in range(40))
    docs = spark.createDataFrame([(1, lines, "k"), (2, mine, "k"), (2, lines, "k"), (None, lines, "k"), (None, None, "k")], kind)
    cut = sorted((r["doc_id"] or 9, r["text"] == mine, r["n_removed_lines"] > 30, r["n_lines"]) for r in line_dedup.dedup_lines(docs).collect())
    assert cut == [(1, False, False, 40), (2, False, True, 40), (2, True, False, 40), (9, False, False, 0), (9, False, True, 40)]
    words = [" ".join(f"{w}{i}" for i in range(60)) for w in "ab"]
    docs = spark.createDataFrame(
        [(1, words[0], "k"), (2, words[0] + " end", "k"), (2, words[1], "k"), (None, words[0], "k"), (None, "c d e f g h", "k"),
         (None, "c d e f g h", "j"), (None, "", "k"), (None, "", "k")], kind,
    )
    kept = jaccard_join.keep_first_of_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 9, r["text"]) for r in kept.collect()) == [(1, words[0]), (2, words[1]), (9, ""), (9, ""), (9, "c d e f g h")]
    bench = spark.createDataFrame([(1, " ".join(f"a{i}" for i in range(20)))], "item_id long, text string")
    clean = decontamination.drop_contaminated(docs, bench).collect()
    assert sorted((r["doc_id"] or 9, r["text"]) for r in clean) == [(2, words[1]), (9, ""), (9, ""), (9, "c d e f g h"), (9, "c d e f g h")]


# Names that the operators use for columns of their own.
INSIDE = [
    "row", "key", "row_key", "id", "n_lines", "n_removed_lines", "n_removed_chunks", "removed_places", "removal_key", "kept_text", "lost_lines", "chunk", "chunks",
    "place", "places", "digest", "same", "first", "drop_key", "nth_copy", "no_id", "component_id", "n_shingles", "bad_key", "rep", "component", "block",
    "size", "source_name", "ahead", "score", "predicted", "item_id", "distance", "a", "b", "n", "rid", "tid", "words",
]


def test_any_column_name_passes_the_stages(spark):
    lines = "\n".join(f"shared line {i}" for i in range(40))
    texts = [(1, lines, "a"), (2, "own line\n" + lines, "a"), (3, " ".join(f"a{i}" for i in range(60)), None), (4, " ".join(f"a{i}" for i in range(60)) + " x", "b"),
             (None, None, "b"), (None, "c d e f g h", "b"), (None, "c d e f g h", "b")]
    plain = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in texts], "doc_id long, text string, lang string, source string, n_chars long")
    crowded = plain.select("*", *[F.concat(F.lit(f"{name}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(name) for name in INSIDE])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        want, got = stage(spark, plain, SF), stage(spark, crowded, SF)
        assert got.columns == crowded.columns, name
        rows = got.collect()
        assert sorted(map(repr, want.collect())) == sorted(repr(r) for r in got.select(*plain.columns).collect()), name
        assert all(r[c] == f"{c}:{r['doc_id'] if r['doc_id'] is not None else 'none'}" for r in rows for c in INSIDE), name
    assert corpus_pipeline.STAGES[-1][1](spark, crowded, SF).count() == len(texts)
