"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from feeloom.llm import (
    bwt_dedup, chaining, decontamination, jaccard_join, line_dedup, main_text, mixing, periodic_runs, permutation_index,
    prefix_trie, secrets, token_counts, toxicity,
)
from feeloom.llm.common import read_table


def op1_secret_scan(spark, sf_dir):
    return secrets.scan_secrets(read_table(spark, sf_dir, "documents")).drop("text")


def op2_permutation_index(spark, sf_dir):
    return permutation_index.search_by_modulus(read_table(spark, sf_dir, "embeddings"))


def op3_bwt_dedup(spark, sf_dir):
    cut = bwt_dedup.dedup_bytes(read_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")


def op4_line_dedup(spark, sf_dir):
    kept = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed_lines", "n_removed_chunks",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_toxicity(spark, sf_dir):
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_source_mix(spark, sf_dir):
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"))


def op7_chained_passages(spark, sf_dir):
    return chaining.fuzzy_passages(read_table(spark, sf_dir, "documents"))


def op8_decontamination(spark, sf_dir):
    return decontamination.benchmark_matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_token_counts(spark, sf_dir):
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark, sf_dir):
    docs = periodic_runs.with_repeated_tail(read_table(spark, sf_dir, "documents"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs))


def op12_main_text(spark, sf_dir):
    pages = main_text.extract_main_text(read_table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", "n_chars")


def op13_prefix_trie(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations")
    return prefix_trie.trie_report(prefix_trie.rebuild_conversations(turns))


QUERIES = {name: f for name, f in sorted(globals().items()) if name.startswith("op") and callable(f)}
