"""Registered queries of the corpus operators: each reads whole tables below ``sf_dir`` and returns its full result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import (
    bpe,
    centroids,
    decontaminate,
    fingerprint,
    near_dup,
    packing,
    quality,
    ranked_search,
    reshard,
    substring_dedup,
    suffix_dedup,
    token_counts,
    url_filter,
)
from candlewick.session import new_dir, staged

#: The rules of the URL query and the vocabularies of the encoding and the packing query.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
RANK_FILE = "byte_bpe_multi_50k.tiktoken"
PACKED_FILE = "word_bpe_49k.json"
OLD_SHARDS, NEW_SHARDS = 32, 40


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, listed).select("page_id", "host", "path", "rule", "verdict")


def op2_benchmark_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, _table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
    )


def op3_min_cost_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    old = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(OLD_SHARDS))
    layout, _ = reshard.plan(docs, old, NEW_SHARDS)
    return layout.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("old").alias("old_shard"),
    )


def op4_weighted_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality.train(docs, _table(spark, sf_dir, "labels").select("doc_id", "quality"))
    scored = quality.score(docs, weights)
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


def op6_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_token_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional counts are loaded, revised, joined by those of a second tokenizer, and junk is deleted; one batch comes twice."""
    docs = _table(spark, sf_dir, "documents")
    counts = staged(
        docs.select(
            "doc_id",
            "source",
            "lang",
            F.expr("n_chars div 6").alias("guess"),
            *(token_counts.count(F.col("text"), v).alias(v) for v in token_counts.VERSIONS),
        ),
        "counts",
    )
    junk = counts.join(_table(spark, sf_dir, "labels").where("quality = 0").select("doc_id"), "doc_id", "left_semi")
    totals = token_counts.TokenCounts(spark, new_dir(spark, "token-counts"))
    first, second = token_counts.VERSIONS
    totals.commit("load", token_counts.signed(counts, 1, first, "guess"))
    totals.commit("revise", token_counts.revised(counts, first, "guess", first))
    totals.fold()
    totals.commit("second", token_counts.signed(counts, 1, second, second))
    totals.commit("reject", token_counts.signed(junk, -1, first, first).unionByName(token_counts.signed(junk, -1, second, second)))
    totals.commit("revise", token_counts.revised(counts, first, "guess", first))
    return totals.totals()


def op8_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)


def op10_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.classes(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "copy_id", "class_id")


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path(PACKED_FILE), ids=False)


def op12_hadamard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.clusters(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return ranked_search.rank(docs.select("doc_id", "text"), items.select("item_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_benchmark_index": op2_benchmark_index,
    "op3_min_cost_resharding": op3_min_cost_resharding,
    "op4_weighted_fingerprint": op4_weighted_fingerprint,
    "op5_quality_ftrl": op5_quality_ftrl,
    "op6_suffix_sort": op6_suffix_sort,
    "op7_token_deltas": op7_token_deltas,
    "op8_suffix_trees": op8_suffix_trees,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_dart_minhash": op10_dart_minhash,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_hadamard_clusters": op12_hadamard_clusters,
    "op13_ranked_search": op13_ranked_search,
}
