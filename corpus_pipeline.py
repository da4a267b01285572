"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.

* quality: documents that the classifier scores below ``GOOD`` go. It learns from ``labels`` and the documents at hand.
* near_duplicates: one document of each class of near duplicates stays, the one with the least id.
* repeats: passages of 20 words or more that occur earlier are cut. A document that loses nothing keeps its text as it is, of
  others the words stay, one space between; one that loses all stays with an empty text.
* benchmark: documents with a passage of ``benchmark`` go.
* encode: token ids in place of the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import bpe, decontaminate, near_dup, quality, substring_dedup
from candlewick.llm.queries import RANK_FILE
from candlewick.session import staged

GOOD = 0.5
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.score(docs, quality.train(docs, labels)).where(F.col("score") >= GOOD).drop("score")


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs)


def _repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(docs.select("doc_id", "lang", "source", "n_chars", "text", F.col("text").alias("whole")))
    changed = F.col("n_removed") > 0
    return cut.select(
        "doc_id",
        F.when(changed, F.col("kept")).otherwise(F.col("whole")).alias("text"),
        "lang",
        "source",
        F.when(changed, F.length("kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def _benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    key = F.xxhash64("doc_id", "text")
    found = decontaminate.contamination(docs.select(key.alias("doc_id"), "text"), items)
    leaked = found.where(F.size("hits") > 0).select(F.col("doc_id").alias("_key")).distinct()
    return docs.withColumn("_key", key).join(leaked, "_key", "left_anti").select(*docs.columns)


def _encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)


STAGES = [
    ("quality", _quality),
    ("near_duplicates", _near_duplicates),
    ("repeats", _repeats),
    ("benchmark", _benchmark),
    ("encode", _encode),
]

#: SQL can't express the classifier or the signatures.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
