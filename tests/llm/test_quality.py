from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
from brute import TEXTS, documents
from pyspark.sql import functions as F

from candlewick.llm import quality
from candlewick.llm.text import pieces

LABELS = "doc_id long, quality int"


def examples(n):
    draw = random.Random(4)
    word = lambda: "".join(draw.choices("abcdefgh", k=draw.randrange(2, 7)))
    good = lambda: " ".join(word() for _ in range(draw.randrange(5, 80)))
    bad = lambda: draw.choice([lambda: (word() + " ") * 20, lambda: " ".join(word().upper() + "!!" for _ in range(20))])()
    return [(i, good() if i % 4 else bad(), int(bool(i % 4))) for i in range(n)]


def test_learns_and_keeps_held_out_labels_apart(spark):
    rows = examples(900)
    docs = documents(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], LABELS)
    weights = quality.train(docs, labels)
    scored = quality.score(docs, weights).select("doc_id", "score", quality.held_out(F.col("doc_id")).alias("held")).collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in scored)
    right = [(r.score >= 0.5) == bool(rows[r.doc_id][2]) for r in scored if r.held]
    assert len(right) > 150 and sum(right) / len(right) > 0.97
    wrong = spark.createDataFrame([(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, _, y in rows], LABELS)
    assert np.array_equal(weights, quality.train(docs, wrong))


def test_cases(spark):
    labels = spark.createDataFrame([(6, 1), (6, 1), (None, 1), (4, 0), (4, None), (999, 1), (12, 0)], LABELS)
    docs = documents(spark)
    rows = quality.score(docs.withColumn("score", F.lit("clash")), quality.train(docs, labels)).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (0, 1, 2)}) == 1


def test_empty(spark):
    none = spark.createDataFrame([], LABELS)
    weights = quality.train(documents(spark), none)
    assert {r.score for r in quality.score(documents(spark), weights).collect()} == {0.5}
    assert quality.score(documents(spark, []), weights).count() == 0


def test_a_score_is_the_dot_product(spark):
    weights = np.random.default_rng(1).normal(size=quality.BUCKETS + 1)
    texts = [(i, t) for i, t, _ in examples(30)]
    got = {r.doc_id: r.score for r in quality.score(documents(spark, texts), weights).collect()}
    for i, text in texts:
        (_, _, data, starts), *_ = pieces(pa.array([text]))
        row, bucket, value = quality._features(data, starts)
        assert set(row) == {0} and abs(np.sum(value**2) - 1) < 1e-9
        assert abs(got[i] - 1 / (1 + np.exp(-(weights[bucket] @ value + weights[-1])))) < 1e-5
