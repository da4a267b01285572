from __future__ import annotations

import random

import pytest
from brute import BASE, DOCS, TEXTS, documents, hits, small_words, twins

from candlewick.llm import decontaminate

ITEMS = [
    (1, BASE[:160]),
    (2, BASE[40:]),
    (3, "word"),
    (3, "word"),
    (4, None),
    (5, "..."),
    (None, "seven eight nine ten"),
    (6, "日本語 テキスト Ünïcödé"),
    (7, "ab ab ab ab ab ab ab ab ab ab ab"),
]


def found(spark, texts, items, **options):
    frame = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contamination(documents(spark, texts), frame, **options).collect()
    return sorted(((r.doc_id, r.n_words, r.hits, r.items) for r in rows), key=str)


def wanted(texts, items):
    return sorted(((i, *h) for (i, _), h in zip(texts, hits([t for _, t in texts], items), strict=True)), key=str)


def test_cases(spark):
    assert found(spark, TEXTS, ITEMS) == wanted(TEXTS, ITEMS)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random(spark, seed, monkeypatch):
    """Few words, so windows overlap; small segments and several turns."""
    draw = random.Random(seed)
    text = lambda n: " ".join(draw.choices(["a", "b", "c", "D"], k=draw.randrange(n)))
    texts = [(i, text(200)) for i in range(60)]
    items = [(i % 7, text(25)) for i in range(12)]
    monkeypatch.setattr(decontaminate, "SEGMENT_WORDS", 500)
    monkeypatch.setattr(decontaminate, "TURN_WORDS", 20)
    assert found(spark, texts, items) == wanted(texts, items)


def test_proximity(spark):
    item = "alpha beta gamma delta"
    texts = [(1, "delta x gamma x beta x alpha"), (2, "alpha beta" + " x" * 40 + " gamma delta"), (3, item), (4, "alpha beta gamma")]
    rows = decontaminate.contamination(documents(spark, texts), spark.createDataFrame([(9, item)], "item_id long, text string"), reach=6)
    assert {r.doc_id: (r.items, r.near_items) for r in rows.collect()} == {1: ([], ["9"]), 2: ([], []), 3: (["9"], ["9"]), 4: ([], [])}


def test_empty(spark):
    assert found(spark, [], ITEMS) == []
    assert found(spark, [(1, "a b")], []) == [(1, 2, [], [])]


def test_index_holds_every_posting(spark, tmp_path):
    index = decontaminate.build_index(documents(spark), str(tmp_path / "index"))
    assert index.where("kind = 0").selectExpr("sum(n)").first()[0] == sum(len(small_words(t)) for _, t in TEXTS)
    assert index.where("kind = 1").count() == len(TEXTS)
    assert "text" in DOCS


def test_words_that_are_built_to_collide(spark):
    one, other = twins()
    passage = " ".join(f"w{n}" for n in range(9))
    texts, items = [(1, f"{passage} {one}"), (2, f"{passage} {other}")], [(1, f"{passage} {one}")]
    assert found(spark, texts, items) == wanted(texts, items) == [(1, 10, list(range(10)), ["1"]), (2, 10, [], [])]
