from __future__ import annotations

import random
from collections import Counter

import pytest
from brute import documents, ink_words, small_words

from candlewick.llm import token_counts
from candlewick.llm.token_counts import TokenCounts, revised, signed

COUNTS = "source string, lang string, n long, m long"


def totals(store):
    return {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in store.totals().collect()}


def test_versions(spark):
    docs = documents(spark)
    rows = docs.select("text", *(token_counts.count(docs.text, v).alias(v) for v in token_counts.VERSIONS)).collect()
    for text, first, second in rows:
        assert (first, second) == (len(ink_words(text)), len(small_words(text)))


def test_batches_against_a_dictionary(spark, tmp_path):
    draw = random.Random(1)
    store, plain = TokenCounts(spark, f"file://{tmp_path}/counts"), Counter()
    for batch in range(6):
        rows = [(draw.choice(["a", "b", None]), draw.choice(["en", None]), draw.randrange(50), draw.randrange(50)) for _ in range(draw.randrange(30))]
        frame = spark.createDataFrame(rows, COUNTS)
        changes = {0: signed(frame, 1, "v1", "n"), 1: signed(frame, -1, "v2", "m"), 2: revised(frame, "v1", "n", "m")}[batch % 3]
        for source, lang, n, m in rows:
            key = (source, lang, "v2" if batch % 3 == 1 else "v1")
            plain[key, "documents"] += {0: 1, 1: -1, 2: 0}[batch % 3]
            plain[key, "tokens"] += {0: n, 1: -m, 2: m - n}[batch % 3]
        assert store.commit(f"b{batch}", changes)
        assert not store.commit(f"b{batch}", changes)
        if batch in (1, 4):
            store.fold()
            assert not store.commit("b0", changes)
        want = {k: (plain[k, "documents"], plain[k, "tokens"]) for k, _ in plain if plain[k, "documents"] or plain[k, "tokens"]}
        assert totals(store) == want


def test_a_failed_batch_is_written_anew(spark, tmp_path):
    store = TokenCounts(spark, str(tmp_path))
    frame = spark.createDataFrame([("a", "en", 5, 0)], COUNTS)
    assert store.commit("one", signed(frame, 1, "v", "n"))
    (tmp_path / "batches/one/_SUCCESS").unlink()
    assert totals(store) == {}
    assert store.commit("one", signed(frame, 1, "v", "n"))
    assert totals(store) == {("a", "en", "v"): (1, 5)}


def test_a_commit_during_a_fold_counts_once(spark, tmp_path, monkeypatch):
    store = TokenCounts(spark, str(tmp_path))
    frame = spark.createDataFrame([("a", "en", 5, 0)], COUNTS)
    store.commit("one", signed(frame, 1, "v", "n"))
    added = store._added

    def late(base, batches):
        monkeypatch.undo()
        store.commit("two", signed(frame, 1, "v", "n"))
        return added(base, batches)

    monkeypatch.setattr(store, "_added", late)
    store.fold()
    assert totals(store) == {("a", "en", "v"): (2, 10)}
    store.fold()
    assert totals(store) == {("a", "en", "v"): (2, 10)}


def test_empty_null_and_names(spark, tmp_path):
    store = TokenCounts(spark, str(tmp_path))
    assert totals(store) == {}
    none = spark.createDataFrame([], COUNTS)
    assert store.commit("none", signed(none, 1, "v", "n")) and totals(store) == {}
    assert store.commit("null", signed(spark.createDataFrame([(None, None, None, None)] * 2, COUNTS), 1, "v", "n"))
    assert totals(store) == {(None, None, "v"): (2, 0)}
    for name in ("", "a/b", "_x", ".x"):
        with pytest.raises(ValueError):
            store.commit(name, signed(none, 1, "v", "n"))
