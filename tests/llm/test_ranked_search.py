from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from brute import _LOWER, TEXTS, documents

from candlewick.llm import ranked_search

ITEMS = "item_id long, text string, doc_id string, place int"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(_LOWER))


def brute(docs, items, k=10):
    counts = [(i, Counter(words(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 100 - 90 + (90 * c.total() * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(words(text)) if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **options):
    items = spark.createDataFrame([(i, t, "clash", 1) for i, t in items], ITEMS).repartition(2)
    return sorted((tuple(r) for r in ranked_search.rank(documents(spark, docs).repartition(3), items, **options).collect()), key=str)


def corpus(n, seed=1):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]

    def text(size):
        return " ".join(vocabulary[min(int(draw.expovariate(0.02)), 299)] for _ in range(size))

    docs = [(i, text(draw.choice([0, 3, 40, 200]))) for i in range(n)]
    docs += [(1000 + i, docs[5][1] + " planted") for i in range(40)]
    items = [(i, text(12)) for i in range(20)] + [(50, docs[5][1]), (51, "planted"), (52, "nowhere"), (53, ""), (54, None), (50, docs[5][1]), (None, "w1 w2")]
    return docs, items


def test_against_brute_force(spark):
    docs, items = corpus(400)
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, docs, items, k=3) == brute(docs, items, 3)


def test_odd_texts(spark):
    items = [(1, "The QUICK brown fox"), (2, "日本語 Ünïcödé"), (3, "ab x one"), (4, "!!! \x00"), (5, TEXTS[6][1])]
    assert found(spark, TEXTS, items) == brute(TEXTS, items)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == [] == found(spark, TEXTS, []) == found(spark, [(1, None), (2, "")], [(1, "a")])


def test_turns_parts_and_segments_change_nothing(spark, monkeypatch):
    docs, items = corpus(150, 2)
    want = brute(docs, items)
    # Sizes below are read on the driver or by the plain functions, so they hold here.
    monkeypatch.setattr(ranked_search, "TURN_BYTES", 200)
    assert found(spark, docs, items) == want
    monkeypatch.setattr(ranked_search, "PART", 64)
    for _, text in docs:
        assert [t.decode() for part in ranked_search.terms(text) for t in part] == words(text)


@pytest.mark.parametrize("size", [40, 3000])
def test_blocks_are_skipped_and_bounds_hold(size):
    """A segment by hand: fewer documents are scored than hold a term, and summaries bound every document of their block."""
    docs, items = corpus(size, 3)
    vocabulary = sorted({t for _, text in items for t in words(text)})
    places = {t: p for p, t in enumerate(vocabulary)}
    counts = [Counter(words(t)) for _, t in docs]
    n = np.array([c.total() for c in counts])
    rows = [sorted((places[t], c) for t, c in mine.items() if t in places) for mine in counts]
    ends = np.append(0, np.cumsum([len(r) for r in rows]))
    held, tf = (np.array([x[j] for r in rows for x in r], np.int64) for j in (0, 1))
    strength = ranked_search.strengths(tf, np.repeat(n, np.diff(ends)), int((n > 0).sum()), int(n.sum()))
    df = np.bincount(held, minlength=len(places))
    weight = np.array([ranked_search.weigh(int(d), int((n > 0).sum())) for d in df])
    asked = [np.array(sorted({places[t] for t in words(text)}), np.int64) for _, text in items]
    together = lambda term: np.unique(np.concatenate([a for a in asked if term in a]))
    segment = ranked_search.Segment(ends, held, strength, weight, together)
    ids = np.array([i for i, _ in docs], object)
    scored = reached = 0
    for item in asked:
        best = ranked_search.Best(10)
        scored += ranked_search.search(segment, ids, item, weight, best)
        reached += len({r for t in item for r in segment.list_of(int(t))})
    for term in range(len(places)):
        mine, starts, summary, place = segment.blocks(term)
        assert sorted(mine) == sorted(segment.list_of(term))
        for b in range(len(starts) - 1):
            for row in mine[starts[b] : starts[b + 1]]:
                for j in range(ends[row], ends[row + 1]):
                    if place[held[j]] >= 0:
                        assert summary[b, place[held[j]]] >= strength[j]
    assert scored <= reached
    if size > 1000:
        assert scored < 0.6 * reached
