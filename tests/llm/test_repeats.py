from __future__ import annotations

import random

import numpy as np
import pytest
from brute import TEXTS, documents, ink_words, repeated, sha, twins

from candlewick.llm import repeats, substring_dedup, suffix_dedup


def by_bytes(spark, texts):
    rows = suffix_dedup.remove_repeats(documents(spark, texts)).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), sha(bytes(r.kept))) for r in rows), key=str)


def plain_bytes(texts):
    data = [(t or "").encode() for _, t in texts]
    out = []
    for (i, _), d, gone in zip(texts, data, repeated(data, suffix_dedup.LENGTH), strict=True):
        spans = sum(g and not (n and gone[n - 1]) for n, g in enumerate(gone))
        out.append((i, len(d), sum(gone), spans, sha(bytes(b for b, g in zip(d, gone, strict=True) if not g))))
    return sorted(out, key=str)


def by_words(spark, texts):
    rows = substring_dedup.remove_repeats(documents(spark, texts)).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows), key=str)


def plain_words(texts):
    data = [tuple(ink_words(t)) for _, t in texts]
    out = []
    for (i, _), d, gone in zip(texts, data, repeated(data, substring_dedup.LENGTH), strict=True):
        out.append((i, len(d), sum(gone), " ".join(w for w, g in zip(d, gone, strict=True) if not g)))
    return sorted(out, key=str)


UNIQUE = [(i, t) for i, t in TEXTS if i is not None and i not in (16, 17)]


def test_cases(spark):
    first = [(i, t) for i, t in TEXTS if i is None]
    got = by_bytes(spark, first + UNIQUE)  # a null id comes first
    assert got == plain_bytes(first + UNIQUE)
    assert by_words(spark, first + UNIQUE) == plain_words(first + UNIQUE)


def test_equal_ids(spark):
    """One of two texts with one id keeps what they share; repeated rows have the same result."""
    rows = by_words(spark, TEXTS)
    assert len(rows) == len(TEXTS)
    assert len({r for r in rows if r[0] == 17}) == 1 and {r[2] for r in rows if r[0] == 17} == {0}
    shared = [(16, "first of two " + " ".join(f"w{i}" for i in range(60))), (16, "second " + " ".join(f"w{i}" for i in range(60)))]
    assert sorted(r[2] for r in by_words(spark, shared)) == [0, 60]
    assert sorted(r[2] > 0 for r in by_bytes(spark, shared)) == [False, True]


@pytest.mark.parametrize("block", [repeats.BLOCK, 400])
@pytest.mark.parametrize("seed", [1, 2])
def test_random(spark, seed, block, monkeypatch):
    """Shared passages, cut at random places, and low-entropy runs; small blocks cut grams."""
    draw = random.Random(seed)
    pool = ["".join(draw.choices("abcdef gh", k=400)) for _ in range(3)] + ["a b " * 150, "zz" * 200]
    texts = []
    for i in range(60):
        parts = []
        for _ in range(draw.randrange(4)):
            p = draw.choice(pool)
            a = draw.randrange(len(p))
            parts += [p[a : a + draw.randrange(400)], "".join(draw.choices("abcdefgh ", k=draw.randrange(90)))]
        texts.append((i, " ".join(parts)))
    monkeypatch.setattr(repeats, "BLOCK", block)
    assert by_bytes(spark, texts) == plain_bytes(texts)
    assert by_words(spark, texts) == plain_words(texts)


def test_empty(spark):
    assert by_bytes(spark, []) == [] and by_words(spark, []) == []


@pytest.mark.parametrize("seed", range(4))
def test_suffix_sort(seed):
    draw = np.random.default_rng(seed)
    raw = draw.integers(97, 99, 600).astype(np.uint8)
    start, group = draw.integers(0, 580, 300), draw.integers(0, 5, 300)
    order = suffix_dedup.Suffixes(raw, 20).sort(start, group)
    keys = [(group[i], raw[start[i] : start[i] + 20].tobytes()) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(300))


def test_collisions_remove_nothing(monkeypatch):
    """Hashes that all collide: the bytes decide."""
    raw = np.random.default_rng(0).integers(97, 123, 500).astype(np.uint8)
    raw[300:330] = raw[100:130]
    start = np.array([100, 200, 300, 400])
    monkeypatch.setattr(suffix_dedup.Suffixes, "_same", lambda self, a, b, size: np.ones(len(a), bool))
    label = suffix_dedup.same_windows(raw, start, np.zeros(4, np.int64), 30)
    assert label[0] == label[2] and len(set(label)) == 3


def test_deep_nodes():
    raw = np.array([1, 2, 3, 4, 1, 2, 3, 5, 1, 2, 3, 4], np.uint64)
    label = substring_dedup.deep_nodes(raw, np.array([0, 4, 8]), np.zeros(3, np.int64), 4)
    assert label[0] == label[2] != label[1]
    label = substring_dedup.deep_nodes(raw, np.array([0, 8]), np.array([0, 1]), 4)
    assert label[0] != label[1]


def test_words_that_are_built_to_collide(spark):
    common = " ".join(f"w{n}" for n in range(19))
    texts = [(n, f"{common} {word} tail {n}") for n, word in enumerate(twins())]
    assert by_words(spark, texts) == plain_words(texts)
    assert sum(n for _, _, n, _ in plain_words(texts)) == 0
