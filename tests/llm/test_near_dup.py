from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from brute import TEXTS, documents, near_classes, shingles, weighted_likeness

import corpus_pipeline
from candlewick.llm import near_dup
from candlewick.llm.components import components


def grouped(spark, texts):
    """Places of the rows of each class."""
    rows = near_dup.classes(documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    found = {}
    for r in rows:
        found.setdefault(r.keeper, []).append(r)
    return found


def test_cases(spark):
    texts = [(n, t) for n, (_, t) in enumerate(TEXTS)]
    roots = near_classes([t for _, t in texts])
    rows = {r.doc_id: r.class_id for r in near_dup.classes(documents(spark, texts)).collect()}
    assert rows == dict(enumerate(roots))


def test_null_and_equal_ids(spark):
    found = grouped(spark, TEXTS)
    assert sum(map(len, found.values())) == len(TEXTS)
    kept = near_dup.keep_one(documents(spark)).collect()
    assert len(kept) == len(found)
    assert sum(r.doc_id == 17 for r in kept) == 1


def variants(draw, words, n):
    out = []
    for _ in range(n):
        own = list(words)
        for _ in range(draw.randrange(4)):
            own[draw.randrange(len(own))] = f"new{draw.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_of_near_copies(spark, seed):
    draw = random.Random(seed)
    texts = []
    for g in range(12):
        base = [f"g{g}w{draw.randrange(500)}" for _ in range(120)]
        texts += variants(draw, base, draw.choice([1, 2, 5, 40]))
    draw.shuffle(texts)
    rows = {r.doc_id: r.class_id for r in near_dup.classes(documents(spark, list(enumerate(texts)))).collect()}
    assert rows == dict(enumerate(near_classes(texts)))


def test_one_cluster_is_whole(spark):
    draw = random.Random(3)
    texts = variants(draw, [f"w{draw.randrange(500)}" for _ in range(120)], 60)
    rows = {r.doc_id: r.class_id for r in near_dup.classes(documents(spark, list(enumerate(texts)))).collect()}
    assert rows == dict(enumerate(near_classes(texts)))


def of_template(draw, copies, groups):
    """A class of ``copies`` near copies, and two near copies of each of ``groups`` texts that share most of its words, but are a little
    less alike than near duplicates."""
    base, texts = [f"w{n}" for n in range(160)], []

    def changed(words, places, name):
        return [f"{name}n{n}" if n in places else w for n, w in enumerate(words)]

    for c in range(copies):
        texts.append(" ".join(changed(base, [draw.randrange(5, 155)], f"c{c}")))
    for g, places in enumerate(draw.sample(list(combinations(range(5, 155, 5), 4)), groups)):
        one = changed(base, places, f"g{g}")
        texts += [" ".join(one), " ".join(changed(one, [draw.randrange(5, 155)], f"o{g}"))]
    draw.shuffle(texts)
    return texts


def borderline(draw, pairs):
    """Texts with nine changes to one template each, two of them in five of the same places: those are alike just enough, other two
    hardly ever, and all share nothing but the template, so that they meet in large bands only."""
    texts = []
    for g in range(pairs):
        places = draw.sample(range(5, 595, 5), 13)
        for name, own in (("a", places[:9]), ("b", places[4:])):
            texts.append(" ".join(f"{name}{g}n{n}" if n in own else f"w{n}" for n in range(600)))
    draw.shuffle(texts)
    return texts


def right_classes(texts, like=0.8):
    """``near_classes`` of texts that repeat no shingle, all pairs at once."""
    number = {}
    rows = [[number.setdefault(s, len(number)) for s in shingles(t)] for t in texts]
    held = np.zeros((len(texts), len(number)), np.float32)
    for n, row in enumerate(rows):
        held[n, row] = 1
    both, size = held @ held.T, held.sum(axis=1)
    root = np.arange(len(texts))
    for a, b in zip(*np.nonzero(both / (size[:, None] + size - both) >= like), strict=True):
        low, high = sorted((root[a], root[b]))
        root[root == high] = low
    return root.tolist()


def test_template_in_large_bands(spark):
    texts = borderline(random.Random(4), 450)
    right = right_classes(texts)
    assert 300 < len(set(right)) <= 450
    rows = {r.doc_id: r.class_id for r in near_dup.classes(documents(spark, list(enumerate(texts)))).collect()}
    assert rows == dict(enumerate(right))


def test_pipeline_keeps_one_of_a_template_class(spark):
    texts = borderline(random.Random(5), 450)
    kept = corpus_pipeline._near_duplicates(spark, documents(spark, list(enumerate(texts))), "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(right_classes(texts)))


@pytest.mark.parametrize("part", [near_dup.PART, 3000])
def test_large_bands_are_whole(spark, monkeypatch, part):
    """One large class and small ones beside it, in one part and in several."""
    monkeypatch.setattr(near_dup, "PART", part)
    draw = random.Random(6)
    texts = of_template(draw, 60, 25)
    rows = {r.doc_id: r.class_id for r in near_dup.classes(documents(spark, list(enumerate(texts)))).collect()}
    assert rows == dict(enumerate(near_classes(texts)))


def test_empty(spark):
    assert near_dup.classes(documents(spark, [])).count() == 0
    assert near_dup.keep_one(documents(spark, [])).count() == 0


def test_signatures_agree_with_the_likeness_of_weights():
    draw = np.random.default_rng(5)
    errors = []
    for _ in range(60):
        a = Counter({int(e): float(w) for e, w in zip(draw.integers(0, 60, 40), draw.choice([0.3, 1, 2.5, 7], 40), strict=True)})
        b = Counter({e: w for e, w in a.items() if draw.random() < 0.8} | {int(e): 1.0 for e in draw.integers(60, 90, 6)})
        rows = np.array([0] * len(a) + [1] * len(b))
        marks = near_dup.mix(np.array([*a, *b], np.uint64) + np.uint64(1))
        signs = near_dup.dart_signatures(rows, marks, np.array([*a.values(), *b.values()]), 2, 200)
        assert (signs != 0).all()
        errors.append(np.mean(signs[0] == signs[1]) - weighted_likeness(a, b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_components(spark):
    draw = random.Random(8)
    links = [(a, a + 1) for a in range(0, 60)] + [(100, n) for n in range(101, 140)] + [(draw.randrange(200, 260), draw.randrange(200, 260)) for _ in range(50)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: find(i) for i in root if find(i) != i}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
