from __future__ import annotations

import hashlib
import math
import random

import numpy as np

from candlewick.llm import centroids

VECTORS = "vec_id long, embedding array<double>, cluster string, total int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], VECTORS)


def brute(rows, k=16, rounds=3):
    points = [
        (i, [math.floor(64 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    first = sorted(points, key=lambda p: (p[0] is None, hashlib.sha256(f"1:{p[0]}".encode()).hexdigest() if p[0] is not None else "", p[1]))
    centres = [list(v) for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        inside = [[] for _ in centres]
        for _, v in points:
            inside[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(mine) for x in zip(*mine, strict=True)] if mine else c for mine, c in zip(inside, centres, strict=True)]
    found = [(i, *nearest(v)[::-1]) for i, v in points]
    inertia = [sum(d for _, c, d in found if c == j) for j in range(len(centres))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, inertia[c], sum(inertia), sha[c]) for i, c, d in found), key=str)


def found(spark, rows, **options):
    columns = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((tuple(r) for r in centroids.clusters(frame(spark, rows), **options).select(*columns).collect()), key=str)


def random_rows(n, seed=1, spread=1.0):
    draw = random.Random(seed)
    homes = [[draw.gauss(0, 1) for _ in range(64)] for _ in range(7)]
    return [(i, [x + draw.gauss(0, spread) for x in homes[i % 7]]) for i in range(n)]


def test_transform_keeps_distances():
    points = np.random.default_rng(1).integers(-1000, 1000, (6, 64))
    plain = ((points[:, None] - points[None]) ** 2).sum(2)
    coefficients = centroids.transform(points)
    assert (((coefficients[:, None] - coefficients[None]) ** 2).sum(2) == 64 * plain).all()
    # Coarse first: the k-th coefficient is of the k-th number of sign changes.
    signs = centroids.transform(np.eye(64, dtype=np.int64)).T
    assert [int((np.diff(row) != 0).sum()) for row in signs] == list(range(64))


def test_rounds_against_brute_force(spark):
    for spread in (0.05, 1.0):
        rows = random_rows(150, 2, spread)
        assert found(spark, rows) == brute(rows)
        assert found(spark, rows, k=5, rounds=1) == brute(rows, 5, 1)


def test_vectors_left_out_ties_and_copies(spark):
    flat = [0.5] * 64
    rows = [
        (1, None), (2, []), (3, flat[:63]), (4, [*flat, 1.0]), (5, [*flat[:63], None]), (6, [*flat[:63], math.nan]), (7, [*flat[:63], math.inf]),
        (8, flat), (8, flat), (9, flat), (None, flat), (None, [-x for x in flat]), *((20 + i, [0.1 * (i % 3)] * 64) for i in range(30)),
    ]
    assert found(spark, rows) == brute(rows)


def test_few_and_none(spark):
    rows = random_rows(5)
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == [] == found(spark, [(1, None)])


def test_large_components(spark):
    rows = random_rows(40)
    big = [(i, [x * 2.0**19 for x in v]) for i, v in rows]
    assert found(spark, big) == brute(big)
    near = [(1, [1e300] * 64), (2, [1e300] * 64)]
    assert centroids.quantised(np.array([near[0][1]]))[0, 0] == math.floor(64 * 1e300)
    assert centroids.quantised(np.array([[1e308] * 64]))[0, 0] == int(1e308) * 64


def test_elimination_and_ties_in_the_search():
    draw = np.random.default_rng(3)
    for k in (1, 2, 40):
        points, centres = draw.integers(-3, 3, (500, 64)), draw.integers(-3, 3, (k, 64))
        centres[k // 2] = centres[0]
        points[:50] = centres[draw.integers(0, k, 50)]
        cluster, distance = centroids.nearest(points, centres)
        plain = ((points[:, None] - centres[None]) ** 2).sum(2)
        assert (cluster == plain.argmin(1)).all() and (distance == plain.min(1)).all()
