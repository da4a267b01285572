"""Centroid clustering: Lloyd's rounds, with the nearest centroid found by Walsh-Hadamard progressive search.

Vectors become whole numbers, so everything is exact. The unnormalised Walsh-Hadamard transform keeps distances but for
the factor 64: |Hx - Hc|^2 = 64 |x - c|^2. Coefficients come in the order of sequency, coarse before fine, and their squared
differences are added up in steps. What is added so far is a lower bound of the whole, and the whole distance of the centroid
that leads after the first step an upper bound of the least; a centroid is out once its lower bound is strictly above the upper one. Those
left after all 64 have their distance, ties included.

Tasks add up their vectors per centroid and hand over one sum per centroid and component at their end; Spark adds these, and the driver
gets centroids x 64 numbers a round. No vector is shuffled. The vectors are read once a round, so give a table, not a plan that is dear to repeat.

A vector that is null, hasn't exactly 64 components, or has one that is null or not finite is left out. Fewer vectors than centroids: each
is a centroid of its own. Repeated rows and equal ids are vectors of their own; of equal start hashes the lesser vector comes first. A null id hashes last. An
empty table gives no rows. Components of 2^24 and above (after scaling) are worked out in Python's whole numbers; a distance or sum that doesn't
fit its column (64 bits; 38 digits for sums of components) fails the job. Other columns are dropped, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.session import staged

DIMS = 64
SCALE = 64
#: Coefficients that are added up before each elimination.
STEPS = (4, 16, 32)
#: (vector, centroid) pairs looked at together.
PAIRS = 1 << 18
#: Components below this stay exact in 64 bits: 64 x 64 x (2 x 2^24)^2 is 2^62.
EXACT = 1 << 24


def kept(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the vectors that take part."""
    whole = f"size(embedding) = {DIMS} and forall(embedding, x -> x is not null and abs(x) < double('Infinity') and not isnan(x))"
    return vectors.select("vec_id", F.col("embedding").cast("array<double>")).where(whole)


def quantised(embedding: np.ndarray) -> np.ndarray:
    """floor(64 x) as whole numbers; of Python's kind if some are large."""
    with np.errstate(over="ignore"):
        scaled = np.floor(embedding * SCALE)
    if np.abs(scaled).max(initial=0) < EXACT:
        return scaled.astype(np.int64)
    # Beyond the doubles, x is whole itself.
    exact = [int(y) if np.isfinite(y) else int(x) * SCALE for x, y in zip(embedding.ravel(), scaled.ravel(), strict=True)]
    return np.array(exact, object).reshape(embedding.shape)


def _sequency(bits: int) -> list[int]:
    """Rows of the Hadamard matrix from few sign changes to many: bit-reversed Gray codes."""
    return [int(format(i ^ (i >> 1), f"0{bits}b")[::-1], 2) for i in range(1 << bits)]


_ORDER = _sequency(DIMS.bit_length() - 1)


def transform(points: np.ndarray) -> np.ndarray:
    """The exact Walsh-Hadamard transform of each row, coarse coefficients first."""
    out, half = points, 1
    while half < DIMS:
        pairs = out.reshape(len(points), -1, 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(points), DIMS)
        half *= 2
    return out[:, _ORDER]


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of whole numbers the nearest centre (ties: the first) and the squared distance."""
    if points.dtype == object or centres.dtype == object or np.abs(centres).max(initial=0) >= EXACT:
        points, centres = points.astype(object), centres.astype(object)
    targets, block = transform(centres), max(1, PAIRS // len(centres))
    found = [_search(transform(points[i : i + block]), targets) for i in range(0, len(points), block)]
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *(f[0] for f in found)]), np.concatenate([empty, *(f[1] for f in found)])


def _search(rows: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(rows)
    steps = rows[:, None, : STEPS[0]] - targets[None, :, : STEPS[0]]
    so_far = (steps * steps).sum(2)
    rest = rows[:, STEPS[0] :] - targets[so_far.argmin(1), STEPS[0] :]
    most = so_far.min(1) + (rest * rest).sum(1)
    row, centre = np.nonzero(so_far <= most[:, None])
    partial = so_far[row, centre]
    for first, last in zip(STEPS, (*STEPS[1:], DIMS), strict=True):
        step = rows[row, first:last] - targets[centre, first:last]
        partial = partial + (step * step).sum(1)
        left = np.asarray(partial <= most[row], bool)
        row, centre, partial = row[left], centre[left], partial[left]
    # The leader of the first step is always left, so each row has one, in the order of rows and centres.
    least = np.minimum.reduceat(partial, np.searchsorted(row, np.arange(n)))
    best = np.flatnonzero(partial == least[row])
    _, first = np.unique(row[best], return_index=True)
    return centre[best[first]], least // DIMS


def _points(batch: pa.RecordBatch) -> np.ndarray:
    return quantised(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMS))


def _sums(centres: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(centres.shape, object), np.zeros(len(centres), np.int64)
        for batch in batches:
            points = _points(batch)
            cluster, _ = nearest(points, centres)
            n += np.bincount(cluster, minlength=len(centres))
            for c in np.unique(cluster):
                total[c] += points[cluster == c].sum(0).astype(object)
        c, place = np.nonzero(np.broadcast_to(n[:, None] > 0, centres.shape))
        sums = [Decimal(int(x)) for x in total[c, place]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int32()), pa.array(place, pa.int32()), pa.array(sums, pa.decimal128(38, 0)), pa.array(n[c])], ["cluster", "place", "total", "n"]
        )

    return add


def starts(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """The kept vectors with the least hashes of seed and id, ``k`` of them at most."""
    turn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = points.orderBy(turn.asc_nulls_last(), "embedding").limit(k).collect()
    return quantised(np.array([r.embedding for r in first], np.float64).reshape(-1, DIMS))


def fit(points: DataFrame, k: int, rounds: int, seed: int = 1) -> np.ndarray:
    """Centroids after the rounds. ``points`` as by ``kept``. An empty cluster keeps its centroid."""
    centres = starts(points, k, seed)
    for _ in range(rounds if len(centres) else 0):
        sums = points.mapInArrow(_sums(centres), "cluster int, place int, total decimal(38, 0), n long")
        found = sums.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
        moved = centres.astype(object)
        for r in found:
            moved[r.cluster, r.place] = int(r.total) // r.n
        centres = moved.astype(np.int64) if max(map(abs, moved.ravel())) < EXACT else moved
    return centres


def assign(points: DataFrame, centres: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance of every vector of ``points``. Without centres there is no vector."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = nearest(_points(batch), centres)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance.tolist(), pa.int64())], ["vec_id", "cluster", "distance"]
            )

    key = points.schema["vec_id"].dataType
    return points.mapInArrow(judge, T.StructType().add("vec_id", key).add("cluster", T.IntegerType()).add("distance", T.LongType()))


def digest(centre: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centre.tolist())).encode()).hexdigest()


def clusters(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256 of every vector that takes part."""
    points = kept(vectors)
    centres = fit(points, k, rounds, seed)
    columns = "cluster int, cluster_inertia long, inertia long, centroid array<decimal(38, 0)>, centroid_sha256 string"
    assigned = staged(assign(points, centres), "assigned")
    # One row per centroid.
    inertia = {r.cluster: r.total for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    whole = sum(inertia.values())
    rows = [(c, t, whole, [Decimal(int(x)) for x in centres[c]], digest(centres[c])) for c, t in sorted(inertia.items())]
    about = points.sparkSession.createDataFrame(rows, columns)
    return assigned.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256"
    )
