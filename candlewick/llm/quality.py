"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader updates.

A token is a run of letters and digits or a run of other printing characters. Features are tokens, pairs of
neighbours, and runs of up to three token shapes (upper, capital, lower, number, the marks themselves, and whether the
token repeats the one before), hashed into ``BUCKETS``. A feature's value is its count, scaled so that the squares of a
text's values add up to 1; a bias of 1 is added. A score is the logistic function of the sparse dot product.

Training: labelled texts (at most about ``SAMPLE`` of them, chosen by a hash of the id, so the same ones each time) go
to ``WORKERS`` groups by hash. Each group runs FTRL-Proximal over its texts; the groups' states are averaged, and the
next round starts from the average. Scoring reads every whole text where it lies, with the weights broadcast: ``BUCKETS``
numbers, whatever the size of the corpus.

Nulls: a null text is empty and scored by the bias; a null label, or a label without a document, is not learnt from; of
several labels of one id the least counts. Without any label every score is 0.5. Repeated ids and texts are all scored.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from candlewick.llm.text import BYTE_CODES, INK, U64, WORD, mix, pieces, prefix_hashes, span_hashes
from candlewick.session import staged

BUCKETS = 1 << 18
SAMPLE, WORKERS, ROUNDS = 12_000, 6, 3
#: Of FTRL-Proximal: step, its smoothing, L1 and L2.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.01, 0.05
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True


def _tokens(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of runs of one kind: letters and digits, or other printing characters."""
    kind = np.where(WORD[data], 2, INK[data]).astype(np.int8)
    fresh = np.empty(len(data), bool)
    if len(data):
        fresh[0] = True
        fresh[1:] = kind[1:] != kind[:-1]
        cut = starts[1:-1]
        fresh[cut[cut < len(data)]] = True
    begin = np.flatnonzero(fresh)
    end = np.append(begin[1:], len(data))
    inked = kind[begin] > 0 if len(begin) else np.empty(0, bool)
    return begin[inked], end[inked]


def _features(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and value of each feature, sorted by row and bucket."""
    begin, end = _tokens(data, starts)
    rows = np.searchsorted(starts, begin, "right") - 1
    codes = mix(span_hashes(prefix_hashes(BYTE_CODES[data]), begin, end) + (end - begin).astype(U64))
    upper = np.concatenate([[0], np.cumsum(_UPPER[data], dtype=np.int64)])
    digit = np.concatenate([[0], np.cumsum(_DIGIT[data], dtype=np.int64)])
    size, ups, digits = end - begin, upper[end] - upper[begin], digit[end] - digit[begin]
    word = WORD[data[begin]] if len(begin) else np.empty(0, bool)
    shape = np.select([~word, digits == size, (ups == size) & (size > 1), ups > 0], [codes, U64(2), U64(3), U64(4)], U64(5)).astype(U64)
    near = np.zeros(len(begin), bool)  # whether the token before is in the same row
    near[1:] = rows[1:] == rows[:-1]
    far = near.copy()
    far[1:] &= near[:-1]
    before = np.concatenate([codes[:1], codes[:-1]])
    shape = mix(shape * U64(2) + (near & (codes == before)).astype(U64))
    shape1 = np.concatenate([shape[:1], shape[:-1]])
    shape2 = np.concatenate([shape[:2], shape[:-2]])[: len(shape)]
    pair, shapes = mix(before * U64(3) + codes), mix(shape1 * U64(5) + shape * U64(7))
    triple = mix(shape2 * U64(11) + shapes)
    found = np.concatenate([codes, pair[near], shape, shapes[near], triple[far]])
    where = np.concatenate([rows, rows[near], rows, rows[near], rows[far]])
    key = where.astype(np.int64) * BUCKETS + (found >> U64(20)).astype(np.int64) % BUCKETS
    key.sort()
    fresh = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    counts = np.diff(np.append(fresh, len(key))).astype(np.float64)
    row, bucket = key[fresh] // BUCKETS, key[fresh] % BUCKETS
    norm = np.sqrt(np.bincount(row, counts * counts, len(starts) - 1))
    return row, bucket, counts / norm[row]


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, starts in pieces(batch.column("text")):
            row, bucket, value = _features(data, starts)
            cuts = np.searchsorted(row, np.arange(last - first + 1))
            cells = [
                (bucket[a:b].astype(np.int32).tobytes(), value[a:b].astype(np.float32).tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)
            ]
            part = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays(
                [part.column("turn"), part.column("label"), pa.array([c[0] for c in cells], pa.binary()), pa.array([c[1] for c in cells], pa.binary())],
                ["turn", "label", "buckets", "vals"],
            )


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _learn(z: np.ndarray, n: np.ndarray, examples: Iterator[tuple[np.ndarray, np.ndarray, float]]) -> None:
    """FTRL-Proximal, one example after the other; the last place of ``z`` and ``n`` is the bias."""
    for at, x, y in examples:
        zi, ni = z[at], n[at]
        w = weights_of(zi, ni)
        gradient = x * (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y)
        more = ni + gradient * gradient
        z[at] = zi + gradient - (np.sqrt(more) - np.sqrt(ni)) / ALPHA * w
        n[at] = more


def _learner(state):
    """Learns the examples of one group, in the order of their hash, from ``state`` on."""

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        z, n = (x.copy() for x in state.value)
        rows = rows.sort_values(["turn", "label"])
        _learn(
            z,
            n,
            (
                (np.append(np.frombuffer(b, np.int32), BUCKETS), np.append(np.frombuffer(v, np.float32), 1.0).astype(float), float(y))
                for b, v, y in zip(rows.buckets, rows.vals, rows.label, strict=True)
            ),
        )
        return pd.DataFrame({"z": [z.tobytes()], "n": [n.tobytes()], "size": [len(rows)]})

    return learn


_STATE = "z binary, n binary, size long"


def _averaged(rows: pd.DataFrame) -> pd.DataFrame:
    """The states of all groups put together, each by its share of the examples."""
    rows = rows.sort_values(["size", "z"])
    mean = {c: sum(size / rows["size"].sum() * np.frombuffer(state) for size, state in zip(rows["size"], rows[c], strict=True)) for c in ("z", "n")}
    return pd.DataFrame({"z": [mean["z"].tobytes()], "n": [mean["n"].tobytes()], "size": [rows["size"].sum()]})


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights of the buckets and the bias, from ``labels`` (doc_id, quality) that aren't held out."""
    known = (
        labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("label"))
    )
    turn = F.xxhash64("doc_id", F.lit("turn"))
    found = known.count()
    if found > sample:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(found)) < sample)
    labelled = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "label", turn.alias("turn"))
    examples = staged(labelled.mapInArrow(_feature_rows, "turn long, label int, buckets binary, vals binary"), "quality")
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    groups = examples.groupBy(F.pmod("turn", F.lit(WORKERS)).alias("worker"))
    for _ in range(ROUNDS):
        state = docs.sparkSession.sparkContext.broadcast((z, n))
        # ``WORKERS`` rows are averaged in one task; the driver gets one.
        learnt = groups.applyInPandas(_learner(state), _STATE).groupBy().applyInPandas(_averaged, _STATE).first()
        state.destroy()
        if learnt is None:
            break
        z, n = np.frombuffer(learnt["z"]), np.frombuffer(learnt["n"])
    return weights_of(z, n)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` with ``score``, the probability of label 1; a column of that name is replaced."""
    docs = docs.drop("score")
    model = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for first, last, data, starts in pieces(batch.column("text")):
                row, bucket, value = _features(data, starts)
                scores[first:last] = np.bincount(row, value * w[bucket], last - first) + w[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-scores)))], [*batch.schema.names, "score"])

    return docs.mapInArrow(work, StructType([*docs.schema.fields, StructField("score", DoubleType())]))
