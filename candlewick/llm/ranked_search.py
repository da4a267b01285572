"""Ranked lexical search with per-term geometric blocking.

``rank`` scores all documents for each item by the terms they share (see ``weigh`` and ``strengths``) and returns the items' k best.

* Statistics first: every document is cut into terms once, and what it holds of the items' terms is written as its vector, with its number of
  terms. No term of another kind can change a score. N, L and df are sums over these rows.
* A segment is some consecutive documents of a task, indexed in memory: each term has a posting list, and each list is cut into blocks
  of documents that are alike (nearest of some centres among the list, by random projections of the vectors). A block's summary is
  the coordinatewise maximum of its vectors, over the terms that occur in an item together with the list's term.
* For an item, lists are taken from the strongest term to the weakest. A document that holds an earlier term has been judged in
  that list, so a block's bound counts the terms from this list on: item weights times summary. A block is skipped only if that bound is
  below the k-th best score so far, which no document of it can then reach; the others' documents are scored in full. Once the maxima of the terms left
  add up to less than the k-th best, their lists are skipped whole, and blocks are made only for lists that an item looks at.
* The k best of an item carry on from segment to segment of a task; a task hands over its k best of each item, Spark those of all tasks.

Blocks and bounds only save work: the result is that of scoring every document. All scores are whole numbers of 64 bits, exact while a
document's terms times the documents stay below 10^17.

Items come in turns of about ``TURN_BYTES`` of text, whose terms and ids are sent to the tasks; documents are read once a turn. One
item of any length is one turn.

A null text has no terms; an item without terms, or with terms that no document has, gets no rows. A null item id is an id; rows with one item id,
or the same item twice, are items of their own, each with its ranks. Rows with one doc_id are documents of their own; equal scores come in the order
of doc_id, nulls last. Very long texts are cut into terms in parts. Empty tables give no rows. Other columns are dropped, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.session import staged

K = 10
#: Text of the items of one turn, in bytes.
TURN_BYTES = 4 << 20
#: Postings of a segment, documents of a block, numbers of a projection.
SEGMENT, BLOCK, SKETCH = 1 << 20, 48, 16
#: Lists up to this long are one block.
SHORT = 64
#: Blocks scored before the bounds are looked at again.
FIRST_BLOCKS = 4
#: Bytes of text cut into terms at a time.
PART = 1 << 20

# Fixed value: [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F] are the bytes of terms, A-Z in lower case; all others are white space here.
_TERMS = bytes((b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SPACE = re.compile(b" ")


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, a list for each part of it."""
    data, first = (text or "").encode().translate(_TERMS), 0
    while found := _SPACE.search(data, first + PART):
        yield data[first : found.start()].split()
        first = found.start()
    yield data[first:].split()


def weigh(df: int, documents: int) -> int:
    """Weight of a term that ``df`` of so many documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def strengths(tf: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What one occurrence count in a document of ``n`` terms is worth, before the term's weight."""
    m = 10 + (90 * n * documents) // max(total, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def vectors(docs: DataFrame, places: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms, with repeats), and of the terms with a place: the places held, ascending, and how often."""
    schema = T.StructType().add("doc_id", docs.schema["doc_id"].dataType).add("n", T.LongType())
    schema = schema.add("held", T.ArrayType(T.IntegerType())).add("tf", T.ArrayType(T.LongType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, held, tf, ends = [], [], [], [0]
            for text in batch.column(1):
                counts: Counter = Counter()
                for part in terms(text.as_py()):
                    counts.update(part)
                found = sorted((places[t], c) for t, c in counts.items() if t in places)
                n.append(counts.total())
                held += [p for p, _ in found]
                tf += [c for _, c in found]
                ends.append(len(held))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(v, t)) for v, t in ((held, pa.int32()), (tf, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists], schema.names)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(cut, schema)


class Segment:
    """Some documents as vectors (row by row) and as posting lists of blocks with summaries (made when first looked at)."""

    def __init__(self, ends: np.ndarray, held: np.ndarray, strength: np.ndarray, weight: np.ndarray, together: Callable[[int], np.ndarray]):
        self.ends, self.held, self.strength, self._together = ends, held, strength, together
        size = np.diff(ends)
        order = np.argsort(held, kind="stable")
        self._rows = np.repeat(np.arange(len(size)), size)[order]
        self._lists = np.searchsorted(held[order], np.arange(len(weight) + 1))
        self.most = np.zeros(len(weight), np.int64)
        np.maximum.at(self.most, held, strength)
        signs = np.random.default_rng(0).choice(np.array([-1, 1], np.float32), (len(weight), SKETCH))
        sums = np.zeros((len(held) + 1, SKETCH), np.float32)
        np.cumsum(signs[held] * (weight[held] * strength).astype(np.float32)[:, None] / 1e12, 0, out=sums[1:])
        self._sketch = sums[ends[1:]] - sums[ends[:-1]]
        self._blocks: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``rows`` each of their coordinates belongs to, and where it stands."""
        size = self.ends[rows + 1] - self.ends[rows]
        whose = np.repeat(np.arange(len(rows)), size)
        return whose, np.arange(len(whose)) + np.repeat(self.ends[rows] - np.cumsum(size) + size, size)

    def list_of(self, term: int) -> np.ndarray:
        return self._rows[self._lists[term] : self._lists[term + 1]]

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The rows of the term's list by block, where blocks start (and the last ends), summaries by block, and each term's column in them."""
        if term not in self._blocks:
            rows = self.list_of(term)
            if len(rows) > SHORT:
                centres = self._sketch[rows[:: BLOCK]]
                # Least Euclidean distance, but for the row's own square.
                near = (self._sketch[rows] @ centres.T - (centres * centres).sum(1) / 2).argmax(1)
            else:
                near = np.zeros(len(rows), np.int64)
            order = np.argsort(near, kind="stable")
            rows, near = rows[order], near[order]
            starts = np.flatnonzero(np.diff(near, prepend=-1))
            block = np.cumsum(np.diff(near, prepend=-1) != 0) - 1
            columns = self._together(term)
            place = np.full(len(self.most), -1, np.int32)
            place[columns] = np.arange(len(columns))
            whose, at = self.entries(rows)
            column = place[self.held[at]]
            kept = column >= 0
            summary = np.zeros(len(starts) * len(columns), np.int64)
            np.maximum.at(summary, block[whose[kept]] * len(columns) + column[kept], self.strength[at[kept]])
            self._blocks[term] = rows, np.append(starts, len(rows)), summary.reshape(len(starts), len(columns)), place
        return self._blocks[term]

    def scores(self, rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        whose, at = self.entries(rows)
        out = np.zeros(len(rows), np.int64)
        np.add.at(out, whose, weight[self.held[at]] * self.strength[at])
        return out


class Best:
    """The k best of one item so far: scores, and the ids as ranked."""

    def __init__(self, k: int):
        self.k, self.score, self.id = k, np.empty(0, np.int64), np.empty(0, object)

    @property
    def least(self) -> int:
        """A document below this score is not among the k best."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        fits = score >= self.least
        score, ids = np.append(self.score, score[fits]), np.append(self.id, ids[fits])
        order = sorted(range(len(score)), key=lambda i: (-score[i], ids[i] is None, ids[i]))[: self.k]
        self.score, self.id = score[order], ids[order]


def search(segment: Segment, ids: np.ndarray, item: np.ndarray, weight: np.ndarray, best: Best) -> int:
    """Bring ``best`` up to date with the segment's documents for an item's terms; returns how many were scored."""
    most = weight[item] * segment.most[item]
    order = np.argsort(-most, kind="stable")
    item, most = item[order], most[order]
    item = item[most > 0]
    rest = np.cumsum(most[::-1])[::-1]
    own = np.zeros(len(weight), np.int64)
    own[item] = weight[item]
    seen, scored = np.zeros(len(segment.ends) - 1, bool), 0

    def score(rows: np.ndarray) -> int:
        rows = np.unique(rows)
        rows = rows[~seen[rows]]
        seen[rows] = True
        best.add(segment.scores(rows, own), ids[rows])
        return len(rows)

    for turn, term in enumerate(item):
        if rest[turn] < best.least:
            break
        rows, starts, summary, place = segment.blocks(term)
        left = item[turn:]
        bound = summary[:, place[left]] @ weight[left]
        by_bound = np.argsort(-bound, kind="stable")
        for some in (by_bound[:FIRST_BLOCKS], by_bound[FIRST_BLOCKS:]):
            some = some[bound[some] >= best.least]
            if len(some):
                scored += score(np.concatenate([rows[starts[b] : starts[b + 1]] for b in some]))
    return scored


def _search_task(items: list[np.ndarray], weight: np.ndarray, documents: int, total: int, k: int):
    """Per task: index the vectors segment by segment, search each for all items, and hand over the k best of each."""
    holders: dict[int, list[int]] = {}
    for i, item in enumerate(items):
        for term in item:
            holders.setdefault(int(term), []).append(i)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together = cache(lambda term: np.unique(np.concatenate([items[i] for i in holders[term]])))
        best = [Best(k) for _ in items]
        key = None
        for batch in batches:
            key = batch.schema.field(0).type
            n = batch.column(1).to_numpy()
            lists = batch.column(2)
            held, tf = lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy()
            ends = np.append(0, np.cumsum(lists.value_lengths().to_numpy())).astype(np.int64)
            strength = strengths(tf, np.repeat(n, np.diff(ends)), documents, total)
            ids = np.empty(len(n), object)
            ids[:] = batch.column(0).to_pylist()
            first = 0
            while first < len(n):
                last = max(int(np.searchsorted(ends, ends[first] + SEGMENT, "right")) - 1, first + 1)
                part = slice(ends[first], ends[last])
                segment = Segment(ends[first : last + 1] - ends[first], held[part], strength[part], weight, together)
                for item, found in zip(items, best, strict=True):
                    search(segment, ids[first:last], item, weight, found)
                first = last
        if key is not None:
            place = np.repeat(np.arange(len(items)), [len(b.score) for b in best])
            score = np.concatenate([np.empty(0, np.int64), *(b.score for b in best)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(place, pa.int32()), pa.array([i for b in best for i in b.id], key), pa.array(score)], ["place", "doc_id", "score"]
            )

    return run


def _turns(items: DataFrame) -> Iterator[list]:
    """The items in lists of about ``TURN_BYTES`` of text; the driver holds one of them, and one partition of the table."""
    turn, held = [], 0
    for row in items.select("item_id", F.col("text").cast("string")).toLocalIterator():
        turn.append(row)
        held += 16 + len((row.text or "").encode())
        if held >= TURN_BYTES:
            yield turn
            turn, held = [], 0
    if turn:
        yield turn


def rank(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` documents (doc_id, text) of the highest score above 0 for each item (item_id, text)."""
    spark = docs.sparkSession
    key, item_key = docs.schema["doc_id"].dataType, items.schema["item_id"].dataType
    schema = T.StructType().add("item_id", item_key).add("rank", T.IntegerType()).add("doc_id", key).add("score", T.LongType())
    result = spark.createDataFrame([], schema)
    for turn in _turns(items):
        words = [set().union(*terms(row.text)) for row in turn]
        places = {t: p for p, t in enumerate(sorted(set().union(*words)))}
        rows = staged(vectors(docs, places), "vectors")
        documents, total = rows.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        # One row per term of the turn.
        df = {r.p: r.df for r in rows.select(F.explode("held").alias("p")).groupBy("p").agg(F.count("*").alias("df")).collect()}
        weight = np.array([weigh(df.get(p, 0), documents) for p in range(len(places))], np.int64)
        asked = [np.array(sorted(places[t] for t in w), np.int64) for w in words]
        run = _search_task(asked, weight, documents, total, k)
        found = rows.where("size(held) > 0").mapInArrow(run, T.StructType().add("place", T.IntegerType()).add("doc_id", key).add("score", T.LongType()))
        order = Window.partitionBy("place").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(p, row.item_id) for p, row in enumerate(turn)], T.StructType().add("place", T.IntegerType()).add("item_id", item_key))
        result = result.unionByName(staged(ranked.join(F.broadcast(names), "place").select(*schema.names), "ranked"))
    return result
