"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the postings of every word of the corpus as a Parquet table. Documents lie in segments of about
``SEGMENT_WORDS`` words; a row holds one term of one segment, how often it occurs and its positions. Terms are 64-bit hashes
of words; positions count words through the segment, with a gap after each document, so that no phrase runs on into the
next one. A segment bounds what a task holds: no list of a term is ever put together across the corpus.

``search`` looks up windows of test words. It adds up how often each test term occurs, deals the postings of test terms
out by segment, and in each segment starts from the list of a window's rarest term, shifts it to where the window would
begin, and intersects it with the lists of the next rarest terms, each shifted by its offset. What is left are exact phrases. The
proximity match starts from the same list and asks for every other term within ``reach`` words in the same document.

Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z. A window is ``width`` consecutive words of an
item; an item of fewer words, but not none, is one window. A null text has no words. Repeated ids and texts are separate
documents; items that share a window are all reported; an item without id marks words but isn't listed. Without
documents the result is empty, without test words nothing is hit. Other columns are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.text import LOWER, WORD, pieces, ranges, word_hashes, words
from candlewick.session import new_dir

WIDTH, REACH = 10, 15
SEGMENT_WORDS = 1_500_000
#: Test words looked up at a time; more are looked up in several turns.
TURN_WORDS = 1_000_000
_LOW = (1 << 32) - 1
_INDEX = "kind int, segment long, term long, n int, positions binary, place int, doc_id long, n_words long, begin int"


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    segment = TaskContext.get().partitionId() << 32
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for first, last, data, starts in pieces(batch.column("text")):
            begin, end, before = words(data, starts, WORD)
            held.append((word_hashes(LOWER[data], begin, end), np.diff(before), batch.column("doc_id").slice(first, last - first)))
            size += len(begin)
            if size >= SEGMENT_WORDS:
                yield from _segment(segment, held)
                segment, held, size = segment + 1, [], 0
    if held:
        yield from _segment(segment, held)


def _segment(segment: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
    terms = np.concatenate([h[0] for h in held]).view(np.int64)
    counts = np.concatenate([h[1] for h in held])
    ids = pa.concat_arrays([h[2] for h in held])
    begins = np.cumsum(counts) - counts + np.arange(len(counts))
    places = np.arange(len(terms)) + np.repeat(np.arange(len(counts)), counts)
    order = np.argsort(terms, kind="stable")
    terms, places = terms[order], places[order].astype(np.int32)
    cuts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.empty(0, np.int64)
    steps = np.diff(places, prepend=np.int32(0))
    steps[cuts] = places[cuts]  # each list begins with its first position, steps follow
    ends = np.append(cuts, len(terms)).astype(np.int32)
    lists = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(ends * np.int32(4)), pa.py_buffer(steps)])
    yield _rows(len(cuts), kind=np.zeros(len(cuts), np.int32), segment=segment, term=terms[cuts], n=np.diff(ends), positions=lists)
    yield _rows(
        len(counts),
        kind=np.ones(len(counts), np.int32),
        segment=segment,
        place=np.arange(len(counts), dtype=np.int32),
        doc_id=ids,
        n_words=counts,
        begin=begins.astype(np.int32),
    )


def _rows(size: int, segment: int, **columns) -> pa.RecordBatch:
    types = {"kind": pa.int32(), "segment": pa.int64(), "term": pa.int64(), "n": pa.int32(), "positions": pa.binary()}
    types |= {"place": pa.int32(), "doc_id": pa.int64(), "n_words": pa.int64(), "begin": pa.int32()}
    columns["segment"] = np.full(size, segment)
    arrays = [pa.array(columns[c], t) if c in columns else pa.nulls(size, t) for c, t in types.items()]
    return pa.RecordBatch.from_arrays(arrays, list(types))


def build_index(docs: DataFrame, folder: str) -> DataFrame:
    """Write the index of ``docs`` (doc_id, text) below ``folder`` and return it: postings (kind 0) and documents (kind 1)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_index_rows, _INDEX)
    rows.write.option("compression", "zstd").partitionBy("kind").parquet(folder)
    return docs.sparkSession.read.schema(_INDEX).parquet(folder)


@dataclass
class Windows:
    """Distinct windows of test words: numbers of their terms, and the items each is part of."""

    terms: np.ndarray  # sorted hashes
    codes: np.ndarray  # a row for each window, its words' numbers in ``terms``, -1 after the last
    sizes: np.ndarray
    items: list[list[str]]
    order: np.ndarray | None = None  # offsets of a window's words, the rarest first

    def rank(self, often: dict[int, int]) -> None:
        counts = np.append(np.array([often.get(int(t), 0) for t in self.terms], np.int64), np.iinfo(np.int64).max)
        self.order = np.argsort(counts[self.codes], axis=1, kind="stable")


def windows_of(items: list[tuple], width: int) -> Windows:
    texts = pa.array([t for _, t in items], pa.string())
    hashes, owners = [], []
    for first, _, data, starts in pieces(texts):
        begin, end, before = words(data, starts, WORD)
        hashes.append(word_hashes(LOWER[data], begin, end).view(np.int64))
        owners.append(np.repeat(np.arange(first, first + len(starts) - 1), np.diff(before)))
    flat = np.concatenate(hashes) if hashes else np.empty(0, np.int64)
    owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
    terms, codes = np.unique(flat, return_inverse=True)
    found: dict[tuple, set[str]] = defaultdict(set)
    cuts = np.searchsorted(owner, np.arange(len(items) + 1)).tolist()
    for (item, _), a, b in zip(items, cuts[:-1], cuts[1:], strict=True):
        own = codes[a:b].tolist()
        for i in range(max(1, len(own) - width + 1) if own else 0):
            found[tuple(own[i : i + width])] |= {str(item)} if item is not None else set()
    table = np.full((len(found), width), -1, np.int64)
    for row, window in zip(table, found, strict=True):
        row[: len(window)] = window
    return Windows(terms, table, np.fromiter(map(len, found), np.int64, len(found)), [sorted(x) for x in found.values()])


class _Lists:
    """The postings of one segment: numbers of terms and positions, as sorted keys."""

    def __init__(self, terms: np.ndarray, postings: pa.Table) -> None:
        code = np.searchsorted(terms, postings.column("term").to_numpy())
        cells = postings.column("positions").to_pylist()
        n = np.fromiter((len(c) // 4 for c in cells), np.int64, len(cells))
        steps = np.frombuffer(b"".join(cells), np.int32).astype(np.int64)
        total = np.append(0, np.cumsum(steps))
        starts = np.cumsum(n) - n
        keys = (np.repeat(code, n) << 32) + total[1:] - np.repeat(total[starts], n)
        keys.sort()
        self.keys, self.begin = keys, np.searchsorted(keys, np.arange(len(terms) + 1) << 32)

    def all_of(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of each term of ``code``, and which it is of."""
        n = self.begin[code + 1] - self.begin[code]
        which = np.repeat(np.arange(len(code)), n)
        return self.keys[self.begin[code][which] + ranges(n)] & _LOW, which

    def after(self, code: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The first key from ``place`` on, of any term."""
        at = np.searchsorted(self.keys, (code << 32) + place)
        return np.append(self.keys, np.iinfo(np.int64).max)[at]


def _matches(w: Windows, lists: _Lists, begins: np.ndarray, ends: np.ndarray, reach: int) -> tuple[np.ndarray, ...]:
    """(window, begin) of exact phrases, (window, document) of proximity matches."""
    rows = np.arange(len(w.sizes))
    rare = w.order[:, 0]
    place, which = lists.all_of(w.codes[rows, rare])
    base, keep = place - rare[which], place >= rare[which]
    phrase, at = which[keep], base[keep]
    for step in range(1, w.codes.shape[1]):
        offset = w.order[phrase, step]
        code, on = w.codes[phrase, offset], w.sizes[phrase] > step
        good = ~on
        good[on] = lists.after(code[on], (at + offset)[on]) == (code[on] << 32) + (at + offset)[on]
        phrase, at = phrase[good], at[good]
    doc = np.searchsorted(begins, place, "right") - 1
    low, high = np.maximum(place - reach, begins[doc]), np.minimum(place + reach, ends[doc])
    for step in range(1, w.codes.shape[1]):
        code, on = w.codes[which, w.order[which, step]], w.sizes[which] > step
        good = ~on
        good[on] = lists.after(code[on], low[on]) <= (code[on] << 32) + high[on]
        which, doc, low, high = which[good], doc[good], low[good], high[good]
    return phrase, at, which, doc



_FOUND = "segment long, place int, doc_id long, n_words long, hits array<int>, items array<string>, near_items array<string>"


def _searcher(shared, reach: int):
    def find(rows: pa.Table) -> pa.Table:
        w: Windows = shared.value
        kind = rows.column("kind").to_numpy()
        docs = rows.filter(pa.array(kind == 1)).sort_by("place")
        begins, n = docs.column("begin").to_numpy().astype(np.int64), docs.column("n_words").to_numpy()
        lists = _Lists(w.terms, rows.filter(pa.array(kind == 0)))
        hits: dict[int, set[int]] = defaultdict(set)
        items: dict[int, set[str]] = defaultdict(set)
        near: dict[int, set[str]] = defaultdict(set)
        if len(w.sizes):
            phrase, at, close, where = _matches(w, lists, begins, begins + n - 1, reach)
            for p, a, doc in zip(phrase.tolist(), at.tolist(), (np.searchsorted(begins, at, "right") - 1).tolist(), strict=True):
                a -= int(begins[doc])
                hits[doc].update(range(a, a + int(w.sizes[p])))
                items[doc].update(w.items[p])
            for p, doc in set(zip(close.tolist(), where.tolist(), strict=True)):
                near[doc].update(w.items[p])
        places = docs.column("place").to_pylist()
        lists_of = lambda found: [sorted(found.get(p, ())) for p in places]
        return pa.table(
            [
                docs.column("segment"),
                docs.column("place"),
                docs.column("doc_id"),
                docs.column("n_words"),
                pa.array(lists_of(hits), pa.list_(pa.int32())),
                pa.array(lists_of(items), pa.list_(pa.string())),
                pa.array(lists_of(near), pa.list_(pa.string())),
            ],
            names=["segment", "place", "doc_id", "n_words", "hits", "items", "near_items"],
        )

    return find


def _look_up(index: DataFrame, windows: Windows, reach: int) -> DataFrame:
    spark = index.sparkSession
    terms = F.broadcast(spark.createDataFrame([(int(t),) for t in windows.terms], "term long"))
    postings = index.where("kind = 0").join(terms, "term")
    windows.rank({r["term"]: r["n"] for r in postings.groupBy("term").agg(F.sum("n").alias("n")).collect()})
    rows = postings.select("kind", "segment", "term", "positions", "place", "doc_id", "n_words", "begin").unionByName(
        index.where("kind = 1").drop("n")
    )
    return rows.groupBy("segment").applyInArrow(_searcher(spark.sparkContext.broadcast(windows), reach), _FOUND)


def search(index: DataFrame, items: DataFrame, width: int = WIDTH, reach: int = REACH) -> DataFrame:
    """Each document of ``index``: doc_id, n_words, the numbers of its words inside exact windows of ``items`` (item_id, text), the
    items of these and of the proximity matches. More than ``TURN_WORDS`` test words are looked up in several turns."""
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    turns = max(1, -(-size // (6 * TURN_WORDS)))
    found = None
    for turn in range(turns):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(turns)) == turn).select("item_id", "text").collect()
        one = _look_up(index, windows_of([tuple(r) for r in part], width), reach)
        found = one if found is None else found.unionByName(one)
    if turns > 1:
        together = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
        found = found.groupBy("segment", "place", "doc_id", "n_words").agg(together("hits"), together("items"), together("near_items"))
    return found


def contamination(docs: DataFrame, items: DataFrame, folder: str | None = None, width: int = WIDTH, reach: int = REACH) -> DataFrame:
    """``search`` over a new index of ``docs``, below ``folder`` or in the session's shared folder."""
    return search(build_index(docs, folder or new_dir(docs.sparkSession, "postings")), items, width, reach)
