"""Windows that also start earlier in the corpus: sampled anchors, classes of contexts, and exact checks of the rest.

A corpus is documents of symbols (bytes or words). Of every ``length`` consecutive symbols (a window) all but the first
occurrence, in the order of document and position, is to be found, exactly, without a row for each position:

1. Anchors. A window's anchor is the least hashed gram of ``gram`` symbols in it, the last one on a tie. Equal windows
   have their anchors at the same place, so they meet at an anchor with the same gram. About one position in
   (length - gram) / 2 is an anchor; a document names each (gram, context) once, the context being all symbols that its
   windows can reach.
2. Contexts. Anchors are dealt out and sorted by (gram, context, document, position) and read as a stream, so a gram that is
   everywhere needs no memory. All anchors with the same context but the first are *covered*: each of their windows
   occurs earlier. Grams with one context only are done. Firsts of a gram with several contexts are *edges*.
3. Edges. Only their symbols travel, to the place of their gram, where the operator's own method puts equal windows
   together. Blocks are bounded: a gram with more edges than fit is checked block by block, and the first windows of
   each block meet by hash.
4. Covered anchors and windows go back to their documents.

Documents are named by ``_at``, their id (null: before all others), and ``_tie``, 0 if ids are unique, else a hash of the text:
rows that agree in both are one document, of rows with equal ids the hash decides which is earlier. Hashes have 64 bits; the
methods of step 3 compare symbols before they call windows of one block equal; steps 2 and 3 across blocks rely on the hashes. Names of columns that begin with an underscore are taken.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlewick.llm.text import U64, all_spans, mix, pieces, prefix_hashes, ranges, sliding, span_hashes
from candlewick.session import staged

#: Symbols of a block of edges.
BLOCK = 1_500_000


@dataclass(frozen=True)
class Kind:
    """``cut`` gives the raw symbols of a piece (what edges carry) and where each row begins; ``codes`` their 64-bit codes.
    ``same`` labels windows: equal labels for equal windows of one group."""

    length: int
    gram: int
    dtype: type
    cut: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    codes: Callable[[np.ndarray], np.ndarray]
    same: Callable[[np.ndarray, np.ndarray, np.ndarray, int], np.ndarray]

    @property
    def grams(self) -> int:
        """Grams of a window."""
        return self.length - self.gram + 1


class Anchors:
    """The anchors of a piece."""

    def __init__(self, kind: Kind, codes: np.ndarray, bounds: np.ndarray) -> None:
        self.kind, self.bounds = kind, bounds
        width, n = kind.grams, len(codes)
        self.at = np.empty(0, np.int64)
        self.gram = np.empty(0, U64)
        if n >= kind.length:
            prefixes = prefix_hashes(codes)
            grams = mix(all_spans(prefixes, kind.gram))
            least = sliding(grams, width, True)
            inside = np.zeros(len(least) + 1, np.int8)  # windows that stay in one row
            fits = np.diff(bounds) >= kind.length
            inside[bounds[:-1][fits]] = 1
            inside[bounds[1:][fits] - kind.length + 1] -= 1
            least[np.cumsum(inside[:-1], dtype=np.int8) == 0] = 0
            pad = np.zeros(width - 1, U64)
            self.at = np.flatnonzero(sliding(np.concatenate([pad, least, pad]), width, False) == grams)
            self.gram = grams[self.at]
        self.row = np.searchsorted(bounds, self.at, "right") - 1
        self.low, self.high = bounds[self.row], bounds[self.row + 1]
        left = np.minimum(self.at - self.low, kind.length - kind.gram)
        right = np.minimum(self.high - self.at, kind.length)
        self.context = self.gram
        if len(self.at):
            whole = span_hashes(prefixes, self.at - left, self.at + right)
            self.context = mix(whole + left.astype(U64) * U64(0xD6E8FEB86659FD93) + right.astype(U64) * U64(0xA5CB9243F4D3C1E7))
        order = np.lexsort((self.at, self.context, self.gram, self.row))
        same = np.zeros(len(order), bool)
        if len(order):
            a, b = order[1:], order[:-1]
            same[a] = (self.row[a] == self.row[b]) & (self.gram[a] == self.gram[b]) & (self.context[a] == self.context[b])
        self.again = same  # that occur earlier in their row

    def served(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last window (inclusive) of each anchor in ``which``; none if the last is before the first."""
        width, at, gram = self.kind.grams, self.at, self.gram
        first = np.maximum(self.low[which], at[which] - width + 1)
        last = np.minimum(at[which], self.high[which] - self.kind.length)
        for step, stops in ((-1, np.less), (1, np.less_equal)):
            open_, near = np.arange(len(which)), which + step
            while len(open_):
                mine = which[open_]
                on = (near >= 0) & (near < len(at))
                on[on] = np.abs(at[near[on]] - at[mine[on]]) < width
                open_, near, mine = open_[on], near[on], mine[on]
                stop = stops(gram[near], gram[mine])
                if step < 0:
                    first[open_[stop]] = np.maximum(first[open_[stop]], at[near[stop]] + 1)
                else:
                    last[open_[stop]] = np.minimum(last[open_[stop]], at[near[stop]] - width)
                open_, near = open_[~stop], near[~stop] + step
        return first, last


def _named(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``_at`` and ``_tie``, and each document once: these and its text."""
    at = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    shared = docs.select(at.alias("_at")).groupBy("_at").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    tie = F.xxhash64(F.coalesce("text", F.lit(""))) if shared else F.lit(0).cast("long")
    named = docs.withColumns({"_at": at, "_tie": tie})
    texts = named.select("_at", "_tie", "text")
    return named, texts.dropDuplicates(["_at", "_tie"]) if shared else texts


def _anchor_rows(kind: Kind):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, tie = (batch.column(c).to_numpy() for c in ("_at", "_tie"))
            for first, _, data, starts in pieces(batch.column("text")):
                raw, bounds = kind.cut(data, starts)
                found = Anchors(kind, kind.codes(raw), bounds)
                keep = np.flatnonzero(~found.again)
                row = found.row[keep]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.gram[keep].view(np.int64)),
                        pa.array(found.context[keep].view(np.int64)),
                        pa.array(at[first + row]),
                        pa.array(tie[first + row]),
                        pa.array((found.at[keep] - found.low[keep]).astype(np.int32)),
                    ],
                    ["gram", "context", "_at", "_tie", "place"],
                )

    return work


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered anchors (edge 0) and edges (1) of a stream sorted by (gram, context, document, place)."""
    before = None  # gram and context of the last row, and the row of its gram's first context while that is the only one
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        gram, context = (batch.column(c).to_numpy() for c in ("gram", "context"))
        rows = batch.select(["_at", "_tie", "place"])
        new_gram = np.append(before is None or gram[0] != before[0], gram[1:] != gram[:-1])
        fresh = new_gram | np.append(before is None or context[0] != before[1], context[1:] != context[:-1])
        firsts = np.flatnonzero(fresh)
        edge = fresh & ~new_gram
        edge[firsts[:-1][new_gram[firsts[:-1]] & ~new_gram[firsts[1:]]]] = True
        out = [(rows.filter(pa.array(~fresh | edge)), edge[~fresh | edge])]
        if held is not None and len(firsts):
            if not new_gram[firsts[0]]:
                out.append((held, np.ones(1, bool)))
            held = None
        if len(firsts) and new_gram[firsts[-1]]:
            held = rows.slice(int(firsts[-1]), 1)
        before = gram[-1], context[-1]
        for found, edges in out:
            if found.num_rows:
                yield pa.RecordBatch.from_arrays([*found.columns, pa.array(edges)], ["_at", "_tie", "place", "edge"])


def marks(texts: DataFrame, kind: Kind) -> DataFrame:
    """_at, _tie, place and edge of all anchors that are covered or edges, as a written table."""
    anchors = texts.mapInArrow(_anchor_rows(kind), "gram long, context long, _at long, _tie long, place int")
    dealt = anchors.repartition("gram").sortWithinPartitions("gram", "context", "_at", "_tie", "place")
    return staged(dealt.mapInArrow(_marks, "_at long, _tie long, place int, edge boolean"), "marks")


def _row_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and which row each belongs to; null has none."""
    column = column.fill_null([]) if column.null_count else column
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(len(column)), sizes)


def _edge_rows(kind: Kind):
    """The windows of each edge: their symbols, end to end, and where they stand."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, tie = (batch.column(c).to_numpy() for c in ("_at", "_tie"))
            places, owners = _row_lists(batch.column("_places"))
            for first, last, data, starts in pieces(batch.column("text")):
                raw, bounds = kind.cut(data, starts)
                found = Anchors(kind, kind.codes(raw), bounds)
                own = (owners >= first) & (owners < last)
                which = np.searchsorted(found.at, np.sort(bounds[owners[own] - first] + places[own]))
                begin, end = found.served(which)
                which, begin, end = which[end >= begin], begin[end >= begin], end[end >= begin]
                size = end - begin + kind.length
                flat = raw[np.repeat(begin, size) + ranges(size)]
                offsets = np.append(0, np.cumsum(size)) * raw.itemsize
                cells = pa.Array.from_buffers(pa.binary(), len(which), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(flat)])
                row = found.row[which]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.gram[which].view(np.int64)),
                        pa.array(at[first + row]),
                        pa.array(tie[first + row]),
                        pa.array((begin - bounds[row]).astype(np.int32)),
                        pa.array((found.at[which] - begin).astype(np.int32)),
                        cells,
                    ],
                    ["gram", "_at", "_tie", "begin", "lead", "symbols"],
                )

    return work


def _held_blocks(batches: Iterator[pa.RecordBatch], kind: Kind, limit: int) -> Iterator[tuple[pa.Table, int | None]]:
    """Blocks of about ``limit`` symbols, cut between grams. A gram that fills a block by itself is cut, too, and named."""
    held, cut = None, None
    for batch in batches:
        rest = pa.Table.from_batches([batch])
        while rest.num_rows:
            rows = rest if held is None else pa.concat_tables([held, rest])
            sizes = np.cumsum(pc.binary_length(rows.column("symbols")).to_numpy()) // np.dtype(kind.dtype).itemsize
            full = max(1, int(np.searchsorted(sizes, limit, "right")))
            if full >= rows.num_rows:
                held = rows
                break
            gram = rows.column("gram").to_numpy()
            begin = int(np.searchsorted(gram, gram[full]))
            parted = cut if cut == gram[0] else None
            if begin:
                cut = None
            else:
                begin, parted = full, int(gram[0])
                cut = parted
            yield rows.slice(0, begin), parted
            held, rest = None, rows.slice(begin)
    if held is not None:
        yield held, cut if cut == held.column("gram")[0].as_py() else None


def _later_rows(kind: Kind, limit: int):
    """Windows that have an equal one earlier in their block (hash null); first ones of grams that were cut (with hash)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, parted in _held_blocks(batches, kind, limit):
            raw = np.frombuffer(b"".join(rows.column("symbols").to_pylist()), kind.dtype)
            sizes = pc.binary_length(rows.column("symbols")).to_numpy().astype(np.int64) // np.dtype(kind.dtype).itemsize
            gram, at, tie = (rows.column(c).to_numpy() for c in ("gram", "_at", "_tie"))
            begin, lead = (rows.column(c).to_numpy().astype(np.int64) for c in ("begin", "lead"))
            count = sizes - kind.length + 1
            owner, step = np.repeat(np.arange(len(gram)), count), ranges(count)
            start = (np.cumsum(sizes) - sizes)[owner] + step
            place = begin[owner] + step
            _, group = np.unique(gram, return_inverse=True)
            _, group = np.unique(group[owner] * (kind.length + 1) + lead[owner] - step, return_inverse=True)
            label = kind.same(raw, start, group, kind.length)
            order = np.lexsort((place, tie[owner], at[owner], label))
            later = np.zeros(len(order), bool)
            later[order[1:]] = label[order[1:]] == label[order[:-1]]
            if parted is not None:
                asked = np.flatnonzero(~later & (gram[owner] == parted))
                hashes = mix(span_hashes(prefix_hashes(kind.codes(raw)), start[asked], start[asked] + kind.length) + gram[owner[asked]].view(U64))
                yield _window_rows(at, tie, owner[asked], place[asked], place[asked], pa.array(hashes.view(np.int64)))
            found = np.flatnonzero(later)
            if not len(found):
                continue
            joined = np.zeros(len(found), bool)  # to the window before
            joined[1:] = (owner[found[1:]] == owner[found[:-1]]) & (place[found[1:]] == place[found[:-1]] + 1)
            heads = np.flatnonzero(~joined)
            tails = np.append(heads[1:], len(found)) - 1
            yield _window_rows(at, tie, owner[found[heads]], place[found[heads]], place[found[tails]], pa.nulls(len(heads), pa.int64()))

    return work


def _window_rows(at, tie, owner, first, last, hashes) -> pa.RecordBatch:
    columns = [pa.array(at[owner]), pa.array(tie[owner]), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), hashes]
    return pa.RecordBatch.from_arrays(columns, ["_at", "_tie", "first", "last", "hash"])


def _later_windows(texts: DataFrame, marked: DataFrame, kind: Kind, limit: int) -> DataFrame:
    """_at, _tie, first and last of runs of windows of edges that occur earlier."""
    edges = marked.where("edge").groupBy("_at", "_tie").agg(F.collect_list("place").alias("_places"))
    asked = texts.join(edges, ["_at", "_tie"]).select("_at", "_tie", "text", "_places")
    rows = asked.mapInArrow(_edge_rows(kind), "gram long, _at long, _tie long, begin int, lead int, symbols binary")
    dealt = rows.repartition("gram").sortWithinPartitions("gram", "_at", "_tie", "begin")
    found = staged(dealt.mapInArrow(_later_rows(kind, limit), "_at long, _tie long, first int, last int, hash long"), "windows")
    parted = found.where("hash is not null")
    if not parted.limit(1).count():
        return found.drop("hash")
    firsts = parted.groupBy("hash").agg(F.min(F.struct("_at", "_tie", "first")).alias("least"))
    again = parted.join(firsts, "hash").where("struct(_at, _tie, first) != least").select("_at", "_tie", "first", "last")
    return found.where("hash is null").drop("hash").unionByName(again)


def _applied(kind: Kind, names: list[str], finish):
    """Hands the covered symbols of each piece to ``finish`` and adds the columns it returns."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, place_rows = _row_lists(batch.column("_places"))
            firsts, window_rows = _row_lists(batch.column("_firsts"))
            lasts, _ = _row_lists(batch.column("_lasts"))
            kept = batch.select([i for i, n in enumerate(batch.schema.names) if n not in ("_places", "_firsts", "_lasts", "__text")])
            for first, last, data, starts in pieces(batch.column("__text")):
                raw, bounds = kind.cut(data, starts)
                found = Anchors(kind, kind.codes(raw), bounds)
                own = (place_rows >= first) & (place_rows < last)
                which = np.searchsorted(found.at, np.sort(bounds[place_rows[own] - first] + places[own]))
                begin, end = found.served(np.union1d(which, np.flatnonzero(found.again)))
                mine = (window_rows >= first) & (window_rows < last)
                base = bounds[window_rows[mine] - first]
                begin, end = np.append(begin, base + firsts[mine]), np.append(end, base + lasts[mine])
                begin, end = begin[end >= begin], end[end >= begin] + kind.length
                depth = np.bincount(begin, minlength=len(raw) + 1) - np.bincount(end, minlength=len(raw) + 1)
                gone = np.cumsum(depth[:-1]) > 0
                columns = finish(data, starts, bounds, gone)
                yield pa.RecordBatch.from_arrays([*kept.slice(first, last - first).columns, *columns], names)

    return work


def without_repeats(docs: DataFrame, kind: Kind, schema: str, finish) -> DataFrame:
    """``docs`` (text kept as it was) with the columns of ``schema`` that ``finish`` makes of each piece's repeated symbols."""
    named, texts = _named(docs)
    marked = marks(texts, kind)
    later = _later_windows(texts, marked, kind, BLOCK)
    covered = marked.where("not edge").groupBy("_at", "_tie").agg(F.collect_list("place").alias("_places"))
    pairs = F.collect_list(F.struct("first", "last"))
    windows = later.groupBy("_at", "_tie").agg(pairs.alias("runs")).select("_at", "_tie", F.col("runs.first").alias("_firsts"), F.col("runs.last").alias("_lasts"))
    rows = named.join(covered, ["_at", "_tie"], "left").join(windows, ["_at", "_tie"], "left")
    names = [c for c in docs.columns if c != "text"]
    rows = rows.select(*names, "_places", "_firsts", "_lasts", F.col("text").alias("__text"))
    added = StructType.fromDDL(schema)
    return rows.mapInArrow(_applied(kind, [*names, *added.names], finish), StructType([*docs.select(*names).schema.fields, *added.fields]))
