"""Substring removal by a hash-compared suffix sort, on the UTF-8 bytes of whole texts.

Each byte covered by a string of ``LENGTH`` bytes that also starts earlier (in a document before, or before in the same
document) is removed; strings are judged on the input, overlaps count, and strings never cross documents.

``repeats`` finds the places where suffixes have to be compared. There suffixes are sorted by a bottom-up mergesort whose
comparisons are logarithmic: prefix polynomial hashes give the hash of any span, a binary search over span lengths
finds the common extension of two suffixes, and the byte after it decides. A merge step places each suffix of a run by
binary search in its sibling run, all of them at once. Neighbours with a common extension of ``LENGTH`` bytes are
compared byte by byte before they count as equal. This holds within a block of ``repeats``: covered anchors, and windows that meet
across blocks, are equal by 64-bit hashes, and a collision there could remove text.

A null text is empty; texts shorter than ``LENGTH`` lose nothing. Rows that agree in id and text are one document and get the
same result; of rows with equal ids and different texts a hash decides which is earlier; a null id comes before all others.
An empty table gives an empty result. Other columns are kept; names that begin with an underscore are taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from candlewick.llm.repeats import Kind, without_repeats
from candlewick.llm.text import BYTE_CODES, prefix_hashes, span_hashes

LENGTH, GRAM = 100, 32


class Suffixes:
    """Suffixes of ``raw``, compared over ``length`` bytes."""

    def __init__(self, raw: np.ndarray, length: int) -> None:
        self.raw, self.length = raw, length
        self.prefixes = prefix_hashes(BYTE_CODES[raw])

    def _same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return span_hashes(self.prefixes, a, a + size) == span_hashes(self.prefixes, b, b + size)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes at ``a`` and ``b``."""
        low = np.where(self._same(a, b, self.length), self.length, 0)
        open_ = np.flatnonzero(low == 0)
        least, most = np.zeros(len(open_), np.int64), np.full(len(open_), self.length - 1)
        a, b = a[open_], b[open_]
        while (least < most).any():
            middle = (least + most + 1) // 2
            same = self._same(a, b, middle)
            least, most = np.where(same, middle, least), np.where(same, most, middle - 1)
        low[open_] = least
        return low

    def before(self, a: np.ndarray, b: np.ndarray, equal: np.ndarray) -> np.ndarray:
        """Whether the suffix at ``a`` sorts before that at ``b``; ``equal`` where they don't differ."""
        size = self.common(a, b)
        differ = size < self.length
        out = equal.copy()
        out[differ] = self.raw[(a + size)[differ]] < self.raw[(b + size)[differ]]
        return out

    def sort(self, start: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of ``start`` by group and suffix."""
        order = np.argsort(group, kind="stable")
        ordered = group[order]
        begin = np.searchsorted(ordered, ordered, "left")
        size = np.searchsorted(ordered, ordered, "right") - begin
        width = 1
        while width < size.max(initial=0):
            live = np.flatnonzero(size > width)
            base, place = begin[live], live - begin[live]
            run = place // width
            pair, left = run // 2 * 2 * width, run % 2 == 0
            from_ = np.where(left, pair + width, pair)
            low, high = base + from_, base + np.minimum(from_ + width, size[live])
            high = np.maximum(low, high)
            first = low.copy()
            item = start[order[live]]
            while len(open_ := np.flatnonzero(low < high)):
                middle = (low[open_] + high[open_]) // 2
                ahead = self.before(start[order[middle]], item[open_], ~left[open_])
                low[open_] = np.where(ahead, middle + 1, low[open_])
                high[open_] = np.where(ahead, high[open_], middle)
            to = base + pair + (place - run * width) + (low - first)
            merged = order.copy()
            merged[to] = order[live]
            order, width = merged, width * 2
        return order


def same_windows(raw: np.ndarray, start: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Labels that agree for equal strings of one group."""
    suffixes = Suffixes(raw, length)
    order = suffixes.sort(start, group)
    a, b = order[:-1], order[1:]
    equal = np.flatnonzero((group[a] == group[b]) & suffixes._same(start[a], start[b], length))
    true = np.ones(len(equal), bool)
    span = np.arange(length)
    for at in range(0, len(equal), 50_000):  # the collision check
        part = equal[at : at + 50_000]
        true[at : at + 50_000] = (raw[start[a[part]][:, None] + span] == raw[start[b[part]][:, None] + span]).all(axis=1)
    fresh = np.ones(len(order), bool)
    fresh[1:][equal[true]] = False
    label = np.empty(len(order), np.int64)
    label[order] = np.cumsum(fresh)
    for g in np.unique(group[a[equal[~true]]]):  # a collision: the group is sorted by its bytes
        own = np.flatnonzero(group == g)
        _, label[own] = np.unique([raw[s : s + length].tobytes() for s in start[own]], return_inverse=True)
        label[own] += len(order) * (1 + int(g))
    return label


KIND = Kind(LENGTH, GRAM, np.uint8, lambda data, starts: (data, starts), lambda raw: BYTE_CODES[raw], same_windows)


def _finish(data: np.ndarray, starts: np.ndarray, bounds: np.ndarray, gone: np.ndarray) -> list[pa.Array]:
    left = np.append(0, np.cumsum(~gone))
    offsets = left[starts]
    kept = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[~gone])])
    edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
    cut = starts[1:-1][(starts[1:-1] > 0) & (starts[1:-1] < len(data))]
    split = cut[gone[cut - 1] & gone[cut]]  # a run that goes on in the next row is two
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    begin, end = np.sort(np.append(begin, split)), np.sort(np.append(end, split))
    row = np.searchsorted(starts, begin, "right") - 1
    counts = np.searchsorted(row, np.arange(len(starts)))
    spans = pa.StructArray.from_arrays([pa.array(begin - starts[row]), pa.array(end - starts[row])], ["begin", "end"])
    return [pa.array(np.diff(starts)), pa.array(np.diff(starts) - np.diff(offsets)), pa.ListArray.from_arrays(pa.array(counts.astype(np.int32)), spans), kept]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without text, with n_bytes, n_removed, the removed ``spans`` (begin, end) and the ``kept`` bytes."""
    schema = "n_bytes long, n_removed long, spans array<struct<begin: long, end: long>>, kept binary"
    return without_repeats(docs, KIND, schema, _finish)
