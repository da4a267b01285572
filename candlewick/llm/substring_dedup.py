"""Substring removal by prefix-partitioned suffix trees, on the words of whole texts.

Each word covered by a window of ``LENGTH`` consecutive words that also starts earlier (in a document before, or before in the
same document) is removed; windows are judged on the input and never cross documents. Words are runs of characters other
than white space, unchanged; a kept text is its words with one space between.

``repeats`` splits suffixes by prefix: those at anchors by the ``GRAM`` words that follow, of which only prefixes that occur in
several contexts go on; what a task holds of them is bounded. The windows of a group are split further by longer
prefixes, word by word: a node is the suffixes that agree in the words so far, a node of one suffix is a leaf and done, and a
node ``LENGTH`` words deep is a maximal repeat: all its suffixes but the earliest are removed.

Words are compared as 64-bit hashes. A null text has no words. Rows that agree in id and text are one document and get
the same result; of rows with equal ids and different texts a hash decides which is earlier; a null id comes before all
others. An empty table gives an empty result. Other columns are kept; names that begin with an underscore are taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from candlewick.llm.repeats import Kind, without_repeats
from candlewick.llm.text import INK, ranges, word_hashes, words

LENGTH, GRAM = 20, 6


def deep_nodes(raw: np.ndarray, start: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """The suffix tree of each group down to ``length`` words: labels that agree for suffixes in one node of that depth."""
    label = np.arange(len(start)) + len(start) * (length + 1)  # leaves have their own
    live = np.arange(len(start))
    nodes = group.astype(np.int64)
    for depth in range(length):
        word = raw[start[live] + depth]
        order = np.lexsort((word, nodes))
        word, node = word[order], nodes[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (word[1:] != word[:-1]) | (node[1:] != node[:-1])
        number = np.cumsum(fresh)
        several = np.bincount(number)[number] > 1 if len(number) else np.empty(0, bool)
        live, nodes = live[order[several]], number[several]
    label[live] = nodes
    return label


def _cut(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin, end, before = words(data, starts, INK)
    return word_hashes(data, begin, end), before


KIND = Kind(LENGTH, GRAM, np.uint64, _cut, lambda raw: raw, deep_nodes)


def _finish(data: np.ndarray, starts: np.ndarray, bounds: np.ndarray, gone: np.ndarray) -> list[pa.Array]:
    begin, end, before = words(data, starts, INK)
    row = np.repeat(np.arange(len(starts) - 1), np.diff(before))[~gone]
    begin, end = begin[~gone], end[~gone]
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    size = end - begin + ~first  # with a space before, but for the first of a text
    at = np.repeat(begin - ~first, size) + ranges(size)
    spaces = (np.cumsum(size) - size)[~first]
    flat = data[at] if len(at) else np.empty(0, np.uint8)
    flat[spaces] = 0x20
    offsets = np.append(0, np.cumsum(np.bincount(row, size, len(starts) - 1))).astype(np.int32)
    kept = pa.Array.from_buffers(pa.string(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
    total = np.diff(before)
    return [pa.array(total), pa.array(total - np.bincount(row, minlength=len(starts) - 1)), kept]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without text, with n_words, n_removed and the ``kept`` text."""
    return without_repeats(docs, KIND, "n_words long, n_removed long, kept string", _finish)
