"""Whole texts as byte arrays: pieces of Arrow batches, words, prefix hashes and sampled grams.

All of it is vectorised over a piece: some consecutive rows with about ``PIECE`` bytes of text. A row is never
cut; one that is longer is a piece of its own, so memory follows the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
#: Words of more bytes take a cryptographic hash.
LONG_WORD = 64
#: Keep the first 0 to 8 of eight bytes.
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (the finaliser of SplitMix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))
_POWERS = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, n of them at least."""
    if len(_POWERS["up"]) < n:
        n = 1 << max(n - 1, 1).bit_length()
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, U64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=U64)
    return _POWERS["up"], _POWERS["down"]


def prefix_hashes(symbols: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes; n + 1 values for n symbols."""
    up, _ = _powers(len(symbols) + 1)
    out = np.zeros(len(symbols) + 1, U64)
    np.cumsum(symbols * up[: len(symbols)], out=out[1:])
    return out


def span_hashes(prefixes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans [begin, end): the same for equal spans, wherever they stand."""
    _, down = _powers(len(prefixes))
    return (prefixes[end] - prefixes[begin]) * down[begin]


def all_spans(prefixes: np.ndarray, length: int) -> np.ndarray:
    """``span_hashes`` of every span of ``length`` symbols."""
    _, down = _powers(len(prefixes))
    n = max(len(prefixes) - length, 0)
    return (prefixes[length:] - prefixes[:n]) * down[:n]


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, where each row starts and the last ends); null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(int(np.searchsorted(ends, ends[first] + limit, "right")) - 1, first + 1)
        yield first, last, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def _table(codes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(codes)] = True
    return out


#: Fixed value: letters and digits of ASCII and all bytes of other characters, as in [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing.
WORD = _table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: Fixed value: everything but [\x20\x09-\x0D].
INK = ~_table([0x20, *range(0x09, 0x0E)])
#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def words(data: np.ndarray, starts: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of the bytes in ``table`` that stay in one row: their begins, their ends, and for each row the
    number of words before it (one value more than rows)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = table[data]
    begin = inside[1:] & ~inside[:-1]
    end = inside[:-1] & ~inside[1:]
    cut = starts[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    joined = cut[inside[cut] & inside[cut + 1]]
    begin[joined] = end[joined] = True
    begin, end = np.flatnonzero(begin), np.flatnonzero(end)
    return begin, end, np.searchsorted(begin, starts)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word, eight bytes at a time, each scattered before the next is added.

    Words of one length up to eight bytes never share a hash. Sums of powers modulo 2^64, as in ``prefix_hashes``, would do for
    spans of bounded length, but agree for some pairs of very long words whatever the base; words above ``LONG_WORD``
    bytes, of which a text has few, take a cryptographic hash.
    """
    size = end - begin
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each position on
    out = mix(size.astype(U64) * U64(_BASE))
    left = np.flatnonzero(size <= LONG_WORD)
    at = begin[left]
    while len(left):
        rest = end[left] - at
        part = eights[at] & _LOW_BYTES[np.minimum(rest, 8)]
        out[left] = mix((out[left] ^ part) + U64(_BASE))
        more = rest > 8
        left, at = left[more], at[more] + 8
    for k in np.flatnonzero(size > LONG_WORD):
        out[k] = int.from_bytes(hashlib.blake2b(data[begin[k] : end[k]], digest_size=8).digest(), "little")
    return out


def sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least (or greatest) of each ``width`` consecutive values."""
    pick = np.minimum if least else np.maximum
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the least gram of any ``width`` consecutive ones (all of them on a tie).

    Which gram is least depends on the grams alone, so equal runs of ``width`` grams have the same anchors.
    """
    if len(grams) < width:
        return np.empty(0, np.int64)
    least = sliding(grams, width, True)
    pad = np.zeros(width - 1, U64)
    return np.flatnonzero(sliding(np.concatenate([pad, least, pad]), width, False) == grams)


def ranges(counts: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each n of ``counts``, one after the other."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
