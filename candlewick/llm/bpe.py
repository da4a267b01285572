"""Byte-level BPE: encoding and decoding with a queue of merge ranks.

The pre-tokens of many texts, each distinct one once, lie end to end as linked lists of symbols. Each pair of neighbours
that the ranks know is in the bucket of its rank. Bitmaps in two levels (one over groups of 256 ranks, one over the
ranks of the group in work) mark the buckets that aren't empty, so find-first-set gives the next rank; its bucket holds
positions in the linked lists. Merging them changes the pairs at their sides: new pairs are queued, old ones stay and are
skipped as stale when they come up, as their position has another rank by then. Pre-tokens don't touch each other, so
one pop merges the leftmost pair of that rank in every one of them at once, and no pre-token sees another order than it
would alone. Pre-tokens above ``LONG`` bytes, where one rank may have many pairs in a row, have a queue of their own,
with the positions of a bucket in a heap: n bytes take time in n log n.

With the pattern ``CUT``, texts are cut at spaces first, unless a pre-token may cross one, so that the pattern sees each distinct
piece once. Other patterns see whole texts.
Ids are what the rank file says, without special tokens. The file's path is a parameter; the driver reads it and sends the
vocabulary, whose size is fixed, to the executors. A worker handles blocks of texts of about ``BLOCK`` characters.

A null text is empty: no ids, decoded to nothing. Repeated rows are all encoded. Other columns are kept; columns named ids,
n_tokens or decoded are replaced.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from candlewick.llm.text import ranges

BLOCK = 4_000_000
#: Bytes of a pre-token that gets its own queue.
LONG = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of lines of base64 and rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def first_set(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


def merge_long(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token, with a queue of its own."""
    n, known = len(token), ranks.get
    symbols: list[bytes | None] = [token[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queued = [-1] * n  # the rank of the pair that begins at a position
    groups, words, buckets = 0, defaultdict(int), defaultdict(list)

    def push(rank: int, i: int) -> None:
        nonlocal groups
        queued[i] = rank
        if rank >= 0:
            heappush(buckets[rank], i)
            words[rank >> 8] |= 1 << (rank & 255)
            groups |= 1 << (rank >> 8)

    for i in range(n - 1):
        push(known(token[i : i + 2], -1), i)
    while groups:
        group = first_set(groups)
        rank = group << 8 | first_set(words[group])
        i = heappop(buckets[rank])
        if not buckets[rank]:
            words[group] ^= 1 << (rank & 255)
            if not words[group]:
                groups ^= 1 << group
        if queued[i] != rank:
            continue
        j = after[i]
        symbols[i] += symbols[j]
        symbols[j], queued[j] = None, -1
        j = after[i] = after[j]
        if j < n:
            before[j] = i
            push(known(symbols[i] + symbols[j], -1), i)
        else:
            queued[i] = -1
        if (h := before[i]) >= 0:
            push(known(symbols[h] + symbols[i], -1), h)
    return [ranks[s] for s in symbols if s is not None]


class Codec:
    """Encodes and decodes blocks of texts with one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern, self.cut = ranks, regex.compile(pattern), pattern == CUT
        top = max(ranks.values()) + 1
        self.nothing = top  # a symbol that is in no pair
        self.bytes_of = np.array([ranks.get(bytes([b]), top) for b in range(256)], np.int64)
        pairs = sorted(
            (ranks[a] * (top + 1) + ranks[b], rank)
            for token, rank in ranks.items()
            for a, b in ((token[:i], token[i:]) for i in range(1, len(token)))
            if a in ranks and b in ranks
        )
        self.pairs, self.pair_ranks = (np.array(x, np.int64) for x in zip(*pairs, strict=True)) if pairs else (np.array([-1]),) * 2
        self.token_bytes = _Ragged([token for token, _ in sorted(ranks.items(), key=lambda e: e[1])], sorted(ranks.values()), top)
        self.decimals = _Ragged([b"%d," % r for r in range(top)], range(top), top)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * (self.nothing + 1) + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_ranks[at], -1)

    def merge(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``tokens``, end to end, and how many each has."""
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        n = int(sizes.sum())
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(tokens)), sizes)
        symbol = np.append(self.bytes_of[np.frombuffer(b"".join(tokens), np.uint8)], self.nothing)
        after, before = np.minimum(np.arange(1, n + 2), n), np.arange(-1, n)
        after[ends[sizes > 0] - 1] = n
        before[(ends - sizes)[sizes > 0]] = n
        queued = np.append(self._rank(symbol[:n], symbol[after[:n]]), -1)
        groups, waiting = 0, defaultdict(list)  # of ranks by 256; (rank, position) of those not in work

        def push(rank: np.ndarray, at: np.ndarray) -> int:
            order = np.argsort(rank, kind="stable")
            rank, at = rank[order], at[order]
            marked, cuts = 0, [*np.flatnonzero(np.diff(rank >> 8, prepend=-1)).tolist(), len(rank)]
            for begin, end in pairwise(cuts):
                group = int(rank[begin] >> 8)
                waiting[group].append((rank[begin:end], at[begin:end]))
                marked |= 1 << group
            return marked

        at = np.flatnonzero(queued >= 0)
        groups |= push(queued[at], at)
        while groups:
            group = first_set(groups)
            groups ^= 1 << group
            word, buckets, later = 0, defaultdict(list), []
            rank, at = (np.concatenate(x) for x in zip(*waiting.pop(group), strict=True))
            order = np.argsort(rank, kind="stable")
            rank, at = rank[order], at[order]
            for begin, end in pairwise([*np.flatnonzero(np.diff(rank, prepend=-1)).tolist(), len(rank)]):
                buckets[int(rank[begin]) & 255].append(at[begin:end])
                word |= 1 << (int(rank[begin]) & 255)
            while word:
                low = first_set(word)
                word ^= 1 << low
                now, found = group << 8 | low, buckets.pop(low)
                at = found[0] if len(found) == 1 else np.concatenate(found)
                at = at[queued[at] == now]
                if not len(at):
                    continue
                at.sort()
                own = owner[at]
                first = np.append(True, own[1:] != own[:-1])
                if not first.all():  # the others of a pre-token wait until its leftmost is done
                    buckets[low].append(at[~first])
                    word |= 1 << low
                    at = at[first]
                gone = after[at]
                symbol[at], symbol[gone], queued[gone] = now, -1, -1
                follow = after[gone]
                after[at], before[follow] = follow, at
                side = before[at]
                both = np.concatenate([at, side])
                new = self._rank(symbol[both], symbol[after[both]])
                new[len(at) :][side == n] = -1
                queued[both] = new
                both, new = both[new >= 0], new[new >= 0]
                near = new >> 8 <= group
                if near.any():
                    for rank_, at_ in zip(new[near].tolist(), both[near].tolist(), strict=True):
                        if rank_ >> 8 == group:
                            buckets[rank_ & 255].append(np.array([at_]))
                            word |= 1 << (rank_ & 255)
                        else:
                            waiting[rank_ >> 8].append((np.array([rank_]), np.array([at_])))
                            groups |= 1 << (rank_ >> 8)
                    both, new = both[~near], new[~near]
                later.append((new, both))
                if groups & ((1 << group) - 1):  # a pair of an earlier group came up: back to it
                    break
            if word:
                left = [(np.full(len(a), group << 8 | low), a) for low, found in buckets.items() for a in found]
                waiting[group].extend(left)
                groups |= 1 << group
            if later:
                rank, at = (np.concatenate(x) for x in zip(*later, strict=True))
                groups |= push(rank, at)
        live = np.flatnonzero(symbol[:n] >= 0)
        return symbol[live], np.bincount(owner[live], minlength=len(tokens))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``texts``, end to end, and how many each has."""
        pieces: defaultdict[str, int] = defaultdict()  # without the space before; those that have none end in one
        pieces.default_factory = pieces.__len__
        rows, sizes = [], []
        for text in texts:
            if not self.cut or _CROSSED.search(text):
                parts = [text + " "]
            else:
                parts = text.split(" ")
                parts[0] += " "
            rows.append(np.fromiter(map(pieces.__getitem__, parts), np.int64, len(parts)))
            sizes.append(len(parts))
        tokens: defaultdict[str, int] = defaultdict()
        tokens.default_factory = tokens.__len__
        find, known, flat, counts = self.pattern.findall, tokens.__getitem__, [], []
        for piece in pieces:
            piece = piece[:-1] if piece.endswith(" ") else " " + piece
            if self.cut and piece[1:].isalpha() and piece.isascii() and (piece[0] == " " or piece[0].isalpha()):
                flat.append(known(piece))
                counts.append(1)
            else:
                found = find(piece)
                flat.extend(map(known, found))
                counts.append(len(found))
        token_ids = self._tokens([t.encode() for t in tokens])
        piece_ids = _joined(*token_ids, np.array(flat, np.int64), np.array(counts, np.int64))
        return _joined(*piece_ids, np.concatenate(rows) if rows else np.empty(0, np.int64), np.array(sizes, np.int64))

    def _tokens(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ranks = self.ranks
        one = {i: [ranks[t]] for i, t in enumerate(tokens) if t in ranks}
        one.update({i: merge_long(t, ranks) for i, t in enumerate(tokens) if len(t) > LONG and i not in one})
        rest = [i for i in range(len(tokens)) if i not in one]
        ids, counts = self.merge([tokens[i] for i in rest])
        places = np.array([*rest, *one], np.int64)
        counts = np.concatenate([counts, np.fromiter(map(len, one.values()), np.int64, len(one))]).astype(np.int64)
        ids = np.concatenate([ids, np.fromiter((r for found in one.values() for r in found), np.int64)])
        order = np.argsort(places, kind="stable")
        return _joined(ids, counts, order, np.ones(len(order), np.int64))[0], counts[order]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of ``ids``, end to end."""
        return self.token_bytes.take(ids)[0]


class _Ragged:
    """Byte strings by number."""

    def __init__(self, cells: list[bytes], places, n: int) -> None:
        self.flat = np.frombuffer(b"".join(cells), np.uint8)
        self.sizes, self.begins = np.zeros(n, np.int64), np.zeros(n, np.int64)
        sizes = np.fromiter(map(len, cells), np.int64, len(cells))
        self.sizes[list(places)], self.begins[list(places)] = sizes, np.cumsum(sizes) - sizes

    def take(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[ids]
        return self.flat[np.repeat(self.begins[ids], sizes) + ranges(sizes)], sizes


def _joined(flat: np.ndarray, sizes: np.ndarray, cells: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of cells: ``cells`` are numbers of spans of ``flat``, ``counts`` how many a row has."""
    begins = np.cumsum(sizes) - sizes
    length = sizes[cells]
    total = np.append(0, np.cumsum(length))
    ends = np.cumsum(counts)
    return flat[np.repeat(begins[cells], length) + ranges(length)], total[ends] - total[ends - counts]


#: The pattern whose pre-tokens begin at spaces, but for those in runs of white space.
CUT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A space after white space and before white space or the end, which a pre-token may cross.
_CROSSED = regex.compile(r"\s (?:\s|\Z)")


def blocks(texts: list[str | None], limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``limit`` characters."""
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= limit:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _mapped(docs: DataFrame, path: str, pattern: str, keep: list[str], columns: list[StructField], cells) -> DataFrame:
    """``cells`` makes the arrays of ``columns`` from codec, texts, ids and counts."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    schema = StructType([*(f for f in docs.select(*keep).schema.fields), *columns])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, pattern)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for a, b in blocks(column.to_pylist()) if batch.num_rows else ():
                texts = [t or "" for t in column.slice(a, b - a).to_pylist()]
                arrays = cells(codec, texts, *codec.encode(texts))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *arrays], schema.names)

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(work, schema)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` without text, with ``ids`` and ``n_tokens``."""
    keep = [c for c in docs.columns if c not in ("text", "ids", "n_tokens")]

    def cells(codec: Codec, texts: list[str], ids: np.ndarray, counts: np.ndarray) -> list[pa.Array]:
        offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))), pa.array(counts)]

    return _mapped(docs, path, pattern, keep, [StructField("ids", ArrayType(IntegerType())), StructField("n_tokens", LongType())], cells)


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` (with ``ids``; null: none) and ``decoded``, the bytes. An id that isn't in the ranks fails the job."""
    tokens = tokens.drop("decoded")
    shared = tokens.sparkSession.sparkContext.broadcast({rank: token for token, rank in read_ranks(path).items()})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = shared.value.__getitem__
        for batch in batches:
            found = [b"".join(map(find, ids.as_py() or ())) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, "decoded"])

    return tokens.mapInArrow(work, StructType([*tokens.schema.fields, StructField("decoded", BinaryType())]))


def _digests(flat: np.ndarray, sizes: np.ndarray, drop: int = 0) -> list[str]:
    """SHA-256 of each span of ``flat``, without its last ``drop`` bytes."""
    ends = np.cumsum(sizes)
    view = memoryview(np.ascontiguousarray(flat))
    return [hashlib.sha256(view[a : max(a, b - drop)]).hexdigest() for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]


def _runs(counts: np.ndarray, limit: int = 400_000) -> Iterator[tuple[int, int, int, int]]:
    """First and last row of runs of about ``limit`` ids, and where their ids begin and end."""
    ends = np.append(0, np.cumsum(counts))
    first = 0
    while first < len(counts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + limit, "right")) - 1)
        yield first, last, int(ends[first]), int(ends[last])
        first = last


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total, ends = np.append(0, np.cumsum(values)), np.cumsum(counts)
    return total[ends] - total[ends - counts]


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids (decimal, commas between) and of the bytes decoded from them."""

    def cells(codec: Codec, texts: list[str], ids: np.ndarray, counts: np.ndarray) -> list[pa.Array]:
        by_ids, by_bytes = [], []
        for first, last, begin, end in _runs(counts):
            own, part = counts[first:last], ids[begin:end]
            named, sizes = codec.decimals.take(part)
            by_ids += _digests(named, _sums(sizes, own), drop=1)
            back, sizes = codec.token_bytes.take(part)
            by_bytes += _digests(back, _sums(sizes, own))
        return [pa.array(counts), pa.array(by_ids, pa.string()), pa.array(by_bytes, pa.string())]

    columns = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    return _mapped(docs, path, pattern, ["doc_id"], columns, cells)
