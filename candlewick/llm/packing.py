"""Packing documents into sequences: Martello-Toth dominance reduction, then best fit for what it leaves.

Lengths are whole numbers up to the room of a sequence, so the whole instance is a histogram: how many pieces there are of
each length. Spark tokenises, cuts and counts; the driver packs the histogram, whose size is the room, not the number of
documents; Spark then gives every piece its place. Three steps:

* ``pieces`` tokenises, cuts documents longer than a sequence, and numbers the pieces of one length within their task.
  Written once, so the numbers hold. Prefix sums over tasks make them numbers within the length, and no row is sorted for it.
* ``plan`` is the packing, as runs: so many pieces of a length, so many to a sequence, in sequences that follow one another.
  A piece set that dominates every other set its longest piece could share a sequence with is fixed for good (at most three
  pieces, see ``dominant``); the rest is packed by best fit, longest first. All pieces of a length are handled at once, so the
  work and the number of runs depend on the room alone: every best-fit run ends a length or uses up sequences that are alike, of which
  each length adds three kinds at most, and a kind can take each length once, and at most sqrt(2 x room) different lengths.
* ``place`` looks up the run of a piece by (length, number).

``pack`` has the ids of each piece, ``sequences`` puts them together as rows to train on.

Nulls: a null text is empty, an empty text is the end id alone; a null id is kept as it is. Very long texts are tokenised in parts cut at white
space, so memory follows the ids of the longest document. Rows with one id, or the same row twice, are documents of their own.
An empty table gives no rows. Ties: pieces of one length are alike, and which of them goes where follows the order of rows in the
table. Other columns are dropped, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.session import staged

ROOM = 2048
#: Words a worker keeps the ids of, and ids above which it begins anew.
KEPT_WORDS, KEPT_IDS = 1_000_000, 1 << 23
#: Bytes of text split into words at a time, ids handed back to Spark at a time, and words encoded as one line.
PART, BLOCK_IDS, LINE = 1 << 22, 1 << 20, 64

_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")
#: ASCII marks that may end a word, but for the apostrophe, which this pattern can take with letters.
_MARKS = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'")
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPLIT = {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True}
_PLAIN = (
    {"type": "NFC"},
    {"type": "Lowercase"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
)


def _letters_apart(config: dict, vocabulary: dict[str, int]) -> bool:
    """Whether the tokenizer is known to part letters from the marks after them, and to end each pre-token, and nothing else, by a marked id."""
    before, model = config["pre_tokenizer"] or {}, config["model"]
    steps, last = before.get("pretokenizers") or [before], model.get("end_of_word_suffix")
    normal = config["normalizer"] or {"normalizers": []}
    if not (
        all(n in _PLAIN for n in normal.get("normalizers", [normal]))
        and len(steps) == 2
        and steps[0] == _SPLIT
        and steps[1].get("type") == "ByteLevel"
        and not steps[1]["add_prefix_space"]
        and not steps[1]["use_regex"]
        and model["type"] == "BPE"
        and last
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges"))
    ):
        return False
    from tokenizers.pre_tokenizers import ByteLevel

    whole = all(c in vocabulary and c + last in vocabulary for c in ByteLevel.alphabet())
    # Letters and then marks must not hold an added token, which is found before all else.
    return whole and not any((stem := t["content"].rstrip(_MARKS)).isalpha() or not stem for t in config["added_tokens"])


class Words:
    """Ids of texts, word by word, where a word is what stands between ASCII white space.

    Right for tokenizers that drop white space and neither normalise nor match across it. A word is encoded when it first
    comes, together with the other new ones, and its ids are kept until there are too many. Where the tokenizer is known to
    part letters from the marks after them, a word of both takes its ids from the two.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        config, vocabulary = json.loads(self._tokenizer.to_str()), self._tokenizer.get_vocab()
        last = config["model"].get("end_of_word_suffix")
        self._last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self._last[[i for t, i in vocabulary.items() if last and t.endswith(last)]] = True
        self._apart = _letters_apart(config, vocabulary)
        self._forget()

    def _forget(self) -> None:
        self._places: dict[str, int] = {}
        self._ids, self._ends = np.empty(0, np.int32), np.zeros(1, np.int64)
        self._odd: set[str] = set()  # words of letters that the tokenizer parts

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
        words, whose = split.flatten(), pc.list_parent_indices(split).to_numpy()
        # White space at an end leaves an empty word there.
        ink = pc.greater(pc.binary_length(words), 0)
        kinds = words.filter(ink).dictionary_encode()
        whose, distinct = whose[ink.to_numpy(zero_copy_only=False)], kinds.dictionary.to_numpy(zero_copy_only=False)
        places = self._found(distinct)
        if len(new := distinct[places < 0]):
            if len(self._places) + len(new) > KEPT_WORDS or len(self._ids) > KEPT_IDS:
                self._forget()
                places[:], new = -1, distinct
            self._learn(new.tolist())
            places[places < 0] = self._found(new)
        ids, size = self._take(places[kinds.indices.to_numpy()])
        return ids, np.bincount(whose, size, len(texts)).astype(np.int64)

    def _found(self, words: Sequence[str]) -> np.ndarray:
        """The place of each word, -1 if it has none."""
        return np.fromiter(map(self._places.get, words, repeat(-1)), np.int64, len(words))

    def _take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids at the places, one after the other, and how many each has."""
        size = self._ends[places + 1] - self._ends[places]
        return self._ids[np.arange(size.sum()) + np.repeat(self._ends[places] - np.cumsum(size) + size, size)], size

    def _keep(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self._places.update(zip(words, range(len(self._places), len(self._places) + len(words)), strict=True))
        self._ends = np.append(self._ends, len(self._ids) + np.cumsum(sizes))
        self._ids = np.append(self._ids, ids)

    def _learn(self, words: list[str]) -> None:
        """Keep the ids of new words."""
        letters, marked, others = [], [], []
        for word in words:
            if word.isalpha() and (self._apart or word.isascii()):
                letters.append(word)
            elif self._apart and (stem := word.rstrip(_MARKS)).isalpha():
                marked.append((word, stem, word[len(stem) :]))
            else:
                others.append(word)
        stems = dict.fromkeys(stem for _, stem, _ in marked)
        alone = stems.keys() - letters - self._places.keys() - self._odd
        odd = self._by_last([*letters, *(s for s in stems if s in alone)])
        others += [w for w in letters if w in odd]
        self._odd |= odd
        # What is no letter to the tokenizer, or becomes a mark as in small İ, may be one with the marks after it.
        others += [w for w, stem, _ in marked if stem in self._odd]
        marked = [m for m in marked if m[1] not in self._odd]
        tails = dict.fromkeys(tail for _, _, tail in marked)
        others = list(dict.fromkeys([*others, *(t for t in tails if t not in self._places)]))
        self._keep(others, *self._by_offset(others))
        if marked:
            ids, sizes = self._take(self._found([part for _, *parts in marked for part in parts]))
            self._keep([w for w, _, _ in marked], ids, sizes.reshape(-1, 2).sum(1))

    def _by_last(self, words: list[str]) -> set[str]:
        """Keep words whose ends are told by the ids that end a word, and return those where this doesn't hold. The tokenizer
        does without offsets here."""
        lines = [words[i : i + LINE] for i in range(0, len(words), LINE)]
        found = self._tokenizer.encode_batch_fast([" ".join(line) for line in lines], add_special_tokens=False)
        # A vocabulary that doesn't mark its last ids, or parts letters, has another number of them.
        ids = [np.array(e.ids, np.int32) for e in found]
        ends = [np.flatnonzero(self._last[i]) + 1 for i in ids]
        good = [len(e) == len(line) and e[-1] == len(i) for i, e, line in zip(ids, ends, lines, strict=True)]
        if any(good):
            kept = [w for line in compress(lines, good) for w in line]
            self._keep(kept, np.concatenate([*compress(ids, good)]), np.concatenate([np.diff(e, prepend=0) for e in compress(ends, good)]))
        return {w for line, ok in zip(lines, good, strict=True) if not ok for w in line}

    def _by_offset(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and how many each word has, by the places in the joined text: the ids of a word begin inside it."""
        found = self._tokenizer.encode(" ".join(words), add_special_tokens=False)
        starts = np.fromiter((first for first, _ in found.offsets), np.int64, len(found.ids))
        ends = np.searchsorted(starts, np.cumsum([len(w) + 1 for w in words]))
        return np.array(found.ids, np.int32), np.diff(ends, prepend=0)


def _parts(data: bytes) -> Iterator[bytes]:
    """The text in parts of about ``PART`` bytes that end before white space."""
    first = 0
    while found := _SPACE.search(data, first + PART):
        yield data[first : found.start()]
        first = found.start()
    yield data[first:]


class Whole:
    """Ids of whole texts, for tokenizers that keep white space."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [self._tokenizer.encode(t.decode(), add_special_tokens=False).ids for t in texts]
        return np.array([i for ids in found for i in ids], np.int32), np.array([len(ids) for ids in found], np.int64)


@lru_cache(maxsize=2)
def _encoder(path: str, by_word: bool) -> Words | Whole:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return (Words if by_word else Whole)(path)


def _encoded(encoder: Words | Whole, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(place in the batch, ids) of every text; short texts are encoded together, long ones in parts where words allow it."""
    some, held = [], 0

    def done() -> Iterator[tuple[int, np.ndarray]]:
        ids, sizes = encoder.ids([data for _, data in some])
        yield from zip((at for at, _ in some), np.split(ids, np.cumsum(sizes)[:-1]), strict=True)

    for at in range(len(texts)):
        data = (texts[at].as_py() or "").encode()
        if some and held + len(data) > PART:
            yield from done()
            some, held = [], 0
        if len(data) > PART and isinstance(encoder, Words):
            yield at, np.concatenate([encoder.ids([part])[0] for part in _parts(data)])
        else:
            some.append((at, data))
            held += len(data)
    if some:
        yield from done()


def pieces(docs: DataFrame, path: str, room: int = ROOM, end: int = 0, by_word: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids, ids_crc32, and task and turn: the piece's number within its task and length. Written once."""
    key = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", key),
            *(T.StructField(n, t) for n, t in (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()))),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            *(T.StructField(n, T.LongType()) for n in ("ids_crc32", "task", "turn")),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, seen = _encoder(path, by_word), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows, held = [], 0
            for at, ids in _encoded(encoder, batch.column(1)):
                ids = np.append(ids, np.int32(end))
                for piece, start in enumerate(range(0, len(ids), room)):
                    part = ids[start : start + room]
                    rows.append((at, piece, start, part, zlib.crc32(part.astype("<u4").tobytes()), seen[len(part)]))
                    seen[len(part)] += 1
                held += len(ids)
                if held >= BLOCK_IDS:
                    yield _batch(batch.column(0), rows, task)
                    rows, held = [], 0
            if rows:
                yield _batch(batch.column(0), rows, task)

    return staged(docs.select("doc_id", F.col("text").cast("string")).mapInArrow(cut, schema), "pieces")


def _batch(keys: pa.Array, rows: list[tuple], task: int) -> pa.RecordBatch:
    at, piece, start, parts, crc, turn = map(list, zip(*rows, strict=True))
    length = np.fromiter(map(len, parts), np.int64, len(parts))
    ids = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(length)]).astype(np.int32), np.concatenate(parts))
    columns = {
        "doc_id": keys.take(pa.array(at)),
        "piece": pa.array(piece, pa.int32()),
        "start": pa.array(start, pa.int64()),
        "length": pa.array(length),
        "ids": ids,
        "ids_crc32": pa.array(crc, pa.int64()),
        "task": pa.array([task] * len(rows), pa.int64()),
        "turn": pa.array(turn, pa.int64()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def dominant(counts: dict[int, int], present: list[int], room: int, longest: int) -> tuple[int, ...] | None:
    """Pieces that some best packing has in the sequence of a piece of length ``longest``, itself first; None if not known.

    Of sets of others that fit beside it, one dominates if the pieces of any other set can be put in the places of its
    own: exchanging them costs no sequence. ``present`` are the lengths with a count, ascending. Known cases: nothing
    fits; one piece fills the rest, or at most one piece fits (the longest that does); at most two fit, and the longest single is as
    long as any pair, or no pair has a second piece longer than the second beside the longest single.
    """
    left = room - longest

    def others(lengths, taken: tuple[int, ...]) -> Iterator[int]:
        """Single pieces of the lengths in order, without those taken."""
        for length in lengths:
            for _ in range(min(3, counts[length] - taken.count(length))):
                yield length

    def largest(most: int, taken: tuple[int, ...]) -> int | None:
        return next(others((present[i] for i in range(bisect_right(present, most) - 1, -1, -1)), taken), None)

    one = largest(left, (longest,))
    if one is None:
        return (longest,)
    least = [x for x, _ in zip(others(iter(present), (longest,)), range(3))]
    if one == left or len(least) < 2 or least[0] + least[1] > left:
        return longest, one
    if len(least) == 3 and sum(least) <= left:
        return None
    two = largest(left - one, (longest, one))
    # Two pieces longer than ``two``, the least of them: if they don't fit, no pair has both.
    above = [x for x, _ in zip(others((present[i] for i in range(bisect_right(present, two or 0), len(present))), (longest, one)), range(2))]
    if two is not None and (len(above) < 2 or sum(above) > left):
        return longest, one, two
    free = [x for x in present if counts[x] > (x == longest)]
    best, low, high = 0, 0, bisect_right(free, left) - 1
    while low <= high:
        pair = free[low] + free[high]
        if pair > left:
            high -= 1
        else:
            if low < high or counts[free[low]] - (free[low] == longest) > 1:
                best = max(best, pair)
            low += 1
    return (longest, one) if one >= best else None


def plan(histogram: dict[int, int], room: int) -> tuple[np.ndarray, int, int]:
    """Runs (length, first number, first sequence, pieces per sequence, offset) in order of length and number, the sequences
    used, and how many of them the reduction fixed."""
    counts = Counter({length: n for length, n in histogram.items() if n})
    numbered, runs, used = Counter(), [], 0

    def run(length: int, n: int, first: int, per: int, offset: int) -> None:
        runs.append((length, numbered[length], first, per, offset))
        numbered[length] += n

    changed = True
    while changed:
        changed = False
        for longest in sorted(counts, reverse=True):
            while counts[longest]:
                fixed = dominant(counts, sorted(+counts), room, longest)
                if fixed is None:
                    break
                shares, offset = Counter(fixed), 0
                times = min(counts[x] // n for x, n in shares.items())
                for length, n in shares.items():
                    run(length, times * n, used, n, offset)
                    counts[length] -= times * n
                    offset += length * n
                used += times
                changed = True
        counts = +counts
    fixed_sequences = used

    # Alike sequences: for each room left the ranges (first, number) that have it.
    open_at: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []

    def leave(left: int, first: int, n: int) -> None:
        if left and n:
            if left not in open_at:
                insort(rooms, left)
            open_at.setdefault(left, []).append((first, n))

    for length in sorted(counts, reverse=True):
        todo = counts[length]
        while todo:
            place = bisect_left(rooms, length)
            if place < len(rooms):
                left = rooms[place]
                first, n = open_at[left].pop()
                if not open_at[left]:
                    del open_at[left], rooms[place]
            else:
                left, first, n = room, used, -(-todo // (room // length))
                used += n
            # Best fit goes on with a sequence while it can, as what is left is less than before.
            per = left // length
            whole = min(n, todo // per)
            if whole:
                run(length, whole * per, first, per, room - left)
                leave(left - per * length, first, whole)
                todo -= whole * per
            if whole < n and todo:
                run(length, todo, first + whole, todo, room - left)
                leave(left - todo * length, first + whole, 1)
                whole, todo = whole + 1, 0
            leave(left, first + whole, n - whole)
    return np.array(sorted(runs), np.int64).reshape(-1, 5), used, fixed_sequences


def place(runs: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Add ``sequence_id`` and ``offset`` by length and number; the runs are bounded by the room, see above."""
    keys = (runs[:, 0] << 42) + runs[:, 1]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            found = runs[np.searchsorted(keys, (length << 42) + number, "right") - 1]
            turn = number - found[:, 1]
            sequence, offset = found[:, 2] + turn // found[:, 3], found[:, 4] + turn % found[:, 3] * length
            kept = batch.drop_columns(["number"])
            yield kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return placed


def pack(docs: DataFrame, path: str, room: int = ROOM, end: int = 0, by_word: bool = True, ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids (unless left out), sequence_id, offset for every piece of every document.

    ``path`` is a tokenizer file, ``end`` the id after each document. ``by_word`` is for tokenizers that drop white space, see ``Words``.
    """
    cut = pieces(docs, path, room, end, by_word)
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    order = Window.partitionBy("length").orderBy("task")
    before = staged(per_task.withColumn("before", F.sum("n").over(order) - F.col("n")), "numbers")
    # One row per length: the room at most.
    histogram = {r.length: r.n for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _, _ = plan(histogram, room)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])]
    numbered = cut.join(before.select("length", "task", "before"), ["length", "task"]).select(
        *columns, (F.col("before") + F.col("turn")).alias("number")
    )
    schema = T.StructType([f for f in numbered.schema if f.name != "number"]).add("sequence_id", T.LongType()).add("offset", T.LongType())
    return numbered.mapInArrow(place(runs), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids, the pieces in the order of their offsets; at most the room of ids to a row."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(inside.alias("_pieces")).select("sequence_id", F.expr("flatten(_pieces.ids)").alias("ids"))
