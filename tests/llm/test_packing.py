from __future__ import annotations

import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from brute import TEXTS, documents
from tokenizers import Tokenizer

from candlewick.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = [(100, "Ünïcödé I'm you're 'S it's a'lll " * 3), (101, "á ́b ﬁ Σας ΣΑΣ İi"), (102, "x<|endoftext|>y <|startoftext|> z"), (103, "one two three\x1cfour\x85five")]


def library(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 0]


def fewest(lengths, room):
    """The least number of sequences, by trying all."""
    best = len(lengths)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for b in {left: j for j, left in enumerate(bins) if left >= lengths[i]}.values():
            go(i + 1, [left - lengths[i] * (j == b) for j, left in enumerate(bins)])
        go(i + 1, [*bins, room - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    go(0, [])
    return best


def laid_out(histogram, runs):
    """What every sequence holds, by the runs."""
    inside, ends = defaultdict(dict), defaultdict(list)
    for row in runs.tolist():
        ends[row[0]].append(row)
    for length, mine in ends.items():
        for (_, first, sequence, per, offset), then in zip(mine, [r[1] for r in mine[1:]] + [histogram[length]], strict=True):
            for t in range(then - first):
                assert offset + t % per * length not in inside[sequence + t // per]
                inside[sequence + t // per][offset + t % per * length] = length
    return inside


def check(lengths, room):
    histogram = Counter(lengths)
    runs, used, fixed = packing.plan(histogram, room)
    inside = laid_out(histogram, runs)
    assert sorted(inside) == list(range(used))
    for places in inside.values():
        end = 0
        for offset, length in sorted(places.items()):
            assert offset == end
            end += length
        assert end <= room
    assert Counter(x for p in inside.values() for x in p.values()) == histogram
    return used, fixed, [sorted(p.values(), reverse=True) for _, p in sorted(inside.items())]


def test_the_reduction_never_costs_a_sequence():
    draw, reduced = random.Random(3), 0
    for _ in range(400):
        room = draw.choice([6, 10, 17, 30])
        lengths = [draw.randint(draw.choice([1, room // 4, room // 3]), room) for _ in range(draw.randint(0, 9))]
        used, fixed, inside = check(lengths, room)
        rest = [x for p in inside[fixed:] for x in p]
        assert fixed + fewest(rest, room) == fewest(lengths, room)
        reduced += fixed
    assert reduced > 400


def test_best_fit_of_the_rest():
    """Beside best fit decreasing one by one, on lengths that the reduction leaves alone."""
    draw = random.Random(4)
    for _ in range(60):
        room = 100
        lengths = [draw.randint(2, 33) for _ in range(draw.randint(1, 200))]
        used, fixed, inside = check(lengths, room)
        bins = []
        for x in sorted((x for p in inside[fixed:] for x in p), reverse=True):
            fit = min((b for b in bins if b >= x), default=None)
            if fit is not None:
                bins.remove(fit)
            bins.append((room if fit is None else fit) - x)
        assert used - fixed == len(bins)


def at_least(histogram, room):
    """A lower bound: pieces above half a sequence need one each, and pieces from ``small`` on fill what room these leave."""
    best = 0
    for small in range(room // 2 + 1):
        alone = sum(n for x, n in histogram.items() if x > room - small)
        large = {x: n for x, n in histogram.items() if room // 2 < x <= room - small}
        rest = sum(x * n for x, n in histogram.items() if small <= x <= room // 2)
        left = sum((room - x) * n for x, n in large.items())
        best = max(best, alone + sum(large.values()) + max(0, -(-(rest - left) // room)))
    return best


def test_many_documents_need_few_runs():
    draw = random.Random(5)
    for most in (2, 10**9):
        histogram = {length: draw.randint(1, most) for length in range(1, 2049)}
        runs, used, _ = packing.plan(histogram, 2048)
        least = at_least(histogram, 2048)
        assert least <= used <= least * 1.005 and len(runs) < 100_000


def rows_of(frame):
    return [r.asDict() for r in frame.collect()]


@pytest.mark.parametrize("room", [7, 2048])
def test_pieces_and_places(spark, room):
    texts = [*TEXTS, *HARD, (7, BIG)]
    rows = rows_of(packing.pack(documents(spark, texts).repartition(5), PATH, room))
    want = Counter()
    for i, text in texts:
        ids = library(text)
        for piece, start in enumerate(range(0, len(ids), room)):
            part = ids[start : start + room]
            want[i, piece, start, len(part), tuple(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], tuple(r["ids"]), r["ids_crc32"]) for r in rows) == want
    inside = defaultdict(list)
    for r in rows:
        inside[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in inside.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= room


BIG = " ".join(f"word{n % 97} Word{n % 89}!" for n in range(9000))


def test_parts_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART", 50)
    texts = [t for _, t in [*HARD, *TEXTS]]
    for encoder in (packing.Words(PATH), packing.Whole(PATH)):
        found = dict(packing._encoded(encoder, pa.array(texts)))
        assert [found[k].tolist() for k in range(len(texts))] == [library(t)[:-1] for t in texts]


def test_words_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "KEPT_WORDS", 3)
    words = packing.Words(PATH)
    for text in ("a b", "b c d", "a " * 5 + "e f g h", "x" * 100 + " a"):
        ids, sizes = words.ids([text.encode(), b"", b"b zz"])
        assert ids.tolist() == library(text)[:-1] + library("b zz")[:-1] and sizes[1] == 0


MARKED = [
    "Wörter, words. Wörter! words) Étude... étude",
    "aİ aİ. ab, İ? ΣΑΣ. Σας, 한국! ᄒ, x\u0301. é́, a… a…, a.…",
    "don't, it's. 's 's, 're. 'reads, o'. a'.",
    "<|endoftext|>, x<|endoftext|>. x<| x|> endoftext|> </w> a</w> a< =\u0338 a=\u0338",
    "12. 3, a1! 1a! x-y, ٣. aⅷ, ʰ. ﬁ, ª.",
]


@pytest.mark.parametrize("line", [1, 64])
def test_marked_words(monkeypatch, line):
    monkeypatch.setattr(packing, "LINE", line)
    for order in (MARKED, MARKED[::-1], [w for text in MARKED for w in text.split()]):
        words = packing.Words(PATH)
        for text in order:
            assert words.ids([text.encode()])[0].tolist() == library(text)[:-1], text


def test_every_letter_before_a_mark():
    """What is a letter to Python but not to the tokenizer would be one with the mark."""
    letters = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    words, tokenizer = packing.Words(PATH), Tokenizer.from_file(PATH)
    for i in range(0, len(letters), 2000):
        text = " ".join(f"{c}, a{c}. {c}{c}" for c in letters[i : i + 2000])
        assert words.ids([text.encode()])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_letters_are_encoded_once_and_without_offsets(monkeypatch):
    """Offsets cost the tokenizer twice the time; letters with marks after them and letters beyond ASCII went that way."""
    seen, by_offset = [], packing.Words._by_offset
    monkeypatch.setattr(packing.Words, "_by_offset", lambda self, words: (seen.extend(words), by_offset(self, words))[1])
    text = "Wörter, words. Wörter! words) Étude... étude it's"
    assert packing.Words(PATH).ids([text.encode()])[0].tolist() == library(text)[:-1]
    assert set(seen) <= {",", ".", "!", ")", "...", "it's"}


@pytest.mark.parametrize("change", ["pattern", "ignore", "added", "bytes"])
def test_tokenizers_that_may_not_part_letters_and_marks(tmp_path, change):
    config = json.loads(Tokenizer.from_file(PATH).to_str())
    if change == "pattern":
        config["pre_tokenizer"]["pretokenizers"][0]["pattern"] = {"Regex": r"\S+"}
    elif change == "ignore":
        config["model"]["ignore_merges"] = True
    elif change == "added":
        config["added_tokens"][0]["content"] = "words."
    else:
        config["pre_tokenizer"]["pretokenizers"].pop()
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(config))
    words = packing.Words(str(path))
    assert packing.Words(PATH)._apart and not words._apart
    for text in ["the words. the, Words. the... the! words.", *MARKED[:1]]:
        assert words.ids([text.encode()])[0].tolist() == Tokenizer.from_file(str(path)).encode(text, add_special_tokens=False).ids


def test_sequences(spark):
    packed = packing.pack(documents(spark), PATH, 64)
    found = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert found[r.sequence_id][r.offset : r.offset + r.length] == r.ids
    assert sum(map(len, found.values())) == sum(len(library(t)) for _, t in TEXTS)


def test_empty(spark):
    assert packing.pack(documents(spark, []), PATH).collect() == []
