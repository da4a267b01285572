"""Plain-Python versions of the corpus operators."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

BASE = (
    "the quick brown fox jumps over the lazy dog while seventeen small birds sing an old song about rivers and hills "
    "and nobody in the village remembers who wrote it or why the third verse is never sung after midnight in winter"
)
#: Texts with nulls, nothing, white space, one word, long runs, copies, near copies, shared passages, other scripts, ties.
TEXTS = [
    (0, None),
    (1, ""),
    (2, " \n\t "),
    (3, "word"),
    (4, "ab " * 4000),
    (5, "x" * 5000),
    (6, BASE),
    (7, BASE),
    (8, BASE.replace("seventeen", "eighteen")),
    (9, "Before. " + BASE + " After, quite other things follow here."),
    (10, "Ünïcödé 日本語 テキスト " * 12 + BASE[:90]),
    (11, "日本語" * 60),
    (12, "!!! ??? ... ### --- *** " * 30),
    (13, BASE.upper()),
    (14, "one two three four five six seven eight nine ten"),
    (15, "a  b\n\n c \t d   e"),
    (20, BASE[::-1] + " " + BASE[::-1]),
    (None, "a text without id, which repeats: " + BASE),
    (16, "same id, first text " + BASE),
    (16, "same id, second text " + BASE),
    (17, "a repeated row of enough words to be a window of its own, even of twenty words and of one hundred bytes, is two rows"),
    (17, "a repeated row of enough words to be a window of its own, even of twenty words and of one hundred bytes, is two rows"),
]


def documents(spark, texts=TEXTS):
    """The texts with columns whose names clash with those of the operators."""
    rows = [(i, t, "en", f"src{n % 3}", None if t is None else len(t), "clash", "clash") for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS + ", place string, band string")


def small_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOWER))


def ink_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def repeated(sequences, length):
    """For each sequence, in order, which of its places are covered by a window that starts earlier."""
    seen, out = set(), []
    for s in sequences:
        gone = [False] * len(s)
        for p in range(len(s) - length + 1):
            if (w := s[p : p + length]) in seen:
                gone[p : p + length] = [True] * length
            seen.add(w)
        out.append(gone)
    return out


def hits(texts, items, width=10):
    """For each text: number of words, places hit, items."""
    windows = {}
    for item, text in items:
        w = small_words(text)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + width]), set()).update({str(item)} if item is not None else ())
    out = []
    for text in texts:
        w, places, found = small_words(text), set(), set()
        for n in set(map(len, windows)):
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    places.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((len(w), sorted(places), sorted(found)))
    return out


def twins(size=1024):
    """Two different words on which sums of powers modulo 2^64 agree for any odd base: an order of two letters, and its complement."""
    ones = [bin(n).count("1") % 2 for n in range(size)]
    return "".join("ab"[n] for n in ones), "".join("ba"[n] for n in ones)


def weighted_likeness(a, b):
    both = sum((a | b).values())
    return sum((a & b).values()) / both if both else 1.0


def shingles(text, n=5):
    w = small_words(text)
    return Counter(tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))) if w else Counter()


def near_classes(texts, like=0.8):
    """For each text the least place of its class; texts without words are alike only if equal."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (texts[i] or "") == (texts[j] or "") or (sets[i] and sets[j] and weighted_likeness(sets[i], sets[j]) >= like):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]
