from __future__ import annotations

import random
import statistics
from collections import Counter

from brute import TEXTS, documents, ink_words, sha, weighted_likeness

from candlewick.llm import fingerprint


def edits(texts):
    out = []
    for n, t in enumerate(texts):
        after = texts[(n + 1) % len(texts)]
        quarter = len(t) // 4
        out.append(t[: len(t) - quarter] + after[:quarter])
    return out


def test_edited_texts(spark, monkeypatch):
    texts = [(i, t) for i, t in TEXTS if i is not None and i not in (16, 17)]
    plain = [t or "" for _, t in texts]
    for rows in (fingerprint.RANGE_ROWS, 3):
        monkeypatch.setattr(fingerprint, "RANGE_ROWS", rows)
        got = {r.doc_id: (r.n_chars, r.edited_sha256) for r in fingerprint.fingerprints(documents(spark, texts), 4).collect()}
        assert got == {i: (len(t), sha(e)) for (i, _), t, e in zip(texts, plain, edits(plain), strict=True)}


def test_cases(spark):
    rows = fingerprint.fingerprints(documents(spark), 8).collect()
    assert len(rows) == len(TEXTS)
    by = {}
    text = dict(TEXTS)
    for r in rows:
        if r.doc_id not in (16, 17):
            by.setdefault(text[r.doc_id] or "", set()).add(r.fingerprint)
    assert all(len(f) == 1 for f in by.values())
    assert by[""] == by[" \n\t "] == {"ffffffff" * 8}
    assert next(r for r in rows if r.doc_id == 1).near_next == 1.0


def test_single_and_empty(spark):
    assert fingerprint.fingerprints(documents(spark, []), 4).count() == 0
    one = fingerprint.fingerprints(documents(spark, [(5, "a b c d")]), 4).first()
    assert one.near_next == 1.0 and one.edited_sha256 == sha("a b c a")


def test_collision_rate_is_weighted_jaccard(spark):
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [(i, " ".join(draw.choices(vocabulary, k=draw.randrange(200, 900)))) for i in range(300)]
    rows = {r.doc_id: r.near_next for r in fingerprint.fingerprints(documents(spark, texts)).collect()}
    errors = [
        rows[i] - weighted_likeness(Counter(ink_words(t)), Counter(ink_words(texts[(i + 1) % 300][1]))) for i, t in texts
    ]
    assert abs(statistics.mean(errors)) < 0.04
    assert statistics.pstdev(errors) < 0.12
