from __future__ import annotations

import random

import numpy as np
from brute import twins

from candlewick.llm.text import INK, LONG_WORD, word_hashes, words


def hashes(texts):
    data = " ".join(texts).encode()
    flat = np.frombuffer(data, np.uint8)
    begin, end, _ = words(flat, np.array([0, len(data)]), INK)
    return word_hashes(flat, begin, end).tolist()


def test_equal_words_and_no_others():
    """Wherever a word stands, at the end of the data too; lengths around the steps of eight bytes and around long words."""
    draw = random.Random(5)
    texts = ["".join(draw.choices("ab", k=draw.choice([1, 2, 7, 8, 9, 16, 17, LONG_WORD, LONG_WORD + 1, 300]))) for _ in range(3000)]
    found = hashes(texts + texts[::-1])
    assert found == found[::-1]
    assert len(set(found)) == len(set(texts))
    assert hashes(texts[:1]) == found[:1]


def test_words_that_are_built_to_collide():
    for size in (8, 64, 512, 1024, 4096):
        assert len(set(hashes(twins(size)))) == 2


def test_zero_bytes_count():
    assert len(set(hashes(["a", "a\0", "a\0\0", "a\0\0\0\0\0\0\0", "a\0\0\0\0\0\0\0\0"]))) == 5


def test_no_words():
    assert hashes([]) == []
