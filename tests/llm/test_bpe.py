from __future__ import annotations

import random

import public_tokenizers
import pytest
import tiktoken
from brute import TEXTS, documents, sha

from candlewick.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_against_the_library(ranks, library):
    draw = random.Random(1)
    parts = ["a", "b", "the", " ", "  ", "\n", "\t", "é", "ß", "'s", "12", "!!", "　", "😀", "aaaaaaa", "tion", "ing", "<|endoftext|>", " "]
    texts = ["".join(draw.choices(parts, k=draw.randrange(60))) for _ in range(2000)]
    texts += ["a" * 3000, "ab" * 1500, "the" * 1000, "", " ", "\n", "a" * 64, "a" * 65, " x" * 40, "日本語" * 500]
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    ids, counts = codec.encode(texts)
    end = 0
    for text, n in zip(texts, counts, strict=True):
        begin, end = end, end + n
        assert ids[begin:end].tolist() == library.encode_ordinary(text)
        assert codec.decode(ids[begin:end]).tobytes() == text.encode()


def test_long_pre_token_is_not_quadratic(ranks, library):
    text = "".join(random.Random(2).choices("abcdefgh", k=60_000))
    assert bpe.merge_long(text.encode(), ranks) == library.encode_ordinary(text)


def test_earlier_ranks_that_come_up_late():
    """abc has an earlier rank than ab: after ab is merged, abc goes before the next ab."""
    ranks = {bytes([b]): b for b in range(256)} | {b"bcd": 256, b"abc": 257, b"ab": 300, b"abcab": 301}
    library = tiktoken.Encoding("small", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    codec = bpe.Codec(ranks, r"\S+")
    texts = ["abab", "abcab", "abcd", "abcabcab", "xabcabx", "abc" * 30]
    ids, counts = codec.encode(texts)
    assert ids.tolist() == [i for t in texts for i in library.encode_ordinary(t)]
    assert bpe.merge_long(b"abc" * 30, ranks) == library.encode_ordinary("abc" * 30)


@pytest.mark.parametrize("pattern", [public_tokenizers.PATTERN, r"\S+", r"\s*\S+|\s+"])
def test_white_space_tokens_and_other_patterns(pattern):
    ranks = {bytes([b]): b for b in range(256)} | {b"  ": 256, b"\n ": 257, b"   ": 258, b" a": 259, b"ab": 260, b"b ": 261}
    library = tiktoken.Encoding("spaces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.Codec(ranks, pattern)
    draw = random.Random(7)
    texts = ["a  ", "a\n ", " abc", "  ", "a ", "ab ab", "\n "] + ["".join(draw.choices("ab  \n\t.1", k=draw.randrange(12))) for _ in range(3000)]
    ids, counts = codec.encode(texts)
    assert ids.tolist() == [i for t in texts for i in library.encode_ordinary(t)]
    assert counts.tolist() == [len(library.encode_ordinary(t)) for t in texts]
    assert bpe.CUT == public_tokenizers.PATTERN


def test_cases(spark, library):
    rows = bpe.round_trip(documents(spark), PATH, public_tokenizers.PATTERN).collect()
    want = []
    for i, text in TEXTS:
        ids = library.encode_ordinary(text or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(text or "")))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


def test_encode_then_decode(spark):
    docs = documents(spark)
    encoded = bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    assert encoded.columns == [c for c in docs.columns if c != "text"] + ["ids", "n_tokens"]
    rows = bpe.decode(encoded, PATH).collect()
    assert sorted((r.doc_id, bytes(r.decoded).decode()) for r in rows if r.doc_id) == sorted((i, t or "") for i, t in TEXTS if i)
    assert all(len(r.ids) == r.n_tokens for r in rows)


def test_empty(spark):
    assert bpe.round_trip(documents(spark, []), PATH, public_tokenizers.PATTERN).count() == 0


def test_blocks():
    assert list(bpe.blocks(["aa", None, "bbb", "", "c"], 3)) == [(0, 3), (3, 5)]
    assert list(bpe.blocks([], 3)) == []
