"""Registered queries and the pipeline on a whole small corpus, beside SQL or brute force."""

from __future__ import annotations

import struct
import zlib

import public_tokenizers
import pytest
import tiktoken
from brute import documents, hits, ink_words, near_classes, repeated, sha
from oracle_check import compare, duck
from tokenizers import Tokenizer

import __spark_entry__ as registered
import corpus_pipeline
from candlewick.llm import bpe
from candlewick.llm.oracle import ORACLE
from candlewick.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]


def rows(spark, name):
    return sorted(map(tuple, QUERIES[name](spark, SF).collect()))


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(registered.queries())
    assert set(ORACLE) <= set(registered.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    message, n = compare(QUERIES[name](spark, SF), duck(SF), ORACLE[name])
    assert not message, message
    assert n > 0


def test_decontamination(spark, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = [(i, n, len(p), len(f), sha(",".join(f)), bool(p)) for (i, _), (n, p, f) in zip(texts, hits([t for _, t in texts], items), strict=True)]
    assert [r[:6] for r in rows(spark, "op2_benchmark_index")] == want


def test_resharding(spark, texts):
    found = rows(spark, "op3_min_cost_resharding")
    assert [(r[0], r[1]) for r in found] == [(i, len(t.encode()) + 16) for i, t in texts]
    sizes = [sum(r[1] for r in found if r[4] == s) for s in range(40)]
    assert max(sizes) <= sum(sizes) / 40 + max(r[1] for r in found)


def test_fingerprints(spark, texts):
    found = rows(spark, "op4_weighted_fingerprint")
    assert [r[1] for r in found] == [len(t) for _, t in texts]
    assert sum(r[5] > r[6] for r in found) > 0.9 * len(found)


def test_quality(spark, texts):
    assert [r[0] for r in rows(spark, "op5_quality_ftrl")] == [i for i, _ in texts]


def test_bytes(spark, texts):
    data = [t.encode() for _, t in texts]
    want = [(i, len(d), sum(g), sha(bytes(b for b, x in zip(d, g, strict=True) if not x))) for (i, _), d, g in zip(texts, data, repeated(data, 100), strict=True)]
    assert [(r[0], r[1], r[2], r[4]) for r in rows(spark, "op6_suffix_sort")] == want


def test_words(spark, texts):
    data = [tuple(ink_words(t)) for _, t in texts]
    want = [(i, len(d), sum(g), sha(" ".join(w for w, x in zip(d, g, strict=True) if not x))) for (i, _), d, g in zip(texts, data, repeated(data, 20), strict=True)]
    assert rows(spark, "op8_suffix_trees") == want


def test_bpe(spark, texts):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in texts:
        ids = library.encode_ordinary(t)
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(t)))
    assert rows(spark, "op9_byte_bpe") == want


def test_near_duplicates(spark, texts):
    roots = near_classes([t for _, t in texts])
    assert [(r[0], r[2]) for r in rows(spark, "op10_dart_minhash")] == [(i, texts[k][0]) for (i, _), k in zip(texts, roots, strict=True)]


def test_pipeline(spark, texts):
    """Each stage beside brute force on its own input."""
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")

    def run(name, docs):
        out = corpus_pipeline.staged(stages[name](spark, docs, SF), "test")
        if name != "encode":
            assert out.columns == docs.columns
        return out

    good = run("quality", docs)
    ids = {r.doc_id for r in good.collect()}
    right = [(i in ids) == bool(q) for i, q in labels.items()]
    assert sum(right) >= 0.9 * len(right)

    single = run("near_duplicates", good)
    before = sorted((r.doc_id, r.text) for r in good.collect())
    roots = near_classes([t for _, t in before])
    assert sorted(r.doc_id for r in single.collect()) == sorted(before[k][0] for k in set(roots))

    cut = run("repeats", single)
    before = sorted((r.doc_id, r.text) for r in single.collect())
    data = [tuple(ink_words(t)) for _, t in before]
    want = [
        (i, " ".join(w for w, x in zip(d, g, strict=True) if not x) if any(g) else t)
        for (i, t), d, g in zip(before, data, repeated(data, 20), strict=True)
    ]
    assert sorted((r.doc_id, r.text) for r in cut.collect()) == want
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    clean = run("benchmark", cut)
    want = [i for (i, _), (_, places, _) in zip(want, hits([t for _, t in want], items), strict=True) if not places]
    assert sorted(r.doc_id for r in clean.collect()) == want

    back = bpe.decode(run("encode", clean), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).collect()
    assert sorted((r.doc_id, bytes(r.decoded).decode()) for r in back) == sorted((r.doc_id, r.text) for r in clean.collect())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeats", "benchmark", "encode"]


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Nulls, empty texts and repeated rows pass through all stages; so does an empty table."""
    labels = spark.createDataFrame([(6, 1, 0), (12, 0, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    for name, frame in (("labels", labels), ("benchmark", items)):
        frame.write.parquet(str(tmp_path / f"{name}.parquet"))
    for docs in (documents(spark), documents(spark, [])):
        docs.select(*corpus_pipeline.COLUMNS).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        out = corpus_pipeline.run(spark, str(tmp_path))
        assert {"doc_id", "ids", "n_tokens"} <= set(out.columns)
        assert all(r.doc_id != 14 for r in out.collect())


def test_packing(spark, texts):
    found = rows(spark, "op11_best_fit_packing")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want.append((i, piece, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    assert [r[:5] for r in found] == want
    inside = {}
    for r in found:
        inside.setdefault(r[5], []).append((r[6], r[3]))
    for places in inside.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))] and sum(n for _, n in places) <= 2048
    assert len(inside) <= -(-sum(r[3] for r in found) // 2048) + 1
