"""Near-duplicate texts by DartMinHash signatures and a banded join.

A text is a multiset of ``WORDS``-word shingles (lower-cased runs of letters and digits; a text of fewer words is one
shingle), weighted by how often they occur; likeness is the sum of the smaller weights over the sum of the larger. Texts are
near duplicates from ``LIKE`` on.

Darts: each shingle has an endless sequence of hashed darts, thrown evenly over its weight and over time, each for one of
the signature's coordinates. Weights are cut into regions [0, 1), [1, 2), [2, 4), ...; in a region darts follow each
other in time after exponential gaps, so a heavy region gets more of them. A text collects the darts under its weights up to
the time by which ``k ln k + 2 k`` are expected, and doubles that time while a coordinate has none. The earliest dart of a
coordinate is its signature: two texts agree there with the probability of their likeness. The work per text is about the
number of its shingles and of those darts, not their product.

``BANDS`` bands of ``ROWS`` coordinates are compared: a pair of likeness 0.8 shares one with probability 0.9999. Equal texts are one
node from the start. A band's texts aren't paired with each other: each meets the band's leader only, pairs are checked
by their exact likeness, and checked links are put together to classes. What a band then still holds of other classes than
its leader's is settled by an exact join of the texts of all bands with the same leader. Groups of up to ``PART`` shingles are put
together to tasks of about as many; larger ones are cut into parts of as many, and each two parts meet
in one task, except two of the group's biggest class, whose texts are linked already. In the task pairs that share no
shingle among their rarest, or whose sizes differ too much, can't be alike; all others across classes are checked in full,
but those that a link found before has put in one class.

A null text is empty. Texts without words are alike only if equal. Rows without id belong to classes like others; a class is
named by its least id (null if it has none). Repeated rows are rows of one class. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.components import components
from candlewick.llm.text import LOWER, U64, WORD, mix, pieces, prefix_hashes, ranges, span_hashes, word_hashes, words
from candlewick.session import staged

WORDS, LIKE = 5, 0.8
BANDS, ROWS = 25, 5
#: Shingles of a part of a larger group, a text counting as ``TEXT`` more.
PART, TEXT = 1 << 20, 100
#: Shingles that are compared with those of a text at once.
STRIDE = 1 << 20
#: Texts to check are found by broadcast up to so many, by a shuffle beyond.
BROADCAST_ROWS = 1_000_000


def node(text: Column) -> Column:
    """Names a distinct text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def shingles(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each shingle of a piece, repeated ones too, in the order of rows."""
    begin, end, before = words(data, starts, WORD)
    prefixes = prefix_hashes(word_hashes(LOWER[data], begin, end))
    counts = np.diff(before)
    n = np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1))
    rows = np.repeat(np.arange(len(counts)), n)
    first = before[:-1][rows] + ranges(n)
    return rows, mix(span_hashes(prefixes, first, np.minimum(first + WORDS, before[1:][rows])))


def weighted(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, hash) and how often each occurs."""
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    cuts = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])])) if len(rows) else np.empty(0, np.int64)
    return rows[cuts], hashes[cuts], np.diff(np.append(cuts, len(rows))).astype(float)


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> U64(11)).astype(float) + 0.5) * 2.0**-53


def dart_signatures(rows: np.ndarray, marks: np.ndarray, weights: np.ndarray, n: int, k: int) -> np.ndarray:
    """Signatures of ``n`` rows of weighted elements, ``k`` coordinates each; those of rows without elements are 0."""
    out = np.zeros((n, k), U64)
    total = np.bincount(rows, weights, n)
    until = np.divide(k * np.log(k) + 2 * k, total, out=np.zeros(n), where=total > 0)
    regions = np.where(weights > 1, np.ceil(np.log2(np.maximum(weights, 1))) + 1, 1).astype(np.int64)
    element = np.repeat(np.arange(len(rows)), regions)
    region = ranges(regions)
    low = np.where(region == 0, 0.0, 2.0 ** (region - 1.0))
    width = np.where(region == 0, 1.0, low)
    row, weight, seed = rows[element], weights[element], mix(marks[element] + region.astype(U64) * U64(0xD6E8FEB86659FD93))
    open_rows = total > 0
    while open_rows.any():
        live = np.flatnonzero(open_rows[row])
        time, step, thrown = np.zeros(len(live)), 0, []
        while len(live):
            step += 1
            dart = mix(seed[live] + U64(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            time = time - np.log(_unit(dart)) / width[live]
            on = time <= until[row[live]]
            live, time, dart = live[on], time[on], dart[on]
            other = mix(dart ^ U64(0x5851F42D4C957F2D))
            under = low[live] + width[live] * _unit(other) <= weight[live]
            place = (mix(other) >> U64(32)) * U64(k) >> U64(32)
            thrown.append((row[live[under]] * k + place[under].astype(np.int64), time[under], dart[under]))
        cell, time, dart = (np.concatenate(x) for x in zip(*thrown, strict=True))
        late_first = np.argsort(-time, kind="stable")
        found = np.zeros(n * k, U64)
        found[cell[late_first]] = dart[late_first]  # the earliest is written last
        found = found.reshape(n, k)
        done = open_rows & (found != 0).all(axis=1)
        out[done] = found[done]
        open_rows &= ~done
        until[open_rows] *= 2
    return out


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, starts in pieces(batch.column("text")):
            n = last - first
            signs = dart_signatures(*weighted(*shingles(data, starts)), n, BANDS * ROWS)
            bands = np.zeros((n, BANDS), U64)
            for i in range(ROWS):
                bands = mix(bands * U64(31) + signs[:, i::ROWS] + np.arange(BANDS, dtype=U64))
            counts = np.where(signs.any(axis=1), BANDS, 0)
            flat = bands[counts > 0].reshape(-1).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(flat))
            part = batch.slice(first, n)
            yield pa.RecordBatch.from_arrays([part.column("node"), part.column("doc_id"), lists], ["node", "doc_id", "bands"])


def _multisets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's shingles, sorted, 32 bits each."""
    for batch in batches:
        for first, last, data, starts in pieces(batch.column("text")):
            rows, hashes = shingles(data, starts)
            hashes = (hashes >> U64(32)).astype(np.uint32)
            hashes = hashes[np.lexsort((hashes, rows))]
            ends = (np.searchsorted(rows, np.arange(last - first + 1)) * 4).astype(np.int32)
            cells = pa.Array.from_buffers(pa.binary(), last - first, [None, pa.py_buffer(ends), pa.py_buffer(hashes)])
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(first, last - first), cells], ["node", "shingles"])


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of sorted multisets."""
    ka = ranges(np.diff(np.append(np.flatnonzero(np.append(True, a[1:] != a[:-1])), len(a)))).astype(np.int64) if len(a) else np.empty(0, np.int64)
    kb = ranges(np.diff(np.append(np.flatnonzero(np.append(True, b[1:] != b[:-1])), len(b)))).astype(np.int64) if len(b) else np.empty(0, np.int64)
    return len(np.intersect1d(a.astype(np.int64) << 31 | ka, b.astype(np.int64) << 31 | kb, assume_unique=True))


def _likeness(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for a, b in zip(batch.column("shingles_a"), batch.column("shingles_b"), strict=True):
            x, y = np.frombuffer(a.as_buffer(), np.uint32), np.frombuffer(b.as_buffer(), np.uint32)
            both = _common(x, y)
            found.append(both / max(1, len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], ["a", "b", "likeness"])


def _multisets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The shingles of the distinct texts in ``nodes``."""
    wanted = F.broadcast(nodes) if nodes.count() <= BROADCAST_ROWS else nodes
    texts = docs.select(node(F.col("text")).alias("node"), "text").join(wanted, "node", "left_semi")
    return texts.mapInArrow(_multisets, "node binary, shingles binary").groupBy("node").agg(F.first("shingles").alias("shingles"))


def _checked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    one = lambda side: sets.select(F.col("node").alias(side), F.col("shingles").alias(f"shingles_{side}"))
    return pairs.join(one("a"), "a").join(one("b"), "b").mapInArrow(_likeness, "a binary, b binary, likeness double")


def _mixed(placed: DataFrame) -> DataFrame:
    """Bands that hold texts of several classes, with their leader. Texts rank alike in all bands, so that
    equal groups have one leader."""
    bands = placed.groupBy("band").agg(
        F.min(F.struct(F.xxhash64("node").alias("turn"), "node", "root")).alias("leader"),
        F.min("root").alias("least"),
        F.max("root").alias("most"),
    )
    return placed.join(bands.where("least != most").select("band", "leader"), "band")


def _led(mixed: DataFrame) -> DataFrame:
    """Each text of another class with its band's leader."""
    led = mixed.where("root != leader.root")
    return led.select(F.least("node", "leader.node").alias("a"), F.greatest("node", "leader.node").alias("b")).distinct()


def _elements(cells: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text and element of each shingle, in the order of texts: the k-th occurrence of a shingle is an element of its own."""
    sets = [np.frombuffer(cell.as_buffer(), np.uint32) for cell in cells]
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    hashes = np.concatenate([*sets, np.empty(0, np.uint32)]).astype(np.int64)
    fresh = np.append(True, (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1]))[: len(rows)]
    return rows, hashes << 31 | ranges(np.diff(np.append(np.flatnonzero(fresh), len(rows)))).astype(np.int64)


def across(cells: pa.Array, label: np.ndarray, here: np.ndarray, like: float) -> list[tuple[int, int]]:
    """Links that join the classes ``label`` of texts as all links between texts of both sides (``here`` or not) would, or those between
    any two if all are ``here``."""
    if (label == label[0]).all():
        return []
    rows, elements = _elements(cells)
    _, code, often = np.unique(elements, return_inverse=True, return_counts=True)
    rank = np.empty(len(often), np.int64)
    rank[np.argsort(often, kind="stable")] = np.arange(len(often))
    code, label = rank[code.reshape(-1)], label.copy()
    code = code[np.lexsort((code, rows))]  # the rarest first
    size = np.bincount(rows, minlength=len(label))
    begin = np.cumsum(size) - size
    rare = np.where(size > 0, size - np.ceil(like * size - 1e-6).astype(np.int64) + 1, 0).clip(0, size)
    within = bool(here.all())
    sought, held = (here, here) if within else (here, ~here) if here.sum() <= (~here).sum() else (~here, here)
    held = np.flatnonzero(held)
    place, owner = code[np.repeat(begin[held], rare[held]) + ranges(rare[held])], np.repeat(held, rare[held])
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    first = np.searchsorted(place, np.arange(len(often) + 1))
    mine, found = np.zeros(len(often), bool), []
    for x in np.flatnonzero(sought & (size > 0)):
        mark = code[begin[x] : begin[x] + rare[x]]
        n = first[mark + 1] - first[mark]
        near = np.unique(owner[np.repeat(first[mark], n) + ranges(n)])
        low, high = np.minimum(size[near], size[x]), np.maximum(size[near], size[x])
        near = near[(label[near] != label[x]) & (low >= like * high - 1e-6) & ((near > x) | (not within))]
        own = code[begin[x] : begin[x] + size[x]]
        mine[own] = True
        while len(near):
            some = near[: max(1, int(np.searchsorted(np.cumsum(size[near]), STRIDE, "right")))]
            hit = mine[code[np.repeat(begin[some], size[some]) + ranges(size[some])]]
            both = np.add.reduceat(hit, np.cumsum(size[some]) - size[some], dtype=np.int64)
            some_alike = some[both / (size[some] + size[x] - both) >= like]
            for y in some_alike:
                if label[y] != label[x]:
                    found.append((int(x), int(y)))
                    label[label == label[y]] = label[x]
            near = near[len(some) :]
            near = near[label[near] != label[x]]
        mine[own] = False
    return found


def _grouped(mixed: DataFrame, sets: DataFrame, like: float) -> DataFrame:
    """Links (a, b) that join the classes of each band as all links between its texts would."""
    texts = mixed.select(F.col("leader.node").alias("leader"), "node", "root").distinct()
    texts = staged(texts.join(sets.select("node", (F.length("shingles") / 4 + TEXT).alias("weight")), "node"), "groups")
    per_class = texts.groupBy("leader", "root").agg(F.sum("weight").alias("weight"))
    groups = per_class.groupBy("leader").agg(F.max(F.struct("weight", "root")).alias("most"), F.sum("weight").alias("weight"))
    parts = lambda weight: F.greatest(F.lit(1), F.ceil(weight / PART)).cast("int")
    light = F.col("weight") <= PART
    bins = int((groups.where(light).agg(F.sum("weight")).first()[0] or 0) // PART) + 1
    groups = groups.select(
        "leader",
        F.col("most.root").alias("biggest"),
        parts(F.col("most.weight")).alias("n_big"),
        parts(F.col("weight") - F.col("most.weight")).alias("n_rest"),
        F.when(light, F.pmod(F.xxhash64("leader"), F.lit(bins)).cast("int")).alias("bin"),
    )
    big, turn = F.expr("root = biggest"), F.xxhash64("node")
    part = F.when(big, F.pmod(turn, F.col("n_big"))).otherwise(F.col("n_big") + F.pmod(turn, F.col("n_rest"))).cast("int")
    other = F.sequence(F.when(big, F.col("n_big")).otherwise(F.lit(0)), F.col("n_big") + F.col("n_rest") - 1)
    together = F.col("bin").isNotNull()
    dealt = texts.join(groups, "leader").select(
        F.when(~together, F.col("leader")).alias("leader"),
        "node",
        "root",
        F.when(together, F.col("bin")).otherwise(part).alias("part"),
        F.when(together, F.array("bin")).otherwise(other).alias("others"),
    )
    dealt = dealt.distinct()
    dealt = dealt.join(sets, "node").select("leader", "node", "root", "part", "shingles", F.explode("others").alias("other"))
    dealt = dealt.select("leader", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"), "part", "node", "root", "shingles")

    def joined(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        nodes, part = block.column("node").to_pylist(), block.column("part").to_numpy()
        label = np.unique(np.array([root.hex() for root in block.column("root").to_pylist()]), return_inverse=True)[1].reshape(-1)
        found = across(block.column("shingles").combine_chunks(), label, part == part.max(), like)
        ends = [pa.array([nodes[pair[side]] for pair in found], pa.binary()) for side in (0, 1)]
        return pa.table(ends, ["a", "b"])

    return dealt.groupBy("leader", "one", "two").applyInArrow(joined, "a binary, b binary")


def links(docs: DataFrame, entries: DataFrame, like: float) -> DataFrame:
    """``node`` and ``root`` of the classes of near duplicates among ``entries`` (node, band); a class's root has no row."""
    shared = staged(entries.join(entries.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band"), "band"), "bands")
    sets = staged(_multisets_of(docs, shared.select("node").distinct()), "shingles")
    alone = shared.withColumn("root", F.col("node"))
    tried = staged(_checked(_led(_mixed(alone)), sets), "checked")
    roots = components(tried.where(F.col("likeness") >= like))
    placed = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = staged(_mixed(placed), "mixed")
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(_grouped(mixed, sets, like)))


def classes(docs: DataFrame, like: float = LIKE) -> DataFrame:
    """Each row's doc_id, ``node`` (names its text), ``copy_id``, the least id of equal texts, ``class_id``, the least id of its near
    duplicates, and ``keeper``, the node that stands for the class."""
    rows = docs.select(node(F.col("text")).alias("node"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = staged(rows.mapInArrow(_banded, "node binary, doc_id long, bands array<long>"), "signatures")
    texts = signed.groupBy("node").agg(F.min("doc_id").alias("copy_id"), F.first("bands").alias("bands"))
    entries = texts.select("node", F.posexplode("bands").alias("no", "band")).select("node", F.xxhash64("no", "band").alias("band"))
    roots = links(docs, entries, like)
    named = texts.select("node", "copy_id").join(roots, "node", "left").select("node", "copy_id", F.coalesce("root", "node").alias("root"))
    first = F.min(F.struct(F.col("copy_id").isNull().alias("last"), "copy_id", "node"))
    heads = named.groupBy("root").agg(first.alias("head"))
    heads = heads.select("root", F.col("head.copy_id").alias("class_id"), F.col("head.node").alias("keeper"))
    return signed.select("node", "doc_id").join(named.join(heads, "root"), "node").select("doc_id", "node", "copy_id", "class_id", "keeper")


def keep_one(docs: DataFrame, like: float = LIKE) -> DataFrame:
    """One row of each class: the least id's, of rows that agree in id and text any."""
    found = classes(docs, like)
    kept = found.where("node = keeper and doc_id <=> class_id").select(F.col("node").alias("_node"), F.col("doc_id").alias("_id")).distinct()
    same = (node(F.col("text")) == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return docs.join(kept, same).dropDuplicates(["_node"]).select(*docs.columns)
