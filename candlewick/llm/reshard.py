"""Resharding by minimum-cost flow: from old shard sizes and new capacities, the block transfers that move the fewest bytes.

Shard i of the old layout is shard i of the new one; bytes that stay cost nothing, bytes that change shard cost one each.
The flow runs over shards, not documents: Spark adds up the bytes of each old shard, the driver solves a network with one
node per old and new shard, whose arcs say how many bytes each old shard hands to each new one, and the documents follow from the arcs:

* Documents of more than 1 / ``FINE`` of a new shard are too coarse to cut at will. There are at most ``FINE`` times as many as new
  shards. Per old shard, the largest first, each goes into the arc with the least room that still holds it.
* What fits in no arc is larger than all that is left of each, and what is left of all arcs is as much as the documents left, so there are
  fewer of them than arcs. Only these reach the driver, which puts each where most room is.
* All others lie on one line per old shard, in the order of (block, hash), and what is left of the flow, settled anew for the few
  above, cuts the line: a document goes where its middle lies. A block is some documents of one old shard by hash of the id;
  lines are added up per block first, so no task orders a whole shard, however large.

Sizes of new shards then differ from their capacity by a few documents of that small size at most, unless a single
document is larger than a shard. ``rewrite`` writes the new files of the shards that change, and of no others.

Nulls: a null text has size 16 and CRC 0; a null id is hashed like any other; a null old shard counts as 0. Repeated rows are
placed one by one (numbered within equal hashes). An empty table has no transfers and gives an empty layout. Other columns
are kept by ``rewrite`` and not looked at.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.session import staged

#: A document above this part of a shard is placed on its own.
FINE = 256
#: Documents of a block, about.
BLOCK_ROWS = 20_000


def least_moves(old: dict[int, int], room: dict[int, int]) -> dict[tuple[int, int], int]:
    """Bytes from each old to each new shard; ``room`` holds what ``old`` holds at least. Successive cheapest paths with potentials.

    Nodes: ("s",), ("o", i), ("n", j), ("t",). Edges s-o of the old size, o-n without bound at cost 0 or 1, n-t of the room.
    """
    graph: dict[tuple, dict[tuple, list[int]]] = defaultdict(dict)

    def edge(a: tuple, b: tuple, most: int, cost: int) -> None:
        graph[a][b] = [most, cost]
        graph[b].setdefault(a, [0, -cost])

    source, sink, endless = ("s",), ("t",), sum(old.values()) + 1
    for i, size in old.items():
        edge(source, ("o", i), size, 0)
        for j in room:
            edge(("o", i), ("n", j), endless, int(i != j))
    for j, size in room.items():
        edge(("n", j), sink, size, 0)
    lift: dict[tuple, int] = defaultdict(int)
    while True:
        far, back, heap = {source: 0}, {}, [(0, source)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for b, (left, cost) in graph[a].items():
                if left > 0 and (to := d + cost + lift[a] - lift[b]) < far.get(b, 1 << 60):
                    far[b], back[b] = to, a
                    heapq.heappush(heap, (to, b))
        if sink not in far:
            break
        for a in graph:
            lift[a] += far.get(a, far[sink])
        path, b = [], sink
        while b != source:
            path.append((back[b], b))
            b = back[b]
        pushed = min(graph[a][b][0] for a, b in path)
        for a, b in path:
            graph[a][b][0] -= pushed
            graph[b][a][0] += pushed
    return {(i, j): graph[("n", j)][("o", i)][0] for i in old for j in room if graph[("n", j)][("o", i)][0] > 0}


def level(total: int, taken: list[int]) -> list[int]:
    """Room left in each shard if ``total`` more bytes fill all of them to one level; at least ``total`` together."""
    order, have = sorted(taken), 0
    for k, height in enumerate(order, 1):
        have += height
        top = -(-(total + have) // k)
        if k == len(order) or top <= order[k]:
            return [max(0, top - t) for t in taken]
    return []


def sized(docs: DataFrame, old_shard) -> DataFrame:
    """doc_id, size, text_crc32, old and turn, the hash by which an old shard's documents are ordered."""
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(old_shard.cast("int"), F.lit(0)).alias("old"),
        F.xxhash64("doc_id").alias("turn"),
    )


def plan(docs: DataFrame, old_shard, shards: int) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """The new layout (doc_id, size, text_crc32, old, shard, slot) and the flow: bytes from each old to each new shard."""
    spark = docs.sparkSession
    rows = staged(sized(docs, old_shard), "sizes")
    sums = {r["old"]: (r["n"], r["bytes"]) for r in rows.groupBy("old").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).collect()}
    n, total = sum(n for n, _ in sums.values()), sum(size for _, size in sums.values())
    flow = least_moves({i: size for i, (_, size) in sums.items()}, dict(enumerate(level(total, [0] * shards))))
    coarse = max(1, total // (shards * FINE))
    whole, taken = _coarse(rows.where(F.col("size") > coarse), flow, total, shards)
    blocks = max(1, -(-n // BLOCK_ROWS))
    fine = rows.where(F.col("size") <= coarse).withColumn("block", F.pmod("turn", F.lit(blocks)).cast("int"))
    sums = fine.groupBy("old", "block").agg(F.sum("size").alias("bytes"))
    old = {r["old"]: r["bytes"] for r in sums.groupBy("old").agg(F.sum("bytes").alias("bytes")).collect()}
    left = least_moves(old, dict(enumerate(level(sum(old.values()), taken))))

    line = Window.partitionBy("old").orderBy("block")  # a row for each block
    begins = sums.select("old", "block", (F.sum("bytes").over(line) - F.col("bytes")).alias("begin"))
    within = Window.partitionBy("old", "block").orderBy("turn", "doc_id", "size", "text_crc32")
    ordered = fine.withColumn("before", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    cuts = _cuts(spark, left)
    middle = F.col("begin") + F.col("before") + F.expr("size div 2")
    laid = (
        ordered.join(begins, ["old", "block"])
        .join(F.broadcast(cuts), "old")
        .select("doc_id", "size", "text_crc32", "old", "turn", "block", F.element_at("shards", _count(F.col("ends"), middle) + 1).alias("shard"))
    )
    return _slots(laid.unionByName(whole)), flow


def _count(ends, at):
    """How many of the ascending ``ends`` but the last are at most ``at``."""
    return F.least(F.size(F.filter(ends, lambda e: e <= at)), F.size(ends) - 1)


def _cuts(spark: SparkSession, flow: dict[tuple[int, int], int]) -> DataFrame:
    """For each old shard the ends of its pieces and where they go, what stays first."""
    lines: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for (i, j), size in sorted(flow.items(), key=lambda e: (e[0][0], e[0][0] != e[0][1], e[0][1])):
        lines[i].append((lines[i][-1][0] + size if lines[i] else size, j))
    rows = [(i, [e for e, _ in pieces], [j for _, j in pieces]) for i, pieces in lines.items()]
    return spark.createDataFrame(rows, "old int, ends array<long>, shards array<int>")


_WHOLE = "doc_id long, size long, text_crc32 long, old int, turn long, shard int, rest int"


def _fitter(flow: dict[tuple[int, int], int]):
    """Coarse documents of one old shard, the largest first, each in the arc with the least room that holds it; the others, numbered
    by ``rest``, in none (shard -1)."""

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "turn", "text_crc32"], ascending=[False, True, True], ignore_index=True)
        left = {j: amount for (i, j), amount in flow.items() if i == rows["old"].iloc[0]}
        found = []
        for size in rows["size"].tolist():
            shard = min((j for j in left if left[j] >= size), key=lambda j: (left[j], j), default=-1)
            if shard >= 0:
                left[shard] -= size
            found.append(shard)
        rows["shard"] = found
        rows["rest"] = (rows["shard"] < 0).cumsum()
        return rows

    return fit


def _coarse(rows: DataFrame, flow: dict[tuple[int, int], int], total: int, shards: int) -> tuple[DataFrame, list[int]]:
    """Coarse documents with their shards, and the bytes of them in each shard."""
    fitted = staged(rows.groupBy("old").applyInPandas(_fitter(flow), _WHOLE), "coarse")
    taken = [0] * shards
    for r in fitted.where("shard >= 0").groupBy("shard").agg(F.sum("size").alias("bytes")).collect():
        taken[r["shard"]] = r["bytes"]
    most, placed = -(-total // shards), []
    unfit = fitted.where("shard < 0").select("size", "old", "rest").collect()  # fewer than arcs
    for size, old, rest in sorted(unfit, key=lambda r: (-r["size"], r["old"], r["rest"])):
        at_home = 0 <= old < shards and taken[old] + size <= most
        shard = old if at_home else min(range(shards), key=lambda j: (taken[j], j))
        taken[shard] += size
        placed.append((old, rest, shard))
    table = rows.sparkSession.createDataFrame(placed, "old int, rest int, put int")
    own = F.when(F.col("shard") < 0, F.col("rest"))
    joined = fitted.withColumn("rest", own).join(F.broadcast(table), ["old", "rest"], "left")
    return joined.select("doc_id", "size", "text_crc32", "old", "turn", F.lit(-1).alias("block"), F.coalesce("put", "shard").alias("shard")), taken


def _slots(laid: DataFrame) -> DataFrame:
    """Numbers from 0 in each shard: the rows of (old, block) before, then the place there."""
    group = ["shard", "old", "block"]
    counts = laid.groupBy(*group).agg(F.count("*").alias("rows"))
    line = Window.partitionBy("shard").orderBy("old", "block")  # a row for each block of an old shard
    begins = counts.select(*group, (F.sum("rows").over(line) - F.col("rows")).alias("begin"))
    within = Window.partitionBy(*group).orderBy("turn", "doc_id", "size", "text_crc32")
    return (
        laid.withColumn("place", F.row_number().over(within))
        .join(begins, group)
        .select("doc_id", "size", "text_crc32", "old", "shard", (F.col("begin") + F.col("place") - 1).cast("long").alias("slot"))
    )


def changed(layout: DataFrame) -> list[int]:
    """Shards that get or lose documents."""
    moves = layout.where("old != shard").select("old", "shard").distinct().collect()
    return sorted({i for r in moves for i in r})


def rewrite(docs: DataFrame, layout: DataFrame, folder: str) -> list[int]:
    """Write the new files of the shards that change, ``shard=N`` below ``folder``, in the order of the slots; return those
    shards. The others keep their old files; a shard that lost all its documents gets no file. Ids must be unique here, as
    documents meet their place by id. Columns of ``docs`` named shard or slot are replaced."""
    shards = changed(layout)
    places = layout.where(F.col("shard").isin(shards)).select(F.col("doc_id").alias("_id"), "shard", "slot")
    rows = docs.drop("shard", "slot").join(places, F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(folder)
    return shards
