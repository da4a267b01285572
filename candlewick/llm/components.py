"""Connected components of links between texts, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from candlewick.session import staged


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the star contraction. Large: neighbours above a node move to its least neighbour. Small: a node and its
    neighbours below it move to the least of these."""
    if large:
        around = _both_ways(edges)
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return around.where("b > a").join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it is linked to over any number of ``links`` (a, b); roots have no row.

    Steps alternate until nothing changes; each is a written table, so a lost executor costs a step at most. A node with
    many links is never held in one place: its least neighbour is an aggregate, and the join may split it.
    """
    edges, before = staged(links.select("a", "b").where("a != b").distinct(), "links"), None
    while True:
        seen = Observation()
        mark = F.sum(F.xxhash64("a", "b") % 1_000_000_007)
        edges = staged(_stars(_stars(edges, True), False).observe(seen, F.count(F.lit(1)).alias("n"), mark.alias("mark")), "links")
        if seen.get == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = seen.get
