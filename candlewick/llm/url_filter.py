"""URL filter: a blocked Bloom filter passes possible hits to an exact hash join.

A listed entry is a canonical URL (host, path) with a verdict. It fits a URL of its host or of a subdomain whose path
starts with the entry's. Each distinct (host, path) of the input is cut into the keys that could be listed: its host
suffixes at the dots and its path prefixes of the lengths that occur in the list. The filter, blocks of 512 bits with
eight bits per key, all of them in one block, drops nearly all keys; the rest meet the list in a hash join, which
removes false positives. Everything is DataFrame expressions.

Nulls and URLs without ``://`` have empty host and path, fit nothing and get the default verdict. Repeated rows and
repeated or null ids keep their rows. Entries without host or path are left out; of equal entries ``block`` wins.
An empty list gives every URL the default. Other columns of the input are kept; columns named host, path, rule or
verdict are replaced.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of filter per listed entry, words of 64 bits in a block.
BITS, WORDS = 16, 8
#: The filter and the list are broadcast up to so many rows; beyond that Spark joins them by shuffle.
BROADCAST_ROWS = 200_000


def canonical(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(host: Column, path: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(host, path, F.lit(1)), F.lit(blocks))


def _bits(host: Column, path: Column) -> list[Column]:
    """One bit for each word of the block."""
    spread = F.xxhash64(host, path, F.lit(2))
    one = F.lit(1).cast("long")
    return [
        F.call_function("shiftleft", one, F.shiftrightunsigned(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(WORDS)
    ]


def bloom_blocks(entries: DataFrame, blocks: int) -> DataFrame:
    """The filter of (host, path): a row for each block that has bits."""
    bits = _bits(F.col("host"), F.col("path"))
    return (
        entries.select(_block(F.col("host"), F.col("path"), blocks).alias("block"), *(b.alias(f"w{i}") for i, b in enumerate(bits)))
        .groupBy("block")
        .agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)))
    )


def judge(urls: DataFrame, listed: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``urls`` with host, path, rule and verdict; ``listed`` has host, path and verdict ("block" or "allow").

    The entry with the longest host and path together decides, of two as long the one with the longer host.
    """
    host, path = canonical(F.col(url))
    parsed = urls.withColumns({"host": host, "path": path}).drop("rule", "verdict")
    listed = (
        listed.where("host != '' and path is not null")
        .groupBy("host", "path")
        .agg(F.max(F.coalesce("verdict", F.lit(default))).alias("verdict"))
    )
    depth = F.size(F.split("host", r"\."))
    n, labels, lengths = listed.agg(F.count("*"), F.max(depth), F.collect_set(F.length("path"))).first()
    if not n:
        return parsed.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    blocks = max(1, -(-n * BITS // (64 * WORDS)))
    small = F.broadcast if n <= BROADCAST_ROWS else lambda side: side

    keys = parsed.select("host", "path").where("host != ''").distinct()
    parts = F.split("host", r"\.")
    tails = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
        lambda k: F.array_join(F.slice(parts, -k, k), "."),
    )
    heads = F.transform(
        F.filter(F.array(*map(F.lit, sorted(lengths))), lambda k: k <= F.length("path")), lambda k: F.substring("path", F.lit(1), k)
    )
    tried = keys.withColumn("tail", F.explode(tails)).withColumn("head", F.explode(heads))
    bits = _bits(F.col("tail"), F.col("head"))
    possible = tried.withColumn("block", _block(F.col("tail"), F.col("head"), blocks)).join(small(bloom_blocks(listed, blocks)), "block")
    for i, bit in enumerate(bits):
        possible = possible.where(F.col(f"w{i}").bitwiseAND(bit) != 0)
    entries = small(listed.select(F.col("host").alias("tail"), F.col("path").alias("head"), "verdict"))
    best = (
        possible.select("host", "path", "tail", "head")
        .join(entries, ["tail", "head"])
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    (F.length("tail") + F.length("head")).alias("length"),
                    F.length("tail").alias("tail_length"),
                    F.concat("tail", "head").alias("rule"),
                    "verdict",
                )
            ).alias("best")
        )
    )
    return parsed.join(best, ["host", "path"], "left").select(
        *(parsed[c] for c in parsed.columns),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
