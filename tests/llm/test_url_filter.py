from __future__ import annotations

import random

from pyspark.sql import functions as F

from candlewick.llm import url_filter

URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "http://net",
    "http://net/",
    "HTTPS://WWW.Example.NET/en/x?y#z",
    "https://m.example.net/EN/",
    "http://a.example.com/de/1",
    "http://example.com/de",
    "http://xexample.com/de/",
    "http://org/fr/",
    "ftp://b.org/fr/a/b",
    "http://.net/",
    "http://a..net/x",
    "http://host?net/",
    "http://net#/",
    "http://" + "sub." * 300 + "net/" + "p/" * 2000,
    "http://net/",
]
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def plain(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    path = tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def judged(spark, urls, rules, **options):
    frame = spark.createDataFrame([(i if i % 5 else None, u, "clash") for i, u in enumerate(urls)], "page_id int, url string, rule string")
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    rows = url_filter.judge(frame, listed, **options).select("url", "host", "path", "rule", "verdict").collect()
    return sorted(rows, key=str)


def expected(urls, rules):
    return sorted(((u, *plain(u, rules)) for u in urls), key=str)


def test_rules(spark):
    assert list(map(tuple, judged(spark, URLS, RULES))) == [(u[0], *u[1:]) for u in expected(URLS, RULES)]


def test_against_loop(spark, monkeypatch):
    draw = random.Random(5)
    host = lambda: ".".join(draw.choices("abc", k=draw.randrange(1, 4)))
    path = lambda: "".join(draw.choices(["/", "x", "y", "/en/"], k=draw.randrange(4)))
    rules = {(host(), "/" + path()): draw.choice(["block", "allow"]) for _ in range(80)}
    rules = [(*k, v) for k, v in rules.items()]
    urls = [f"http://{host()}/{path()}" for _ in range(600)]
    once = list(map(tuple, judged(spark, urls, rules)))
    assert once == expected(urls, rules)
    monkeypatch.setattr(url_filter, "BROADCAST_ROWS", 0)
    assert list(map(tuple, judged(spark, urls, rules))) == once


def test_empty(spark):
    assert judged(spark, [], RULES) == []
    assert [r.verdict for r in judged(spark, ["http://net/"], [])] == ["allow"]
    odd = [(None, "/", "block"), ("net", None, "block"), ("net", "/", "allow"), ("net", "/", "block")]
    assert [r.verdict for r in judged(spark, ["http://net/"], odd)] == ["block"]


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    listed = spark.range(2000).select(F.concat(F.lit("h"), "id").alias("host"), F.lit("/").alias("path"))
    blocks = 2000 * url_filter.BITS // (64 * url_filter.WORDS) + 1
    bloom = url_filter.bloom_blocks(listed, blocks)

    def passed(keys):
        at = keys.withColumn("block", url_filter._block(F.col("host"), F.col("path"), blocks)).join(bloom, "block")
        for i, bit in enumerate(url_filter._bits(F.col("host"), F.col("path"))):
            at = at.where(F.col(f"w{i}").bitwiseAND(bit) != 0)
        return at.count()

    assert passed(listed) == 2000
    assert passed(listed.withColumn("path", F.lit("/other"))) < 60
