from __future__ import annotations

import calendar
import datetime
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from candlewick.dims import EXCHANGES, INTERVAL_SECONDS, INTERVALS
from candlewick.functions import calendar as cal
from candlewick.functions import text


def test_interval_lengths(spark):
    codes = [*INTERVALS, "45", "10s", "90m", "5d", "2w", "7mo"]
    units = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800, "mo": 28 * 86400, "": 1}
    df = spark.createDataFrame([(c,) for c in codes], "interval string")
    for code, got in df.selectExpr("interval", f"{cal.interval_seconds()} as s").collect():
        number = int("".join(c for c in code if c.isdigit()))
        assert got == number * units["".join(c for c in code if not c.isdigit())], code
    assert INTERVAL_SECONDS["8h"] == 28800 and INTERVAL_SECONDS["3d"] == 259200


def test_month_lengths(spark):
    df = spark.range(0, 12 * 60).selectExpr("unix_seconds(cast(add_months(date'1996-01-15', cast(id as int)) as timestamp)) as t")
    for t, one, three in df.selectExpr(
        "t", f"{cal.interval_seconds(repr('1mo'), 't')} as a", f"{cal.interval_seconds(repr('3mo'), 't')} as b"
    ).collect():
        day = datetime.datetime.fromtimestamp(t, datetime.timezone.utc)
        months = [(day.year + (day.month - 1 + i) // 12, (day.month - 1 + i) % 12 + 1) for i in range(3)]
        days = [calendar.monthrange(y, m)[1] for y, m in months]
        assert (one, three) == (days[0] * 86400, sum(days) * 86400)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 4 * 10**12), min_size=1, max_size=300))
def test_rounding_is_half_even(spark, values):
    values = values + [v // 1000 * 1000 + 500 for v in values]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for v, got in df.selectExpr("v", f"{cal.rounded_seconds('v')} as s").collect():
        assert got == int(round(v / 1000))


def test_archive_times(spark):
    values = [1499040059999, 1499040000000, 1735689600000000, 1735689659999999]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = [r.s for r in df.selectExpr(f"{cal.archive_seconds('v')} as s").collect()]
    assert got == [1499040060, 1499040000, 1735689600, 1735689660]


def test_session_zone_does_not_matter(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        draw = random.Random(1)
        values = [draw.randrange(0, 2**32) for _ in range(200)]
        df = spark.createDataFrame([(v,) for v in values], "v long")
        found = df.selectExpr(
            "v",
            f"{cal.time_text('v')} as text",
            f"{cal.year_of('v')} as y",
            f"{cal.month_of('v')} as m",
            f"{cal.day_of('v')} as d",
            f"{cal.next_month_time('v')} as n",
        ).collect()
        for v, shown, y, m, d, n in found:
            day = datetime.datetime.fromtimestamp(v, datetime.timezone.utc)
            assert shown == day.strftime("%Y-%m-%d %H:%M:%S")
            assert (y, m, d) == (day.year, day.month, day.day)
            after = datetime.datetime(y + m // 12, m % 12 + 1, 1, tzinfo=datetime.timezone.utc)
            assert n == int(after.timestamp())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_folders_grow_with_time(spark):
    df = spark.range(0, 3000).selectExpr("id * 604800 as t")
    parts = df.selectExpr(
        f"{cal.part_of(repr('1m'), 't')} as m", f"{cal.part_of(repr('4h'), 't')} as h", f"{cal.part_of(repr('1mo'), 't')} as mo"
    ).collect()
    for name in ("m", "h", "mo"):
        values = [r[name] for r in parts]
        assert values == sorted(values)
    assert (parts[0].m, parts[0].h, parts[0].mo) == (197001, 1970, 0)
    assert (parts[-1].m // 100, parts[-1].mo) == (parts[-1].h, 0)


def test_names(spark):
    row = spark.sql("select 'binance' as exchange, 'SPOT' as trading_type, 'BTC/USDT' as symbol, '1mo' as interval, 'x' as cache_type")
    series, key = row.selectExpr(text.series_name(), text.meta_key()).first()
    assert series == "binance__spot__btc_usdt__1mo"
    import hashlib

    assert key == hashlib.sha256(b"_____binance_BTC/USDT_1mo_SPOT_x_____").hexdigest()


def test_structures(spark):
    cases = [
        ('{"a":1,"b":"x"}', '{"b":"y","a":7}', True),
        ('{"a":1}', '{"a":"1"}', False),
        ('{"a":1.5}', '{"a":22.75}', True),
        ('{"a":1}', '{"a":1.5}', False),
        ('{"a":1}', '{"a":1,"c":2}', False),
        ('[[1,"x"]]', '[[2,"y"],[3,"z"]]', True),
        ("null", "null", True),
        ("[]", '[{"a":[1]}]', True),
        ('{"x":["q"],"y":1}', '{"x":[],"y":2}', True),
        ('{"x":[],"y":1}', '{"x":["q"],"y":"2"}', False),
        ('{"x":[],"y":[[2]]}', '{"x":[[["q"]]],"y":[]}', False),  # one list may be empty, not one on each side
        ("[]", '{"a":1}', False),
        ("[]", "1", False),
        ("true", "false", True),
        ('{"x":[]}', '{"x":' + "[" * 40 + "1" + "]" * 40 + "}", True),
        ('{"x":[{"a<b":1}]}', '{"x":[]}', True),
        ('{"a`b: c,d":[[]]}', '{"a`b: c,d":[["x"]]}', True),
        ('{"a<b":1}', '{"a<c":1}', False),
        ('{"a":{}}', '{"a":{"b":[]}}', False),
        (None, "1", None),
    ]
    df = spark.createDataFrame(cases, "a string, b string, same boolean")
    shapes = df.selectExpr("*", f"{text.structure('a')} as sa", f"{text.structure('b')} as sb")
    for r in shapes.select("*", text.same_structure("sa", "sb").alias("got")).collect():
        assert r.got == r.same, r


def test_supported_intervals():
    assert {n: len(e.intervals) for n, e in EXCHANGES.items()} == {
        "binance": 15, "binanceus": 15, "bybit": 13, "okx": 14, "kucoin": 14, "bingx": 15,
    }
    assert "8h" not in EXCHANGES["okx"].intervals and "3d" not in EXCHANGES["kucoin"].intervals
