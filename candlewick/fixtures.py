"""Candles, payloads and requests derived from the test tables.

The tables hold no candles, so these builders make some. They serve the
registered queries, the tests and the benchmark, not users.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.calendar import date_of, epoch_of, interval_seconds, month_start
from candlewick.operators.check import check, with_verdict
from candlewick.schema import ERROR, KEY, KLINE_COLUMNS, OK, SPOT, UNCHECKED

# Expressions on candles.
HOUR = "floor(open_time / 3600)"
DAY = "floor(open_time / 86400)"

# Conditions on a time: the three parts in which streams get their input.
DECADES = ("{0} < 1704931200", "{0} >= 1704931200 and {0} < 1705795200", "{0} >= 1705795200")


def replaced(df: DataFrame, **expressions: str) -> DataFrame:
    """``df`` with some columns replaced."""
    return df.selectExpr(*[f"{expressions[c]} as {c}" if c in expressions else c for c in df.columns])


def seconds(ts: str) -> str:
    return f"unix_seconds(cast({ts} as timestamp))"


def _candles(ticks: DataFrame, exchange: str, interval: str) -> DataFrame:
    """Candles of ticks (symbol, t, price, tie): first, last, least, greatest and summed price."""
    if interval.endswith("mo"):
        opened = epoch_of(month_start(date_of("t")))
    else:
        delta = interval_seconds(f"'{interval}'")
        opened = f"cast(floor(t / {delta}) as bigint) * {delta}"
    figures = {
        "open_price": "min_by(price, struct(t, tie))",
        "close_price": "max_by(price, struct(t, tie))",
        "low": "min(price)",
        "high": "max(price)",
        "volume": "sum(price)",
    }
    return (
        ticks.selectExpr("*", f"{opened} as open_time")
        .groupBy("symbol", "open_time")
        .agg(*[F.expr(f"cast({e} as string) as {name}") for name, e in figures.items()])
        .selectExpr(
            "*",
            f"'{exchange}' as exchange",
            f"'{SPOT}' as trading_type",
            f"'{interval}' as interval",
            f"open_time + {interval_seconds(repr(interval), 'open_time')} as close_time",
            f"'{UNCHECKED}' as status",
        )
        .select(*KLINE_COLUMNS)
    )


def event_candles(
    spark: SparkSession, sf_dir: str, interval: str = "1h", exchange: str = "binance", by: str = "event_type"
) -> DataFrame:
    ticks = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        f"upper({by}) || '/USD' as symbol",
        f"{seconds('ts')} as t",
        "cast(value as decimal(18,2)) as price",
        "unix_micros(cast(ts as timestamp)) as tie",
    )
    return _candles(ticks, exchange, interval)


def order_candles(spark: SparkSession, sf_dir: str, interval: str, exchange: str) -> DataFrame:
    ticks = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "regexp_replace(o_orderpriority, '[^A-Z]', '') || '/USD' as symbol",
        f"{seconds('o_orderdate')} as t",
        "cast(o_totalprice as decimal(18,2)) as price",
        "o_orderkey as tie",
    )
    return _candles(ticks, exchange, interval)


def lineitem_candles(spark: SparkSession, sf_dir: str, exchange: str = "bybit") -> DataFrame:
    """Daily candles of every supplier: many series with gaps, for the benchmark."""
    ticks = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "l_suppkey || '/USD' as symbol",
        f"{seconds('l_shipdate')} as t",
        "cast(l_extendedprice as decimal(18,2)) as price",
        "l_orderkey * 10 + l_linenumber as tie",
    )
    return _candles(ticks, exchange, "1d")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unchecked candles of three kinds: hours, days with gaps, calendar months."""
    parts = [
        event_candles(spark, sf_dir, "1h", "binance"),
        order_candles(spark, sf_dir, "1d", "bybit"),
        order_candles(spark, sf_dir, "1mo", "okx"),
    ]
    return reduce(DataFrame.unionByName, parts)


def checked_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_verdict(check(history(spark, sf_dir)))


def dented(candles: DataFrame) -> DataFrame:
    """Some hours close a minute early, some days close an hour late."""
    return replaced(
        candles,
        close_time=f"case when interval = '1h' and {HOUR} % 41 = 7 then close_time - 60 "
        f"when interval = '1d' and {DAY} % 53 = 7 then close_time + 3600 else close_time end",
    )


def part_checked(candles: DataFrame) -> DataFrame:
    """A third of the candles stored as OK, a third as ERROR, a third unchecked."""
    return replaced(
        candles, status=f"case {HOUR} % 3 when 0 then '{OK}' when 1 then '{ERROR}' else '{UNCHECKED}' end"
    )


# Payloads: one per symbol and day of hourly candles, with an item too short to use.

_ITEMS = {
    "binance": ('[%d,"%s","%s","%s","%s","%s",%d,"0",1,"0","0","0"]', "ms o h l c v close"),
    "binanceus": ('[%d,"%s","%s","%s","%s","%s",%d,"0",1,"0","0","0"]', "ms o h l c v close"),
    "bybit": ('["%d","%s","%s","%s","%s","%s","0"]', "ms o h l c v"),
    "okx": ('["%d","%s","%s","%s","%s","%s","0","0","%d"]', "ms o h l c v done"),
    "kucoin": ('["%d","%s","%s","%s","%s","%s","0"]', "s o c h l v"),
    "bingx": ("[%d,%s,%s,%s,%s,%s,%d,0]", "ms o h l c v close"),
    "newcomer": ('["%s","%s",%d,"%s","%s","%s",%d,%d]', "v c s l h o done closed"),
}
_BODIES = {
    "binance": "[%s]",
    "binanceus": "[%s]",
    "bybit": '{"retCode":0,"result":{"list":[%s]}}',
    "okx": '{"code":"0","data":[%s]}',
    "kucoin": '{"code":"200000","data":[%s]}',
    "bingx": '{"code":0,"data":[%s]}',
    "newcomer": '{"reply":{"state":"fine","rows":[%s]}}',
}
_FIELDS = {
    "ms": "open_time * 1000",
    "s": "open_time",
    "close": "close_time * 1000 - 1",
    "closed": "close_time",
    "done": f"if({HOUR} % 5 <> 0, 1, 0)",
    "o": "open_price",
    "h": "high",
    "l": "low",
    "c": "close_price",
    "v": "volume",
}


def payloads(candles: DataFrame, exchange: str) -> DataFrame:
    """Candles packed as the exchange sends them, a day per payload."""
    pattern, names = _ITEMS[exchange]
    item = f"format_string('{pattern}', {', '.join(_FIELDS[n] for n in names.split())})"
    ordered = f"array_sort(collect_list(struct(open_time, {item} as item)))"
    if not exchange.startswith("binance"):
        ordered = f"reverse({ordered})"
    items = f"concat_ws(',', '[\"1\"]', transform({ordered}, x -> x.item))"
    return (
        candles.groupBy("symbol", "interval", F.expr(f"{DAY} as day"))
        .agg(F.expr(f"format_string('{_BODIES[exchange]}', {items}) as body"), F.expr("min(open_time) as request_start"))
        .selectExpr(
            f"concat_ws(':', '{exchange}', symbol, day) as payload_id",
            f"'{exchange}' as exchange",
            "symbol",
            "interval",
            "request_start",
            "body",
        )
    )


def live_elements(candles: DataFrame, closed: str, seq: int = 0) -> DataFrame:
    """Candles as a live feed delivers them."""
    return candles.selectExpr(
        "open_time * 1000 as open_time",
        "close_time * 1000 - 1 as close_time",
        "open_price as open",
        "close_price as close",
        "low",
        "high as hight",
        "volume",
        "exchange",
        "symbol",
        "interval",
        f"cast({closed} as boolean) as is_closed",
        f"{seq}L as seq",
    )


def _zip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        contents = []
        for file, text in zip(batch["file"], batch["text"]):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                # A fixed time stamp: run again, the task gives the same bytes.
                archive.writestr(zipfile.ZipInfo(file.replace(".zip", ".csv")), text, zipfile.ZIP_DEFLATED)
            contents.append(buffer.getvalue())
        yield pd.DataFrame({"file": batch["file"], "content": contents})


def archives(candles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Daily archives of hourly candles and their checksums.

    Every third day counts in microseconds. Saturdays have a wrong checksum,
    Sundays none.
    """
    unit = f"if({DAY} % 3 = 0, 1000000L, 1000L)"
    line = (
        f"concat_ws(',', open_time * {unit}, open_price, high, low, close_price, volume, "
        f"close_time * {unit} - 1, '0', '0', '0', '0', '0')"
    )
    file = f"concat(replace(symbol, '/'), '-', interval, '-', {date_of('open_time')}, '.zip')"
    texts = candles.groupBy(F.expr(f"{file} as file")).agg(
        F.expr(f"concat_ws('\n', transform(array_sort(collect_list(struct(open_time, {line} as line))), x -> x.line)) as text")
    )
    zips = texts.mapInPandas(_zip, "file string, content binary").selectExpr("file as path", "file", "content")
    day = "dayofweek(to_date(left(right(file, 14), 10)))"
    sums = zips.where(f"{day} <> 1").selectExpr(
        "path", f"if({day} = 7, repeat('0', 64), sha2(content, 256)) as expected"
    )
    return zips, sums


def landing_archives(candles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """These archives and checksums with the time they land at: an archive after its day, its checksum half a day before it, with it, or three
    days after it, on every fifth day ten days after it."""
    zips, sums = archives(candles)
    day = "to_date(left(right(path, 14), 10))"
    landed = f"cast({day} as timestamp) + interval 1 day"
    number = f"unix_date({day})"
    later = f"case when {number} % 5 = 0 then interval '240' hour when {number} % 3 = 0 then interval '-12' hour when {number} % 3 = 1 then interval '72' hour else interval '0' hour end"
    return zips.selectExpr("*", f"{landed} as landed"), sums.selectExpr("*", f"{landed} + {later} as landed")


def repair_batches(requests: DataFrame, clean: DataFrame) -> DataFrame:
    """Answers to repair requests: the wanted candle and the two after it, if they exist.

    The volume names the request, so that the last answer can be told.
    """
    wanted = requests.selectExpr("*", "explode(array(0, 1, 2)) as pos").selectExpr(
        *[c for c in requests.columns if c != "error_time"],
        "pos",
        f"error_time + pos * {interval_seconds(anchor='error_time')} as open_time",
    )
    answers = clean.join(wanted, list(KEY)).select("request_start", "pos", *KLINE_COLUMNS)
    return replaced(answers, volume="cast(request_start as string)")
