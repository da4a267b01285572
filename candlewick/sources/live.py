"""Live candles as a feed delivers them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.dims import EXCHANGES
from candlewick.functions.calendar import rounded_seconds
from candlewick.schema import KEY, KLINE_COLUMNS, SERIES, SPOT, UNCHECKED

# Newest candles per series that a refresh of a feed buffer looks at, for ``live_tail``.
LAST_N = 9
LAST_N_1M = 27

DROP_TAIL = [name for name, e in EXCHANGES.items() if e.drop_live_tail]


def closed(elements: DataFrame) -> DataFrame:
    """Elements of closed candles; feeds that do not say count as closed."""
    return elements.where("coalesce(is_closed, true)")


def to_candles(elements: DataFrame, *extra: str) -> DataFrame:
    """Rename and convert feed elements to candle columns."""
    return elements.selectExpr(
        "exchange",
        f"'{SPOT}' as trading_type",
        "symbol",
        "interval",
        f"{rounded_seconds('open_time')} as open_time",
        "open as open_price",
        f"{rounded_seconds('close_time')} as close_time",
        "close as close_price",
        "low",
        "hight as high",
        "volume",
        f"'{UNCHECKED}' as status",
        *extra,
    ).select(*KLINE_COLUMNS, *extra)


def latest(elements: DataFrame) -> DataFrame:
    """The last element of each candle by ``seq`` (null first); of equal ones the greater values count."""
    key = ("exchange", "symbol", "interval", "open_time")
    rest = ", ".join(c for c in elements.columns if c not in (*key, "seq"))
    return elements.groupBy(*key).agg(F.expr(f"max(struct(seq, {rest})) as last")).select(*key, "last.*").select(*elements.columns)


def live_tail(elements: DataFrame, n: int | None = None, n_1m: int | None = None) -> DataFrame:
    """Candles to store from a buffer of live elements (with ``seq``), one per candle.

    All candles, or the newest ``n`` of a series (``n_1m`` of a one-minute series, by default ``n``). Of a candle the last
    element counts; of the candles the closed ones are taken, and of those all but the newest on exchanges that do not tell
    whether a candle is closed.
    """
    if n is None:
        return without_tail(to_candles(closed(latest(elements))))
    n_1m = n if n_1m is None else n_1m
    series = "partition by exchange, symbol, interval order by open_time desc"
    # Elements of one candle rank alike, and the constant limit lets Spark cut each series before the shuffle.
    recent = (
        elements.selectExpr("*", f"dense_rank() over ({series}) as age")
        .where(f"age <= {max(n, n_1m)}")
        .where(f"age <= if(interval = '1m', {n_1m}, {n})")
        .drop("age")
    )
    unsure = ", ".join(f"'{name}'" for name in DROP_TAIL)
    kept = (
        closed(latest(recent))
        .selectExpr("*", f"row_number() over ({series}) as closed_age")
        .where(f"exchange not in ({unsure}) or closed_age > 1")
    )
    return to_candles(kept)


def without_tail(candles: DataFrame) -> DataFrame:
    """Leave out the newest candle of each series of exchanges whose feed has no closed flag."""
    newest = (
        candles.where(F.col("exchange").isin(DROP_TAIL)).groupBy(*SERIES).agg(F.expr("max(open_time) as open_time"))
    )
    return candles.join(newest, [*KEY], "left_anti")
