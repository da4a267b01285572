"""Exchange dimensions: what differs between exchanges, kept as data.

Adding an exchange means adding an entry here; no job changes.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Seconds per interval; a month has no fixed length.
INTERVAL_SECONDS = {
    "1m": 60,
    "3m": 180,
    "5m": 300,
    "15m": 900,
    "30m": 1800,
    "1h": 3600,
    "2h": 7200,
    "4h": 14400,
    "6h": 21600,
    "8h": 28800,
    "12h": 43200,
    "1d": 86400,
    "3d": 259200,
    "1w": 604800,
}
INTERVALS = (*INTERVAL_SECONDS, "1mo")

# Intervals that archives offer by month only.
MONTHLY_ONLY = ("3d", "1w", "1mo")


@dataclass(frozen=True)
class Layout:
    """Where an exchange puts candle fields in its payload.

    ``root`` is the JSON path of the candle list, indexes count from 0.
    ``close`` is an index, or None when the close is open + interval length.
    ``tail`` tells how the candle still in progress is recognised:
    ``last`` (always the newest), ``last_of_many`` (the newest if there are
    at least two), ``flag`` (item ``flag`` is not '1') or ``none``.
    """

    root: str
    min_len: int
    open: int = 0
    close: int | None = None
    ohlcv: tuple[int, int, int, int, int] = (1, 2, 3, 4, 5)
    unit_ms: bool = True
    newest_first: bool = True
    tail: str = "last_of_many"
    flag: int | None = None
    success: tuple[str, str] | None = None


@dataclass(frozen=True)
class Catalog:
    """Where an exchange puts its symbol list: base and quote fields, or one joined field."""

    root: str
    base: str | None = None
    quote: str | None = None
    joined: str | None = None
    # Path and value of the code of a good reply; without a value any code will do.
    success: tuple[str, str | None] | None = None


@dataclass(frozen=True)
class Exchange:
    layout: Layout
    catalog: Catalog
    limit: int
    recent_limit: int | None = None
    native_separator: str = ""
    separator_counts: bool = False
    native_intervals: dict[str, str] = field(default_factory=dict)
    first_year_month: tuple[int, int] | None = None
    has_archive: bool = False
    drop_live_tail: bool = False

    @property
    def intervals(self) -> tuple[str, ...]:
        return tuple(i for i in INTERVALS if i in self.native_intervals)


_SAME = {i: i for i in INTERVALS}

# Payload layouts, native interval codes and row limits of the exchanges.
EXCHANGES: dict[str, Exchange] = {
    "binance": Exchange(
        layout=Layout(root="$", min_len=12, close=6, newest_first=False, tail="last"),
        catalog=Catalog(root="$.symbols", base="baseAsset", quote="quoteAsset"),
        limit=1000,
        native_intervals=_SAME,
        first_year_month=(2018, 1),
        has_archive=True,
    ),
    "binanceus": Exchange(
        layout=Layout(root="$", min_len=12, close=6, newest_first=False, tail="last"),
        catalog=Catalog(root="$.symbols", base="baseAsset", quote="quoteAsset"),
        limit=1000,
        native_intervals=_SAME,
        first_year_month=(2018, 1),
    ),
    "bybit": Exchange(
        layout=Layout(root="$.result.list", min_len=7),
        catalog=Catalog(
            root="$.result.list", base="baseCoin", quote="quoteCoin", success=("$.retCode", "0")
        ),
        limit=1000,
        native_intervals={
            "1m": "1", "3m": "3", "5m": "5", "15m": "15", "30m": "30",
            "1h": "60", "2h": "120", "4h": "240", "6h": "360", "12h": "720",
            "1d": "D", "1w": "W", "1mo": "M",
        },
    ),
    "okx": Exchange(
        layout=Layout(root="$.data", min_len=9, tail="flag", flag=8),
        catalog=Catalog(root="$.data", base="baseCcy", quote="quoteCcy", success=("$.code", "0")),
        limit=100,
        recent_limit=300,
        native_separator="-",
        native_intervals={
            "1m": "1m", "3m": "3m", "5m": "5m", "15m": "15m", "30m": "30m",
            "1h": "1H", "2h": "2H", "4h": "4H", "6h": "6Hutc", "12h": "12Hutc",
            "1d": "1Dutc", "3d": "3Dutc", "1w": "1Wutc", "1mo": "1Mutc",
        },
    ),
    "kucoin": Exchange(
        layout=Layout(
            root="$.data",
            min_len=7,
            ohlcv=(1, 3, 4, 2, 5),
            unit_ms=False,
            tail="none",
            success=("$.code", "200000"),
        ),
        catalog=Catalog(
            root="$.data", base="baseCurrency", quote="quoteCurrency", success=("$.code", "200000")
        ),
        limit=1000,
        native_separator="-",
        native_intervals={
            "1m": "1min", "3m": "3min", "5m": "5min", "15m": "15min", "30m": "30min",
            "1h": "1hour", "2h": "2hour", "4h": "4hour", "6h": "6hour", "8h": "8hour",
            "12h": "12hour", "1d": "1day", "1w": "1week", "1mo": "1month",
        },
        drop_live_tail=True,
    ),
    "bingx": Exchange(
        layout=Layout(root="$.data", min_len=8, close=6),
        catalog=Catalog(root="$.data.symbols", joined="symbol", success=("$.code", None)),
        limit=500,
        native_separator="-",
        separator_counts=True,
        native_intervals={**_SAME, "1mo": "1M"},
        drop_live_tail=True,
    ),
}


def interval_codes(spark: SparkSession) -> DataFrame:
    """Supported intervals of every exchange with the exchange's own code."""
    rows = [(n, i, e.native_intervals[i]) for n, e in EXCHANGES.items() for i in e.intervals]
    return spark.createDataFrame(rows, "exchange string, interval string, native string")


# Fields and types of a layout as a row.
_LAYOUT = {
    "root": "string",
    "min_len": "int",
    "open": "int",
    "close": "int",
    "open_price": "int",
    "high": "int",
    "low": "int",
    "close_price": "int",
    "volume": "int",
    "unit_ms": "boolean",
    "newest_first": "boolean",
    "tail": "string",
    "flag": "int",
    "success_path": "string",
    "success_value": "string",
}


def _values(x: Layout) -> tuple:
    return (x.root, x.min_len, x.open, x.close, *x.ohlcv, x.unit_ms, x.newest_first, x.tail, x.flag, *(x.success or (None, None)))


def layout_rows(spark: SparkSession, layouts: Mapping[str, Layout] | None = None) -> DataFrame:
    """Payload layouts as rows (exchange, layout), to which those of other exchanges can be added; all by default."""
    given = {name: e.layout for name, e in EXCHANGES.items()} if layouts is None else layouts
    fields = ", ".join(f"{name}: {kind}" for name, kind in _LAYOUT.items())
    return spark.createDataFrame([(name, _values(x)) for name, x in given.items()], f"exchange string, layout struct<{fields}>")


def layout_of(exchange: str, layouts: Mapping[str, Layout | Mapping]) -> Column:
    """The layout, as a row, of the exchange in a column; null for others."""
    entries = []
    for name, x in layouts.items():
        values = _values(x) if isinstance(x, Layout) else [x[field] for field in _LAYOUT]
        entries += [F.lit(name), F.struct(*(F.lit(v).cast(kind).alias(field) for (field, kind), v in zip(_LAYOUT.items(), values, strict=True)))]
    return F.try_element_at(F.create_map(*entries), F.col(exchange))
