"""Per-series aggregates: extent, high-water marks, first listing, staleness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.dims import EXCHANGES
from candlewick.functions.calendar import date_of, epoch_of, interval_seconds, month_start, next_month
from candlewick.schema import ERROR, OK, SERIES, UNCHECKED


# Of each figure: how it comes from candles, and how those of two groups of candles are put together.
_FIGURES = {
    "first_open": ("min(open_time)", "min"),
    "last_open": ("max(open_time)", "max"),
    "last_close": ("max(close_time)", "max"),
    "first_unchecked": (f"min(if(status = '{UNCHECKED}', open_time, null))", "min"),
    "last_not_ok": (f"max(if(status <> '{OK}', open_time, null))", "max"),
    "n_candles": ("count(*)", "sum"),
    "n_errors": (f"count_if(status = '{ERROR}')", "sum"),
}


def extents(candles: DataFrame, by: Sequence[str]) -> DataFrame:
    """The figures of every group of candles in one pass."""
    return candles.groupBy(*by).agg(*[F.expr(f"{e} as {name}") for name, (e, _) in _FIGURES.items()])


def together(kept: DataFrame) -> DataFrame:
    """The profile of every series out of the extents of its parts."""
    return _profile(kept.groupBy(*SERIES).agg(*[F.expr(f"{add}({name}) as {name}") for name, (_, add) in _FIGURES.items()]))


def series_profile(candles: DataFrame) -> DataFrame:
    """All extent figures of every series in one pass."""
    return _profile(extents(candles, SERIES))


def _profile(figures: DataFrame) -> DataFrame:
    return figures.selectExpr(
        *SERIES,
        "first_open",
        "last_open",
        "last_close",
        "coalesce(first_unchecked, 0) as min_unchecked",
        # The newest candle that is not OK, else the oldest candle.
        "coalesce(last_not_ok, first_open) as min_valid",
        "n_candles",
        "n_errors",
    )


def for_requests(requests: DataFrame, profile: DataFrame) -> DataFrame:
    """The profile of each requested series, 0 where nothing is stored."""
    figures = [c for c in profile.columns if c not in SERIES]
    return requests.join(profile, [*SERIES], "left").fillna(0, figures)


def first_listed(profile: DataFrame, as_of: int) -> DataFrame:
    """First month of a series: that of its first candle, or the month after on
    exchanges whose first month is taken as incomplete.

    A series without candles gets the exchange's earliest month, or the month of ``as_of``.
    """
    own = {name: e.first_year_month for name, e in EXCHANGES.items() if e.first_year_month}
    names = ", ".join(f"'{name}'" for name in own)
    earliest = " ".join(f"when '{name}' then make_date({y}, {m}, 1)" for name, (y, m) in own.items())
    first = date_of("first_open")
    month = (
        f"case when first_open > 0 then if(exchange in ({names}), {month_start(first)}, {next_month(first)}) "
        f"else case exchange {earliest} else {month_start(date_of(str(as_of)))} end end"
    )
    return (
        profile.selectExpr("*", f"{month} as _first")
        .selectExpr(
            "*",
            "year(_first) as first_year",
            "month(_first) as first_month",
            f"{epoch_of('_first')} as first_month_time",
        )
        .drop("_first")
    )


def with_high_water(listed: DataFrame) -> DataFrame:
    """Add ``high_water``: the last close, or the first-listed month without candles."""
    return listed.selectExpr("*", "if(last_close > 0, last_close, first_month_time) as high_water")


def with_staleness(profile: DataFrame, as_of: int, mark: str = "last_close") -> DataFrame:
    """Add ``stale``: more than two intervals and a second behind ``as_of``."""
    return profile.selectExpr("*", f"{mark} < {as_of} - (2 * {interval_seconds()} + 1) as stale")


def series_exists(requests: DataFrame, candles: DataFrame) -> DataFrame:
    """Requested series with whether any candle of them is stored."""
    present = candles.select(*SERIES).distinct().selectExpr("*", "true as stored")
    return requests.join(present, [*SERIES], "left").selectExpr(
        *requests.columns, "coalesce(stored, false) as present"
    )
