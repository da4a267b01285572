"""Reads: time range, typed columns, status filters."""

from __future__ import annotations

from pyspark.sql import DataFrame

from candlewick.functions.calendar import part_of
from candlewick.schema import OK, PRICES, SERIES, UNCHECKED


def in_range(candles: DataFrame, start_from: int = 0, until_to: int | None = None) -> DataFrame:
    """Candles that open at or after ``start_from`` and close at or before ``until_to``.

    Where the rows carry the ``part`` partition column its bounds are added,
    so folders out of range are not read.
    """
    if not isinstance(start_from, int) or not isinstance(until_to, (int, type(None))):
        raise ValueError("start_from and until_to count epoch seconds")
    conditions = [f"open_time >= {start_from}"]
    if until_to is not None:
        conditions.append(f"close_time <= {until_to}")
    if "part" in candles.columns:
        conditions.append(f"part >= {part_of('interval', str(start_from))}")
        if until_to is not None:
            # A stored candle never closes before it opens, see store.writable.
            conditions.append(f"part <= {part_of('interval', str(until_to))}")
    return candles.where(" and ".join(conditions))


def typed(candles: DataFrame, lenient: bool = False) -> DataFrame:
    """Read columns in fixed order with prices as numbers.

    Text that is not a number fails the read, or reads as null if ``lenient``.
    """
    cast = "try_cast" if lenient else "cast"
    extra = [c for c in ("stream_no",) if c in candles.columns]
    return candles.selectExpr(
        *SERIES, "open_time", "close_time", *[f"{cast}({c} as double) as {c}" for c in PRICES], "status", *extra
    )


def unchecked(candles: DataFrame) -> DataFrame:
    return candles.where(f"status = '{UNCHECKED}'")


def not_ok(candles: DataFrame) -> DataFrame:
    """Candles with a status other than OK; a missing status is no status."""
    return candles.where(f"status <> '{OK}'")
