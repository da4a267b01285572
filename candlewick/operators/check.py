"""Consistency check: is each candle one interval long and does the next one touch it?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.calendar import interval_seconds, part_of, time_text
from candlewick.operators.chunks import SPAN, with_next_open
from candlewick.schema import ERROR, KEY, OK, SERIES

# A check from a given time starts this many intervals earlier.
LOOK_BACK = 5


def check(candles: DataFrame, start_from: int | str = 0, span: int = SPAN) -> DataFrame:
    """The verdict on every candle.

    ``checked`` is OK if the candle lasts one interval (a month its own
    calendar length) and closes when the next one opens, else ERROR. The last
    candle of a series keeps its stored status. ``start_from`` (a number, or
    expression text on the series) limits the check to candles from five
    intervals before it; a series that ends at or before it is not checked.
    """
    limited = isinstance(start_from, str) or start_from > 0
    columns = [c for c in candles.columns if c != "chunk"]
    if limited:
        earliest = f"greatest({start_from} - {LOOK_BACK} * {interval_seconds(month_days=31)}, 0)"
        candles = candles.where(f"open_time >= {earliest}")
        if "part" in candles.columns:
            # Uses partition columns only, so whole folders are skipped.
            candles = candles.where(f"part >= {part_of('interval', earliest)}")
    linked = with_next_open(candles, span)
    if limited:
        linked = linked.where(f"{start_from} < series_last")
    good = f"close_time = next_open and close_time - open_time = {interval_seconds(anchor='open_time')}"
    return linked.selectExpr(
        "chunk",
        *columns,
        "next_open",
        f"case when next_open is null then status when {good} then '{OK}' else '{ERROR}' end as checked",
    )


def errors(checked: DataFrame) -> DataFrame:
    """One record per candle found in error."""
    return checked.where(F.col("checked") == ERROR).selectExpr(
        *KEY,
        f"{time_text('open_time')} as open_date",
        "close_time",
        f"{time_text('close_time')} as close_date",
        "checked as status",
        "close_time - open_time as diff_open_close",
        "next_open - open_time as diff_data",
    )


def summary(checked: DataFrame) -> DataFrame:
    """Per series: number of errors and the last candle looked at."""
    return checked.groupBy(*SERIES).agg(
        F.expr(f"count_if(checked = '{ERROR}') as result_counter"),
        F.expr("max(open_time) as last_open_time_check"),
    )


def status_changes(checked: DataFrame) -> DataFrame:
    """Keys whose stored status differs from the verdict, with the new status."""
    return checked.where("not (checked <=> status)").selectExpr(*KEY, "status as old_status", "checked as status")


def with_verdict(checked: DataFrame, keep_chunk: bool = False) -> DataFrame:
    """The candles with the verdict as their status.

    ``keep_chunk`` leaves the chunk column in, so that ``consistent_streams``
    with the same span works on the same partitioning without a new shuffle.
    """
    helpers = {"status", "checked", "next_open"} | (set() if keep_chunk else {"chunk"})
    return checked.selectExpr(*[c for c in checked.columns if c not in helpers], "checked as status")
