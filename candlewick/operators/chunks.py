"""Windows over a series that never put a whole series into one task.

One series may hold a large part of the table, so rows are grouped by
(series, chunk), a chunk being a fixed span of time. ``open_time`` is unique
within a series and counts seconds, so a chunk holds at most ``span`` rows
and a series has at most (time range / span) chunks: both levels stay small.
What a chunk needs to know about its neighbours comes from one summary row
per chunk, aggregated map-side and joined back on the same partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.schema import SERIES

# About 97 days: 139,810 one-minute candles; 2^32 seconds make 512 chunks.
SPAN = 1 << 23

CHUNK = (*SERIES, "chunk")
_SERIES, _CHUNK = ", ".join(SERIES), ", ".join(CHUNK)

# Windows: the rows of a chunk in time order, and the chunk summaries of a series.
IN_CHUNK = f"partition by {_CHUNK} order by open_time"
ACROSS_CHUNKS = f"partition by {_SERIES} order by chunk"
RUNNING = "rows between unbounded preceding and current row"
BEFORE = "rows between unbounded preceding and 1 preceding"


def with_chunk(rows: DataFrame, span: int = SPAN) -> DataFrame:
    if "chunk" in rows.columns:
        return rows
    return rows.selectExpr("*", f"cast(floor(open_time / {span}) as bigint) as chunk")


def with_next_open(candles: DataFrame, span: int = SPAN) -> DataFrame:
    """Add ``next_open`` (open time of the next candle of the series, null on the
    last one) and ``series_last`` (open time of that last candle)."""
    edges = (
        with_chunk(candles.select(*SERIES, "open_time"), span)
        .groupBy(*CHUNK)
        .agg(F.expr("min(open_time) as head"), F.expr("max(open_time) as tail"))
        .selectExpr(
            *CHUNK,
            f"lead(head) over ({ACROSS_CHUNKS}) as next_head",
            f"max(tail) over (partition by {_SERIES}) as series_last",
        )
    )
    return (
        with_chunk(candles, span)
        .selectExpr("*", f"lead(open_time) over ({IN_CHUNK}) as next_here")
        .join(edges, [*CHUNK])
        .selectExpr(
            *CHUNK,
            *[c for c in candles.columns if c not in CHUNK],
            "coalesce(next_here, next_head) as next_open",
            "series_last",
        )
    )


def nearest(rows: DataFrame, value: str, name: str, tie: str, later: bool = False, span: int = SPAN) -> DataFrame:
    """Add ``name``: the last non-null ``value`` at or before the row in its series,
    in the order of ``open_time`` and ``tie``; with ``later`` the first at or after it.
    """
    turn, edge = ("desc", "min_by") if later else ("asc", "max_by")
    chunked = with_chunk(rows, span).selectExpr("*", f"{value} as _value")
    edges = (
        chunked.groupBy(*CHUNK)
        .agg(F.expr(f"{edge}(_value, if(_value is null, null, struct(open_time, {tie}))) as _edge"))
        .selectExpr(
            *CHUNK,
            f"last(_edge, true) over (partition by {_SERIES} order by chunk {turn} {BEFORE}) as _edge",
        )
    )
    order = f"partition by {_CHUNK} order by open_time {turn}, {tie} {turn}"
    return (
        chunked.selectExpr("*", f"last(_value, true) over ({order} {RUNNING}) as _here")
        .join(edges, [*CHUNK])
        .selectExpr(*rows.columns, f"coalesce(_here, _edge) as {name}")
    )
