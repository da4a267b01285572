"""Consistent streams: runs of consecutive OK candles."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.operators.chunks import ACROSS_CHUNKS, BEFORE, CHUNK, IN_CHUNK, RUNNING, SPAN, with_chunk
from candlewick.schema import OK, SERIES

# Widest nested row: at most 2^20 candles, 17,477 at one per minute.
SEGMENT = 1 << 20


def consistent_streams(candles: DataFrame, span: int = SPAN) -> DataFrame:
    """OK candles with the number of their stream, counted from 0 per series.

    A candle that is not OK is left out and ends its stream.
    """

    def numbered(rows: DataFrame) -> DataFrame:
        """Add ``local_no``: streams begun in the chunk up to and including the row."""
        begins = f"cast(ok and not lag(ok, 1, false) over ({IN_CHUNK}) as bigint)"
        return (
            with_chunk(rows, span)
            .selectExpr("*", f"status <=> '{OK}' as ok")
            .selectExpr("*", f"{begins} as begins")
            .selectExpr("*", f"sum(begins) over ({IN_CHUNK} {RUNNING}) as local_no")
        )

    columns = [c for c in candles.columns if c != "chunk"]
    narrow = [c for c in candles.columns if c in (*CHUNK, "open_time", "status")]
    # Per chunk: streams begun before it. A stream that runs over the chunk's
    # edge was counted on both sides, so it is taken off once.
    offsets = (
        numbered(candles.select(*narrow))
        .groupBy(*CHUNK)
        .agg(
            F.expr("sum(begins) as begun"),
            F.expr("min_by(ok, open_time) as first_ok"),
            F.expr("max_by(ok, open_time) as last_ok"),
        )
        .selectExpr(
            *CHUNK,
            "begun",
            f"cast(first_ok and lag(last_ok, 1, false) over ({ACROSS_CHUNKS}) as bigint) as joined",
        )
        .selectExpr(
            *CHUNK,
            f"coalesce(sum(begun - joined) over ({ACROSS_CHUNKS} {BEFORE}), 0) - joined - 1 as offset",
        )
    )
    return (
        numbered(candles)
        .where("ok")
        .join(offsets, [*CHUNK])
        .selectExpr(*columns, "offset + local_no as stream_no")
    )


def in_segments(streams: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Add ``segment_no``. A stream may be as long as its series, so it is cut at
    fixed times: segments of ``segment`` seconds bound the rows of a group."""
    return streams.selectExpr("*", f"cast(floor(open_time / {segment}) as bigint) as segment_no")


def map_streams(
    streams: DataFrame,
    work: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    segment: int = SEGMENT,
    overlap: int = 0,
) -> DataFrame:
    """Run ``work`` on the candles of each stream segment, as a pandas frame in time order.

    A stream may be as long as its series, so ``work`` gets it in segments of ``segment`` seconds, not whole:
    ``stream_no`` and ``segment_no`` say which. So that values that look back are right at a cut, the frame begins with the stream's
    candles of the ``overlap`` seconds before the segment, for which ``carried`` is true; rows for these belong to the segment
    before and are for ``work`` to leave out.
    """
    own = f"floor(open_time / {segment})"
    cut = streams.selectExpr("*", f"explode(sequence({own}, floor((open_time + {overlap}) / {segment}))) as segment_no")
    rows = cut.selectExpr("* except (segment_no)", "cast(segment_no as bigint) as segment_no", f"segment_no > {own} as carried")

    def ordered(candles: pd.DataFrame) -> pd.DataFrame:
        # A segment with no candle of its own is not the stream's any more.
        return work((candles.iloc[:0] if candles.carried.all() else candles).sort_values("open_time", ignore_index=True))

    return rows.groupBy(*SERIES, "stream_no", "segment_no").applyInPandas(ordered, schema)


def map_whole_streams(streams: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Run ``work`` on each whole stream, handed over in time order as an iterator of Arrow batches.

    For values that depend on all of a stream before them: ``work`` is a generator that carries what it needs from batch to batch and
    yields its rows as it goes. A stream is one after the other by nature, so it is one task's, but never in its memory: what is held is a
    batch (``spark.sql.execution.arrow.maxRecordsPerBatch`` rows) and what ``work`` keeps. The sort that puts the streams
    together is that of their candles as well, and spills.
    """

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = -math.inf
        for batch in batches:
            times = batch.column("open_time").to_numpy()
            if len(times) and (times[0] < last or (times[1:] < times[:-1]).any()):
                raise ValueError("candles of a stream are not in time order")
            last = times[-1] if len(times) else last
            yield batch.select(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(in_order(batches))

    columns = streams.columns
    run.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    # One key: constant columns, which a sort by several leaves out, would make grouping sort again, by the keys alone.
    rows = streams.withColumn("_stream", F.struct(*SERIES, "stream_no"))
    rows = rows.repartition("_stream").sortWithinPartitions("_stream", "open_time")
    return rows.groupBy("_stream").applyInArrow(run, schema)


def nested_streams(streams: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Streams as arrays of candles in time order, one row per stream and segment."""
    inner = [c for c in streams.columns if c not in (*SERIES, "stream_no", "open_time")]
    return (
        in_segments(streams, segment)
        .groupBy(*SERIES, "stream_no", "segment_no")
        .agg(F.expr(f"array_sort(collect_list(struct(open_time, {', '.join(inner)}))) as candles"))
    )
