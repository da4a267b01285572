"""Consistency verdicts on a stream of candles, as successors arrive, and again when a late candle changes them.

The state is Spark's own (``transformWithState`` on RocksDB): per series the newest candles, cut into spans of time, so that a batch
reads and writes only the spans its candles fall in and their neighbours. A candle may come at any place among the kept ones:
it gets its verdict, and the candle before it a new one. Each verdict says at which ``turn`` of its series it was given; of the
verdicts on a candle the one of the last turn holds. Candles before all kept ones are set aside as ``late`` for the next batch check.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from candlewick.functions.calendar import interval_seconds
from candlewick.operators.merge import last_wins
from candlewick.schema import ERROR, KEY, KLINE, OK, SERIES

VERDICT_COLUMNS = (*KEY, "close_time", "next_open", "checked")
LINKED = T.StructType(
    [
        *(f for f in KLINE if f.name in KEY),
        T.StructField("close_time", T.LongType()),
        T.StructField("next_open", T.LongType()),
        T.StructField("turn", T.LongType()),
    ]
)
JUDGED = T.StructType([*LINKED.fields, T.StructField("checked", T.StringType()), T.StructField("kind", T.StringType())])

# Newest candles kept per series, the span of a recheck, and the seconds of a span of them.
KEEP = 7200
WIDTH = 1 << 16

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Successors(StatefulProcessor):
    """Emits a candle with the open time of its successor whenever that becomes known or changes.

    State per series: ``spans`` holds open and close times in order by number of the span, ``known`` which spans
    there are with the first open time and the candles of each, the turns so far, and whether older spans have been dropped.
    """

    def __init__(self, keep: int, width: int):
        self._keep, self._width = keep, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._spans = handle.getMapState("spans", "span long", "opens array<long>, closes array<long>")
        self._known = handle.getValueState("known", "turn long, dropped boolean, numbers array<long>, firsts array<long>, sizes array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        yield self._take(key, pd.concat(rows))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._take(key, initialState.assign(seq=0))

    def _take(self, key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["open_time", "seq"]).drop_duplicates("open_time", keep="last")
        opens, closes = (rows[c].to_numpy(np.int64) for c in ("open_time", "close_time"))
        turn, dropped, *lists = self._known.get() or (0, False, [], [], [])
        numbers, firsts, sizes = (np.array(x, np.int64) for x in lists)
        late = opens < firsts[0] if dropped else np.zeros(len(opens), bool)
        fresh, ends = opens[~late], closes[~late]
        touched = np.unique(fresh // self._width)
        # The spans beside a touched one hold the candles before and after its own.
        place = np.searchsorted(numbers, touched)
        beside = np.concatenate([place - 1, place, place + 1])
        near = numbers[np.unique(beside[(beside >= 0) & (beside < len(numbers))])]
        held = [self._spans.getValue((int(n),)) for n in near]
        all_opens = np.concatenate([fresh, *(np.array(h[0], np.int64) for h in held)])
        all_closes = np.concatenate([ends, *(np.array(h[1], np.int64) for h in held)])
        # A new candle comes first, and takes the place of the old one.
        all_opens, first = np.unique(all_opens, return_index=True)
        all_closes = all_closes[first]

        at = np.searchsorted(all_opens, fresh)
        told = np.unique(np.concatenate([at, at - 1]))
        told = told[(told >= 0) & (told + 1 < len(all_opens))]
        linked = pd.DataFrame({"open_time": all_opens[told], "close_time": all_closes[told], "next_open": pd.array(all_opens[told + 1], "Int64")})
        aside = pd.DataFrame({"open_time": opens[late], "close_time": closes[late], "next_open": pd.array([pd.NA] * int(late.sum()), "Int64")})

        table = {int(n): (int(f), int(s)) for n, f, s in zip(numbers, firsts, sizes, strict=True)}
        for number in touched:
            mine = slice(*np.searchsorted(all_opens, [number * self._width, (number + 1) * self._width]))
            self._spans.updateValue((int(number),), (all_opens[mine].tolist(), all_closes[mine].tolist()))
            table[int(number)] = int(all_opens[mine][0]), mine.stop - mine.start
        order, total = sorted(table), sum(size for _, size in table.values())
        while len(order) > 1 and total - table[order[0]][1] >= self._keep:
            oldest = order.pop(0)
            total -= table.pop(oldest)[1]
            self._spans.removeKey((oldest,))
            dropped = True
        self._known.update((turn + 1, dropped, order, [table[n][0] for n in order], [table[n][1] for n in order]))
        out = pd.concat([linked, aside], ignore_index=True)
        for name, value in zip(SERIES, key, strict=True):
            out[name] = value
        return out.assign(turn=turn)[LINKED.fieldNames()]


def judge(linked: DataFrame) -> DataFrame:
    """The verdict on candles whose successor is known, as a batch check gives it."""
    good = f"close_time = next_open and close_time - open_time = {interval_seconds(anchor='open_time')}"
    return linked.selectExpr(
        "*", f"case when next_open is not null then if({good}, '{OK}', '{ERROR}') end as checked", "if(next_open is null, 'late', 'verdict') as kind"
    )


def watch(
    candles: DataFrame, root: str, checkpoint: str, seed: DataFrame | None = None, keep: int = KEEP, width: int = WIDTH, **trigger
) -> StreamingQuery:
    """Judge each candle of a stream (with ``seq``, of which the last counts) once its successor is known, and again when that changes.

    Verdicts are appended below ``root/judged``; ``verdicts`` reads those that hold. ``keep`` newest candles of a series can be revised (more, to whole spans of
    ``width`` seconds). A correction of a kept candle replaces it. ``seed`` gives stored candles to start from, say the newest of each series. Spark's
    checkpoint holds the state, and its file sink counts a batch once, however often it is run.
    """
    spark = candles.sparkSession
    spark.conf.set(_STORE, _ROCKSDB)
    rows = candles.select(*KEY, "close_time", "seq").groupBy(*SERIES)
    start = None if seed is None else seed.select(*KEY, "close_time").groupBy(*SERIES)
    linked = rows.transformWithStateInPandas(Successors(keep, width), LINKED, "Append", "None", initialState=start)
    return (
        judge(linked)
        .writeStream.format("parquet")
        .option("path", f"{root}/judged")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def judged(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """All rows of a kind written so far."""
    return spark.read.schema(JUDGED).parquet(f"{root}/judged").where(F.col("kind") == kind)


def verdicts(spark: SparkSession, root: str) -> DataFrame:
    """The verdict that holds on each candle."""
    given = judged(spark, root, "verdict").select(*VERDICT_COLUMNS, "turn")
    return last_wins(given, ["turn"]).select(*VERDICT_COLUMNS)


def revised(spark: SparkSession, root: str) -> DataFrame:
    """Candles whose verdict isn't the one first given, with both."""
    given = judged(spark, root, "verdict").groupBy(*KEY)
    ends = given.agg(*[F.expr(f"{pick}(struct(close_time, next_open, checked), turn) as {name}") for pick, name in (("min_by", "first"), ("max_by", "last"))])
    return ends.where("first <> last").selectExpr(
        *KEY, "last.close_time", "first.next_open as first_next_open", "last.next_open", "first.checked as first_checked", "last.checked"
    )
