"""Repair of candles in error from a fresh fetch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.dims import EXCHANGES
from candlewick.functions.calendar import interval_seconds
from candlewick.operators.check import check
from candlewick.operators.chunks import SPAN, nearest
from candlewick.operators.merge import last_wins
from candlewick.schema import KLINE_COLUMNS, OK, SERIES
from candlewick.session import staged

BATCH = (*SERIES, "request_start")


def repair_requests(errors: DataFrame) -> DataFrame:
    """Where to fetch from for each error: half an interval before it."""
    half = f"cast(bround({interval_seconds(month_days=31)} / 2) as bigint)"
    return errors.selectExpr(*SERIES, f"open_time - {half} as request_start", "open_time as error_time")


def batch_verdicts(candidates: DataFrame) -> DataFrame:
    """Per fetched batch whether its first two candles are consistent.

    ``candidates`` are candles with ``request_start`` and ``pos``, counted
    from 0 within the batch. One bad pair refuses the whole batch, the
    candles after the pair are not looked at.
    """
    pairs = candidates.groupBy(*BATCH).agg(
        F.expr("max(if(pos = 0, open_time, null)) as first_open"),
        F.expr("max(if(pos = 0, close_time, null)) as first_close"),
        F.expr("max(if(pos = 1, open_time, null)) as second_open"),
    )
    whole = f"first_close - first_open = {interval_seconds(anchor='first_open')}"
    return pairs.selectExpr("*", f"coalesce({whole} and first_close = second_open, false) as accepted")


def accepted_candles(requests: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candles of accepted batches that answer one of ``requests``, one per key:
    batches count in the order of their request, the last one wins."""
    good = (
        batch_verdicts(candidates)
        .where("accepted")
        .join(requests.select(*BATCH), [*BATCH], "left_semi")
        .select(*BATCH)
    )
    rows = candidates.join(good, [*BATCH], "left_semi").select(*KLINE_COLUMNS, "request_start", "pos")
    return last_wins(rows, ["request_start", "pos"])


def full_reply() -> str:
    """Seconds a full reply of the exchange reaches: its row limit times the interval."""
    limits = " ".join(f"when '{name}' then {e.limit}" for name, e in EXCHANGES.items())
    return f"case exchange {limits} end * {interval_seconds(month_days=31)}"


def accepted_from_pool(requests: DataFrame, pool: DataFrame, span: int = SPAN, reach: str | None = "") -> DataFrame:
    """As ``accepted_candles`` for candidates without a request key.

    ``pool`` are candles, one per key. The reply to a request is taken to be
    the pool from the request time on, for ``reach`` seconds: an expression on the
    series, by default as far as a full reply reaches; None for all that follows.
    Only pool candles within reach of a request are looked at: time is cut into
    buckets of that length, of which a request needs two. No request is paired
    with its candles: the head pair is the nearest pool candle at or after the
    request, already judged against its successor, and a candle is taken if the
    last accepted request before it reaches it.
    """
    reach = full_reply() if reach == "" else reach
    within = "true"
    if reach is not None:
        within = f"{{}} < {{}} + {reach}"
        asked = requests.selectExpr(*SERIES, f"explode(sequence(floor(request_start / ({reach})), floor(request_start / ({reach})) + 1)) as bucket")
        near = pool.withColumn("bucket", F.expr(f"floor(open_time / ({reach}))")).join(asked.distinct(), [*SERIES, "bucket"], "left_semi")
        # Read three times below: the pool itself is read, and met with the requests, once.
        pool = staged(near.select(*KLINE_COLUMNS), "pool")
    heads = check(pool, span=span).selectExpr(
        *SERIES,
        "open_time",
        "1 as kind",
        f"struct(close_time, checked = '{OK}' and next_open is not null as good) as head",
    )
    # A probe sorts before a candle of the same time, so that candle is "at or after" it.
    probes = requests.selectExpr(*SERIES, "request_start as open_time", "0 as kind")
    probed = nearest(
        heads.unionByName(probes, allowMissingColumns=True), "head", "found", "kind", later=True, span=span
    )
    # One row per accepted request, read twice below; written so that it is worked out once.
    marks = staged(
        probed.where(f"kind = 0 and found.good and {within.format('found.close_time', 'open_time')}").select(
            *SERIES, "open_time", "kind"
        ),
        "accepted",
    )
    rows = pool.selectExpr(*KLINE_COLUMNS, "1 as kind").unionByName(marks, allowMissingColumns=True)
    covered = nearest(rows, "if(kind = 0, open_time, null)", "start", "kind", span=span)
    return covered.where(f"kind = 1 and start is not null and {within.format('open_time', 'start')}").select(*KLINE_COLUMNS)


def recheck_start(as_of: int, last_n: int) -> str:
    """Start of a look-back over the last ``last_n`` intervals, for ``check``."""
    return f"abs({as_of} - {last_n} * {interval_seconds()})"
