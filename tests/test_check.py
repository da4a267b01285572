from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pytest
from helpers import candle, epoch, frame, plain_check, plain_streams, random_series

from candlewick.operators import check as checks
from candlewick.operators.chunks import SPAN
from candlewick.operators.streams import consistent_streams, map_streams, map_whole_streams, nested_streams
from candlewick.schema import ERROR, KEY, OK, UNCHECKED


def verdicts(df):
    return {tuple(r[c] for c in KEY): (r.next_open, r.checked) for r in df.collect()}


@pytest.mark.parametrize("span", [SPAN, 7200, 100_000])
@pytest.mark.parametrize("interval", ["1h", "1d", "1mo"])
def test_check_like_a_loop(spark, interval, span):
    rows = random_series(1, 60, interval)
    assert verdicts(checks.check(frame(spark, rows), span=span)) == plain_check(rows)


@pytest.mark.parametrize("interval", ["1h", "1mo"])
def test_check_from(spark, interval):
    rows = random_series(2, 60, interval)
    start = 500_000_000
    found = verdicts(checks.check(frame(spark, rows), start, span=50_000))
    assert found == plain_check(rows, start)
    assert verdicts(checks.check(frame(spark, rows), f"{start} + 0 * length(interval)")) == found


@pytest.mark.parametrize("span", [SPAN, 7200, 100_000])
def test_streams_like_a_loop(spark, span):
    rows = random_series(3, 60)
    found = consistent_streams(frame(spark, rows), span)
    assert {tuple(r[c] for c in KEY): r.stream_no for r in found.collect()} == plain_streams(rows)


def test_streams_on_kept_chunks(spark):
    rows = random_series(4, 40)
    checked = checks.check(frame(spark, rows), span=20_000)
    kept = consistent_streams(checks.with_verdict(checked, keep_chunk=True), 20_000)
    plain = consistent_streams(checks.with_verdict(checked))
    assert sorted(kept.collect()) == sorted(plain.collect())


def test_months(spark):
    starts = [epoch(2023, m, 1) for m in range(1, 13)] + [epoch(2024, m, 1) for m in (1, 2, 3)]
    rows = [candle(t, interval="1mo") for t in starts]
    found = verdicts(checks.check(frame(spark, rows)))
    assert [found[r[:5]][1] for r in rows] == [OK] * 14 + [UNCHECKED]
    # 30 days for every month: right for the four months of that length only.
    rows = [candle(t, t + 30 * 86400, interval="1mo") for t in starts]
    good = [r[4] for r in rows if verdicts(checks.check(frame(spark, rows)))[r[:5]][1] == OK]
    assert good == [epoch(2023, m, 1) for m in (4, 6, 9, 11)]


def test_errors_and_summary(spark):
    t = epoch(2024, 1, 1)
    rows = [
        candle(t),
        candle(t + 3600, t + 7140),  # too short
        candle(t + 7200),  # gap after it
        candle(t + 14400, status=ERROR),  # last: keeps its status and is reported again
        candle(t, symbol="ONE/USD"),
    ]
    checked = checks.check(frame(spark, rows))
    found = {r.open_time: r for r in checks.errors(checked).collect()}
    assert set(found) == {t + 3600, t + 7200, t + 14400}
    assert (found[t + 3600].diff_open_close, found[t + 3600].diff_data) == (3540, 3600)
    assert (found[t + 7200].diff_open_close, found[t + 7200].diff_data) == (3600, 7200)
    assert found[t + 14400].diff_data is None
    assert found[t + 3600].open_date == "2024-01-01 01:00:00"
    assert found[t + 3600].close_date == "2024-01-01 01:59:00"
    totals = {r.symbol: (r.result_counter, r.last_open_time_check) for r in checks.summary(checked).collect()}
    assert totals == {"A/USD": (3, t + 14400), "ONE/USD": (0, t)}
    changes = {(r.symbol, r.open_time): (r.old_status, r.status) for r in checks.status_changes(checked).collect()}
    assert changes == {
        ("A/USD", t): (UNCHECKED, OK),
        ("A/USD", t + 3600): (UNCHECKED, ERROR),
        ("A/USD", t + 7200): (UNCHECKED, ERROR),
    }


def test_nested_and_mapped_streams(spark):
    rows = random_series(5, 20)
    streams = consistent_streams(frame(spark, rows))
    nested = nested_streams(streams, segment=20_000)
    flat = {
        (*(r[c] for c in KEY[:4]), c.open_time): r.stream_no for r in nested.collect() for c in r.candles
    }
    assert flat == plain_streams(rows)
    for r in nested.collect():
        times = [c.open_time for c in r.candles]
        assert times == sorted(times)
        assert {t // 20_000 for t in times} == {r.segment_no}

    def count(candles):
        first = candles[["symbol", "stream_no"]].iloc[:1]
        return first.assign(n=len(candles), ordered=candles["open_time"].is_monotonic_increasing)

    mapped = map_streams(streams, count, "symbol string, stream_no long, n long, ordered boolean", segment=20_000)
    assert sum(r.n for r in mapped.collect()) == len(flat)
    assert all(r.ordered for r in mapped.collect())


def test_whole_streams_come_batch_by_batch(spark):
    rows = random_series(5, 40)
    flat = consistent_streams(frame(spark, rows))

    def count(batches):
        seen, no, last = 0, 0, -1
        for batch in batches:
            times = batch.column("open_time").to_pylist()
            assert times == sorted(times) and times[0] > last
            seen, no, last = seen + len(times), no + 1, times[-1]
            key = [batch.column(c)[:1] for c in (*KEY[:4], "stream_no")]
            yield pa.RecordBatch.from_arrays([*key, pa.array([no]), pa.array([len(times)]), pa.array([seen])], names=names)

    names = [*KEY[:4], "stream_no", "batch", "n", "seen"]
    schema = ", ".join(f"{c} string" for c in KEY[:4]) + ", stream_no long, batch long, n long, seen long"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        found = map_whole_streams(flat, count, schema).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    sizes = Counter((*k[:4], no) for k, no in plain_streams(rows).items())
    assert max(r.n for r in found) <= 3 and max(r.batch for r in found) > 1
    assert {tuple(r[:5]): max(q.seen for q in found if q[:5] == r[:5]) for r in found} == sizes
