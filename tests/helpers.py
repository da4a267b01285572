"""Hand-made candles and plain-Python versions of the checks."""

from __future__ import annotations

import calendar
import datetime
import random

from candlewick.schema import ERROR, KLINE, OK, UNCHECKED

LENGTH = {"1m": 60, "1h": 3600, "1d": 86400, "1w": 604800}


def epoch(*date: int) -> int:
    return int(datetime.datetime(*date, tzinfo=datetime.timezone.utc).timestamp())


def length(interval: str, open_time: int) -> int:
    if interval != "1mo":
        return LENGTH[interval]
    day = datetime.datetime.fromtimestamp(open_time, datetime.timezone.utc)
    return 86400 * calendar.monthrange(day.year, day.month)[1]


def candle(open_time, close_time=None, symbol="A/USD", interval="1h", status=UNCHECKED, exchange="binance", price="1.5", volume="10"):
    close_time = open_time + length(interval, open_time) if close_time is None else close_time
    return (exchange, "SPOT", symbol, interval, open_time, price, close_time, price, price, price, volume, status)


def frame(spark, rows):
    return spark.createDataFrame(rows, KLINE)


def random_series(seed: int, symbols: int, interval: str = "1h", candles: int = 60) -> list[tuple]:
    """Series with gaps, wrong lengths, overlaps and stored statuses of all kinds."""
    draw = random.Random(seed)
    rows = []
    for n in range(symbols):
        t = draw.randrange(0, 10**9) // 3600 * 3600
        for _ in range(draw.randrange(1, candles)):
            step = length(interval, t)
            close = t + step + draw.choice([0] * 8 + [-60, 60])
            status = draw.choice([OK, OK, OK, ERROR, UNCHECKED])
            rows.append(candle(t, close, f"S{n}/USD", interval, status, volume=str(draw.randrange(1000))))
            t = draw.choice([close] * 6 + [t + step] * 3 + [t + 3 * step, t + draw.randrange(1, 400) * step])
    draw.shuffle(rows)
    return rows


def by_series(rows) -> dict[tuple, list[tuple]]:
    found: dict[tuple, list[tuple]] = {}
    for row in sorted(rows, key=lambda r: r[4]):
        found.setdefault(row[:4], []).append(row)
    return found


def plain_check(rows, start_from=0) -> dict[tuple, tuple]:
    """(series, open_time) to (next open, verdict), one candle after the other."""
    verdicts = {}
    for series, candles in by_series(rows).items():
        if start_from > 0:
            if start_from >= candles[-1][4]:
                continue
            back = 31 * 86400 if series[3] == "1mo" else LENGTH[series[3]]
            candles = [c for c in candles if c[4] >= max(start_from - 5 * back, 0)]
        for i, c in enumerate(candles):
            if i == len(candles) - 1:
                verdicts[(*series, c[4])] = (None, c[11])
                continue
            after = candles[i + 1][4]
            good = c[6] == after and c[6] - c[4] == length(series[3], c[4])
            verdicts[(*series, c[4])] = (after, OK if good else ERROR)
    return verdicts


def plain_streams(rows) -> dict[tuple, int]:
    numbers = {}
    for series, candles in by_series(rows).items():
        number, before = -1, None
        for c in candles:
            if c[11] == OK:
                number += before != OK
                numbers[(*series, c[4])] = number
            before = c[11]
    return numbers
