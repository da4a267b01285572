from __future__ import annotations

import hashlib
import zipfile

from helpers import epoch

from candlewick.plans.backfill import backfill_plan
from candlewick.plans.manifest import archive_manifest
from candlewick.sources import archives, live
from candlewick.schema import LIVE

T = epoch(2024, 1, 1)


def put(folder, name, lines, checksum="right"):
    path = folder / name
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(name.replace(".zip", ".csv"), "\n".join(lines) + "\n")
        z.writestr("zz.csv", "second member, not read")
    digest = hashlib.sha256(path.read_bytes()).hexdigest()
    if checksum:
        text = digest if checksum == "right" else "0" * 64
        (folder / (name + ".CHECKSUM")).write_text(f"{text}  {name}\n")


def line(t, unit=1000, volume="7"):
    return f"{t * unit},1.10,4,0.5,2,{volume},{(t + 3600) * unit - 1},0,1,0,0,0"


def test_archives_from_files(spark, tmp_path):
    folder = tmp_path / "deep" / "er"
    folder.mkdir(parents=True)
    put(folder, "BTCUSDT-1h-2024-01.zip", [line(T), line(T + 3600)])
    put(folder, "BTCUSDT-1h-2024-02-01.zip", ["open_time,open,high,low", line(T + 7200, 1_000_000), ""])
    put(folder, "XY-1h-2024-01.zip", [line(T)])
    put(folder, "BTCUSDT-1h-2023-01.zip", [line(T - 7200)], checksum="wrong")
    put(folder, "BTCUSDT-1h-2023-02.zip", [line(T - 3600)], checksum=None)
    symbols = spark.createDataFrame([("BTCUSDT", "BTC/USDT")], "native_symbol string, symbol string")
    found = archives.archive_candles(archives.verified(*archives.landed_files(spark, str(tmp_path))), symbols).collect()
    assert sorted((r.symbol, r.interval, r.open_time, r.close_time) for r in found) == [
        ("BTC/USDT", "1h", T, T + 3600),
        ("BTC/USDT", "1h", T + 3600, T + 7200),
        ("BTC/USDT", "1h", T + 7200, T + 10800),
        ("XY", "1h", T, T + 3600),
    ]
    assert {(r.open_price, r.high, r.low, r.close_price) for r in found} == {("1.10", "4", "0.5", "2")}


def test_long_archive_keeps_every_line(spark, tmp_path):
    n = 60_017
    put(tmp_path, "A-1m-2024-01.zip", [line(T + i * 60, volume=str(i)) for i in range(n)])
    symbols = spark.createDataFrame([], "native_symbol string, symbol string")
    found = archives.archive_candles(archives.verified(*archives.landed_files(spark, str(tmp_path))), symbols)
    row = found.selectExpr("count(*) as n", "count(distinct pos) as p", "sum(cast(volume as long)) as s", "max(pos) as m").first()
    assert tuple(row) == (n, n, n * (n - 1) // 2, n - 1)


def manifest(spark, as_of, interval="1h", last_open=0, first=epoch(2024, 1, 1), available=None, force_daily=False, exchange="binance"):
    requests = spark.createDataFrame(
        [(exchange, "SPOT", "A/B", interval, last_open, first)],
        "exchange string, trading_type string, symbol string, interval string, last_open long, first_month_time long",
    )
    if available is not None:
        available = spark.createDataFrame([(f,) for f in available], "file string")
    return sorted(r.file for r in archive_manifest(requests, as_of, available, force_daily).collect())


def test_manifest_months(spark):
    files = manifest(spark, epoch(2024, 4, 10), interval="1w")
    assert files == ["AB-1w-2024-01.zip", "AB-1w-2024-02.zip", "AB-1w-2024-03.zip"]
    files = manifest(spark, epoch(2024, 4, 10), interval="1mo", last_open=epoch(2024, 3, 1))
    assert files == ["AB-1mo-2024-02.zip", "AB-1mo-2024-03.zip"]
    assert manifest(spark, epoch(2024, 4, 10), exchange="okx") == []


def test_manifest_daily_stand_in(spark):
    landed = ["AB-1h-2024-01.zip", "AB-1h-2024-02-01.zip", "AB-1h-2024-02-29.zip", "AB-1h-2024-01-05.zip"]
    files = manifest(spark, epoch(2024, 3, 20), available=landed)
    assert files == ["AB-1h-2024-01.zip", "AB-1h-2024-02-01.zip", "AB-1h-2024-02-29.zip"]
    assert manifest(spark, epoch(2024, 3, 20), available=landed, force_daily=True) == sorted(landed)


def test_manifest_current_month(spark):
    """A series listed this month: no monthly file before the eighth, daily files up to yesterday."""
    first = epoch(2024, 3, 1)
    assert manifest(spark, epoch(2024, 3, 4, 15), first=first) == [f"AB-1h-2024-03-0{d}.zip" for d in (1, 2, 3)]
    assert manifest(spark, epoch(2024, 3, 4, 14), first=first) == [f"AB-1h-2024-03-0{d}.zip" for d in (1, 2)]
    assert manifest(spark, epoch(2024, 3, 1, 20), first=first) == []
    assert "AB-1h-2024-03.zip" in manifest(spark, epoch(2024, 3, 8), first=first)


def test_backfill_limits(spark):
    now = epoch(2024, 3, 20)
    rows = [("okx", "SPOT", "A", "1h", now - 400 * 3600, True), ("bingx", "SPOT", "B", "1h", now - 400 * 3600, False)]
    df = spark.createDataFrame(
        rows, "exchange string, trading_type string, symbol string, interval string, high_water long, stale boolean"
    )
    found = [((r.request_start - now) // 3600, r.limit) for r in backfill_plan(df, now).orderBy("request_start").collect()]
    assert found == [(-410, 100), (-310, 100), (-210, 300), (-110, 300), (-10, 300)]


def test_live_tail_counts_candles(spark):
    """Many updates of the newest candle leave the older ones in, and the last update counts."""
    candles = [(T + i * 3600) * 1000 for i in range(9)]
    rows = [(t, t + 3599999, "1", "2", "0", "4", "old", "binance", "A/USD", "1h", True, 0) for t in candles[:-1]]
    rows += [(candles[-1], candles[-1] + 3599999, "1", "2", "0", "4", str(i), "binance", "A/USD", "1h", True, i) for i in range(1, 13)]
    elements = spark.createDataFrame(rows, LIVE)
    for found in (live.live_tail(elements), live.live_tail(elements, 9)):
        assert sorted(r.volume for r in found.collect()) == ["12"] + ["old"] * 8
    assert [r.volume for r in live.live_tail(elements, 1).collect()] == ["12"]


def test_live_tail(spark):
    def element(exchange, interval, i, closed):
        return (
            (T + i * 60) * 1000, (T + i * 60 + 60) * 1000 - 1, "1", "2", "0", "4", str(i), exchange, "A/USD", interval, closed, 0,
        )

    rows = [element("binance", "1m", i, i != 39) for i in range(40)]
    rows += [element("binance", "1h", i, i != 38) for i in range(40)]
    rows += [element("kucoin", "1h", i, None) for i in range(40)]
    rows += [element("okx", "1h", i, None) for i in range(40)]
    found = live.live_tail(spark.createDataFrame(rows, LIVE), live.LAST_N, live.LAST_N_1M).collect()
    kept = {k: sorted(int(r.volume) for r in found if (r.exchange, r.interval) == k) for k in {(r.exchange, r.interval) for r in found}}
    assert kept == {
        ("binance", "1m"): list(range(13, 39)),
        ("binance", "1h"): [*range(31, 38), 39],
        ("kucoin", "1h"): list(range(31, 39)),
        ("okx", "1h"): list(range(31, 40)),
    }
    first = min(found, key=lambda r: (r.exchange, r.interval, r.open_time))
    assert (first.open_price, first.close_price, first.low, first.high) == ("1", "2", "0", "4")
    assert first.close_time - first.open_time == 60
