from __future__ import annotations

from pathlib import Path

import pytest
from helpers import candle, epoch, frame, random_series
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from candlewick import CandleHistory, store
from candlewick.operators import profile as profiles
from candlewick.operators.merge import last_wins, merge_klines
from candlewick.schema import ERROR, KEY, KLINE_COLUMNS, OK, UNCHECKED

T = epoch(2024, 1, 1)


def rows_of(df):
    return sorted((tuple(r[c] for c in KLINE_COLUMNS) for r in df.collect()), key=str)


def test_last_wins_by_order(spark):
    rows = [(*candle(T, volume=str(v)), b, p) for v, b, p in [(1, 0, 5), (2, 1, 0), (3, 1, 1), (4, 0, 9)]]
    df = spark.createDataFrame(rows, frame(spark, []).schema.add("batch", IntegerType()).add("pos", IntegerType()))
    for order in (df, df.orderBy(F.desc("batch")), df.orderBy("volume")):
        (row,) = last_wins(order, ["batch", "pos"]).collect()
        assert row.volume == "3"


def test_merge_keeps_status_and_replaces_nulls(spark):
    old = [candle(T, status=OK, price="1"), candle(T + 3600, status=ERROR)]
    new = [list(candle(T, price="9")), candle(T + 7200)]
    new[0][8] = None
    new[0] = tuple(new[0])
    merged = {r.open_time: r for r in merge_klines(frame(spark, old), frame(spark, new)).collect()}
    assert (merged[T].open_price, merged[T].low, merged[T].status) == ("9", None, OK)
    assert merged[T + 3600].status == ERROR
    assert merged[T + 7200].status == UNCHECKED


def test_merge_twice_is_merge_once(spark):
    old, new = frame(spark, random_series(1, 10)), frame(spark, random_series(2, 10))
    once = merge_klines(old, new)
    assert rows_of(once) == rows_of(merge_klines(once, new))


@pytest.fixture
def history(spark, tmp_path):
    return CandleHistory(spark, str(tmp_path / "store"))


def files(history) -> set[str]:
    return {str(p) for p in Path(history.root, "klines").rglob("*.parquet")}


def test_upsert_rewrites_touched_folders_only(spark, history):
    minutes = [candle(t, interval="1m") for t in (epoch(2023, 12, 31), epoch(2024, 1, 1), epoch(2024, 2, 1))]
    hours = [candle(T), candle(epoch(2025, 1, 1))]
    days = [candle(t, interval="1d") for t in (T, epoch(2025, 1, 1))]
    history.upsert(frame(spark, minutes + hours + days))
    before = files(history)
    folders = {str(Path(f).parent.relative_to(history.root)) for f in before}
    assert {f.split("interval=")[1].rsplit("/", 1)[0] for f in folders} == {
        "1m/part=202312", "1m/part=202401", "1m/part=202402", "1h/part=2024", "1h/part=2025", "1d/part=0",
    }
    history.upsert(frame(spark, [candle(epoch(2024, 1, 5), interval="1m")]))
    kept = before & files(history)
    assert {f.split("interval=")[1].rsplit("/", 2)[0] for f in before - kept} == {"1m/part=202401"}
    assert history.candles().count() == 8


def test_a_daily_candle_rewrites_one_bucket(spark, history):
    symbols = [f"S{n}/USD" for n in range(100)]
    history.upsert(frame(spark, [candle(T, symbol=s, interval="1d") for s in symbols]))
    before = files(history)
    assert len({Path(f).parent for f in before}) == store.BUCKETS
    history.upsert(frame(spark, [candle(T + 86400, symbol="S7/USD", interval="1d")]))
    assert len({Path(f).parent for f in before - files(history)}) == 1
    assert history.candles("binance", "S7/USD", "1d").count() == 2


def statuses(history):
    return {r.open_time: r.status for r in history.candles().collect()}


def test_statuses_are_written_without_candles(spark, history):
    times = [T + 3600 * n for n in range(4)]
    history.upsert(frame(spark, [candle(t) for t in times]))
    before = files(history)

    def write(*changes):
        store.write_status(spark, history.root, frame(spark, [candle(t, status=s) for t, s in changes]))

    write((times[0], OK), (times[1], ERROR), (T - 3600, OK))
    write((times[1], OK), (times[2], None))
    want = {times[0]: OK, times[1]: OK, times[2]: None, times[3]: UNCHECKED}
    assert statuses(history) == want and files(history) == before
    columns = spark.read.parquet(str(next(Path(history.root, "status").rglob("*.parquet")))).columns
    assert columns == [*KEY, "status"]
    # An upsert keeps them, a fold moves them, and later ones win over folded ones.
    history.upsert(frame(spark, [candle(t, volume="new") for t in times]))
    assert statuses(history) == want
    history.fold()
    assert statuses(history) == want and not list(Path(history.root, "status").iterdir())
    write((times[3], ERROR))
    assert statuses(history) == want | {times[3]: ERROR}
    history.fold()
    history.fold()
    assert statuses(history) == want | {times[3]: ERROR}


def test_statuses_written_during_a_fold_wait(spark, history, monkeypatch):
    history.upsert(frame(spark, [candle(T), candle(T + 3600)]))
    store.write_status(spark, history.root, frame(spark, [candle(T, status=OK)]))
    publish = store._publish

    def late(moved):
        store.write_status(spark, history.root, frame(spark, [candle(T, status=ERROR)]))
        publish(moved)

    monkeypatch.setattr(store, "_publish", late)
    history.fold()
    monkeypatch.undo()
    assert statuses(history) == {T: ERROR, T + 3600: UNCHECKED}
    history.fold()
    assert statuses(history) == {T: ERROR, T + 3600: UNCHECKED}


def test_a_fold_that_dies_is_done_again(spark, history, monkeypatch):
    history.upsert(frame(spark, [candle(T), candle(T + 3600)]))
    store.write_status(spark, history.root, frame(spark, [candle(T, status=OK)]))
    delete = store.Files.delete
    monkeypatch.setattr(store.Files, "delete", lambda self, name: 1 / 0 if name.startswith("status") else delete(self, name))
    with pytest.raises(ZeroDivisionError):
        history.fold()
    monkeypatch.undo()
    assert statuses(history) == {T: OK, T + 3600: UNCHECKED}
    history.fold()
    assert statuses(history) == {T: OK, T + 3600: UNCHECKED}


def test_the_kept_profile_is_that_of_all_candles(spark, history):
    def same():
        kept = {tuple(r) for r in history.profile().collect()}
        assert kept == {tuple(r) for r in profiles.series_profile(history.candles()).collect()}

    same()
    for seed in range(3):
        rows = random_series(seed, 6, "1d") + random_series(seed + 10, 6, "1h", 30)
        history.upsert(frame(spark, rows))
        same()
        some = frame(spark, [(*r[:11], OK if n % 2 else ERROR) for n, r in enumerate(rows) if n % 3 == seed])
        store.write_status(spark, history.root, some)
        same()
        if seed == 1:
            history.fold()
            same()
    asked = spark.createDataFrame([("binance", "S1/USD", "1d"), ("binance", "S1/USD", "1h"), ("okx", "none", "1d")], "exchange string, symbol string, interval string")
    want = {(r.symbol, r.interval): r.n_candles for r in profiles.series_profile(history.candles("binance", "S1/USD")).collect()} | {("none", "1d"): 0}
    assert {(r.symbol, r.interval): r.n_candles for r in history.profile(asked).collect()} == want
    assert {r.symbol: r.present for r in history.exists(asked).collect()} == {"S1/USD": True, "none": False}


def test_upsert_refuses_backward_candles(spark, history):
    with pytest.raises(Exception, match="closes before it opens"):
        history.upsert(frame(spark, [candle(T, T - 60)]))


def test_snapshot_and_catalog_table(spark, history, tmp_path):
    history.upsert(frame(spark, [candle(T), candle(T, interval="1d")]))
    target = str(tmp_path / "next")
    store.snapshot(spark, history.root, frame(spark, [candle(T, price="5"), candle(T + 3600)]), target)
    assert store.scan(spark, target).count() == 3
    assert history.candles().where("open_price = '5'").count() == 0
    store.create(spark, target, "next_candles")
    spark.sql("MSCK REPAIR TABLE next_candles")
    assert spark.table("next_candles").where("interval = '1h'").count() == 2
    spark.sql("DROP TABLE next_candles")


def test_check_read_repair(spark, history):
    clean = [candle(T + i * 3600) for i in range(10)]
    stored = clean.copy()
    stored[3] = candle(T + 3 * 3600, T + 4 * 3600 - 60)
    del stored[6]
    history.upsert(frame(spark, stored))
    errors = history.check_and_store()
    assert {r.open_time for r in errors.collect()} == {T + 3 * 3600, T + 5 * 3600}
    assert history.check_and_store().count() == 2

    read = history.read("binance", "A/USD", "1h", T, T + 9 * 3600).collect()
    assert [r.open_time for r in read] == [c[4] for c in stored[:-1]]
    assert read[0].open_price == 1.5
    streams = history.read("binance", "A/USD", "1h", result="streams").collect()
    assert [(r.stream_no, (r.open_time - T) // 3600) for r in streams] == [(0, 0), (0, 1), (0, 2), (1, 4), (2, 7), (2, 8)]
    nested = history.read("binance", "A/USD", "1h", result="nested_streams").collect()
    assert [len(r.candles) for r in nested] == [3, 1, 2]

    # A pool without request keys.
    returned = history.check_and_repair(frame(spark, clean))
    assert returned.count() == 2
    assert history.check_and_store().count() == 0
    assert history.candles().count() == 10
    assert [r.stream_no for r in history.read("binance", "A/USD", "1h", result="streams").collect()] == [0] * 9


def test_check_last_n(spark, history):
    old, new = epoch(2020, 1, 1), epoch(2024, 1, 1)
    history.upsert(frame(spark, [candle(t) for t in (old, old + 7200, new, new + 7200)]))
    errors = history.check_and_store(as_of=new + 10 * 3600, last_n=24)
    assert {r.open_time for r in errors.collect()} == {new}
    status = {r.open_time: r.status for r in history.candles().collect()}
    assert status == {old: UNCHECKED, old + 7200: UNCHECKED, new: ERROR, new + 7200: UNCHECKED}


def test_read_arguments(history):
    for bad in (
        dict(exchange="nowhere", symbol="A/USD", interval="1h"),
        dict(exchange="okx", symbol="A/USD", interval="8h"),
        dict(exchange="okx", symbol=None, interval="1h"),
        dict(exchange="okx", symbol="A/USD", interval="1h", start_from="1"),
        dict(exchange="okx", symbol="A/USD", interval="1h", until_to=1.5),
        dict(exchange="okx", symbol="A/USD", interval="1h", result="other"),
    ):
        with pytest.raises(ValueError):
            history.read(**bad)


def test_bad_prices(spark, history):
    history.upsert(frame(spark, [candle(T, price="x")]))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        history.read("binance", "A/USD", "1h").collect()
    (row,) = history.read("binance", "A/USD", "1h", lenient=True).collect()
    assert row.open_price is None and row.volume == 10.0


def test_profile_plans_and_meta(spark, history):
    history.upsert(frame(spark, [candle(T), candle(T + 3600)]))
    requests = spark.createDataFrame(
        [("binance", "A/USD", "1h"), ("okx", "B/USD", "1mo"), ("binance", "C/USD", "1d")],
        "exchange string, symbol string, interval string",
    )
    assert {r.symbol: r.present for r in history.exists(requests).collect()} == {"A/USD": True, "B/USD": False, "C/USD": False}
    now = epoch(2024, 3, 20, 16)
    first = {r.symbol: (r.first_year, r.first_month, r.last_close) for r in history.first_listed(requests, now).collect()}
    assert first == {"A/USD": (2024, 1, T + 7200), "B/USD": (2024, 3, 0), "C/USD": (2018, 1, 0)}
    plan = history.backfill_plan(requests, now).collect()
    starts = {s: sorted(r.request_start for r in plan if r.symbol == s) for s in ("A/USD", "B/USD", "C/USD")}
    assert starts["A/USD"][:2] == [T + 7200 - 36000, T + 7200 - 36000 + 1000 * 3600]
    assert starts["B/USD"] == []  # its first month has just begun
    assert len(starts["C/USD"]) == 3
    files = {r.file for r in history.archive_manifest(requests, now).collect()}
    assert {"AUSD-1h-2023-12.zip", "AUSD-1h-2024-01-31.zip", "CUSD-1d-2018-01.zip"} <= files
    assert not any(f.startswith("B") for f in files)

    rows = requests.selectExpr("*", "'first' as cache_type", "'{}' as data")
    history.upsert_meta(rows)
    history.upsert_meta(rows.where("symbol = 'A/USD'").selectExpr("exchange", "symbol", "interval", "cache_type", "'{\"year\":1}' as data"))
    wanted = requests.selectExpr("*", "'first' as cache_type")
    assert {r.symbol: r.data for r in history.meta(wanted).collect()} == {"A/USD": '{"year":1}', "B/USD": "{}", "C/USD": "{}"}


def test_load_payloads_and_archives(spark, history, tmp_path):
    import json

    from test_payloads import binance_item
    from test_sources import line, put

    def payload(name, start, items):
        return (name, "binance", "A/USD", "1h", start, json.dumps(items) if items else "[broken")

    older = [binance_item(T + i * 3600) for i in range(3)]
    newer = [[*i[:5], "99", *i[6:]] for i in (binance_item(T + 3600), binance_item(T + 7200))]
    rows = [payload("a", T + 3600, newer), payload("b", T, older), payload("c", T, None)]
    schema = "payload_id string, exchange string, symbol string, interval string, request_start long, body string"
    bad = history.load_payloads(spark.createDataFrame(rows, schema))
    assert [r.payload_id for r in bad.collect()] == ["c"]
    assert {r.open_time: r.volume for r in history.candles().collect()} == {T: "7.00", T + 3600: "99"}

    put(tmp_path, "AUSD-1h-2024-01.zip", [line(T, volume="month"), line(T + 3600, volume="month")])
    put(tmp_path, "AUSD-1h-2024-01-01.zip", [line(T, volume="day")])
    put(tmp_path, "BUSD-1h-2024-01.zip", [line(T)])
    symbols = spark.createDataFrame([("AUSD", "A/USD"), ("BUSD", "B/USD")], "native_symbol string, symbol string")
    manifest = spark.createDataFrame([("AUSD-1h-2024-01.zip",), ("AUSD-1h-2024-01-01.zip",)], "file string")
    history.load_archives(str(tmp_path), symbols, manifest)
    assert {r.open_time: r.volume for r in history.candles().collect()} == {T: "day", T + 3600: "month"}
    history.load_archives(str(tmp_path), symbols)
    assert history.candles(symbol="B/USD").count() == 1


def test_log_folders_and_feeds(spark, history, monkeypatch):
    monkeypatch.setattr(store, "LOG_FOLDER", 2)

    def log(batch, feed, *rows):
        store.append_log(frame(spark, rows).selectExpr("*", "0L as seq"), history.root, batch, feed)

    for n in range(5):
        log(n, "one", candle(T + n * 3600))
        log(n, "two", candle(T + n * 3600, symbol="B/USD"))
    store.merge_log(spark, history.root, 2, "one")
    assert history.candles().count() == 3
    assert store.pending(spark, history.root, feed="one").count() == 2
    assert store.pending(spark, history.root, feed="two").count() == 5
    store.merge_log(spark, history.root, 4, "one")
    store.merge_log(spark, history.root, 4, "two")
    assert history.candles().count() == 10
    assert store.pending(spark, history.root, feed="one").count() == 0


def test_log_merge(spark, history):
    def log(batch, *rows):
        df = frame(spark, rows).selectExpr("*", "monotonically_increasing_id() as seq")
        store.append_log(df, history.root, batch)

    history.upsert(frame(spark, [candle(T, status=OK)]))
    log(0, candle(T, price="2"), candle(T + 3600), candle(T, exchange="kucoin"))
    log(0, candle(T, price="3"), candle(T + 3600), candle(T, exchange="kucoin"))  # replay
    log(1, candle(T + 3600, exchange="kucoin", price="4"))
    current = {(r.exchange, r.open_time): r.open_price for r in store.current(spark, history.root).collect()}
    # The newest kucoin candle may still be open.
    assert current == {("binance", T): "3", ("binance", T + 3600): "1.5", ("kucoin", T): "1.5"}
    one = store.current(spark, history.root, exchange="binance", interval="1h")
    assert one.count() == 2

    store.merge_log(spark, history.root, 0)
    assert store.merged_upto(spark, history.root) == 0
    assert {(r.exchange, r.open_time) for r in history.candles().collect()} == {("binance", T), ("binance", T + 3600)}
    store.merge_log(spark, history.root, 1)
    store.merge_log(spark, history.root, 1)
    found = {(r.exchange, r.open_time): (r.open_price, r.status) for r in history.candles().collect()}
    assert found == {
        ("binance", T): ("3", UNCHECKED), ("binance", T + 3600): ("1.5", UNCHECKED), ("kucoin", T): ("1.5", UNCHECKED),
    }
    assert {tuple(r[c] for c in KEY) for r in store.current(spark, history.root).collect()} == {
        tuple(r[c] for c in KEY) for r in history.candles().collect()
    }
    log(2, candle(T + 7200, exchange="kucoin"))
    store.merge_log(spark, history.root, 2)
    kucoin = {r.open_time: r.open_price for r in history.candles("kucoin").collect()}
    assert kucoin == {T: "1.5", T + 3600: "4"}


def test_a_merged_log_expires(spark, history, monkeypatch):
    """After each merge: what a read that began before it needs, and no more."""
    monkeypatch.setattr(store, "LOG_FOLDER", 4)
    root = Path(history.root)

    def kept(name, depth):
        return sorted(int(p.name.rpartition("=")[2]) for p in root.glob("/".join([name, "live", *["*=*"] * depth])) if p.is_dir())

    for n in range(24):
        row = candle(T + n * 3600, exchange="kucoin")
        store.append_log(frame(spark, [row]).selectExpr("*", "0L as seq"), history.root, n)
        if n % 3 == 2:
            before = store.pending(spark, history.root)
            store.merge_log(spark, history.root, n)
            assert before.count() == (3 if n == 2 else 4)  # planned before the merge, read after it
            assert kept("log", 2) == [m for m in range(n + 1) if m > n - 3]
            assert kept("held", 1) == kept("merged", 1) == [m for m in (n - 3, n) if m >= 0]
            assert len(kept("log", 1)) <= 2
    assert store.merged_upto(spark, history.root) == 23
    assert history.candles().count() == 23
    store.append_log(frame(spark, [candle(T, exchange="kucoin", volume="late replay")]).selectExpr("*", "0L as seq"), history.root, 1)
    assert store.pending(spark, history.root).count() == 1  # the held one; what is merged stays merged


# Crashes and two writers


def by_time(history) -> dict[int, str]:
    return {r.open_time: r.volume for r in history.candles().collect()}


def test_a_crash_before_the_folders_are_valid_changes_nothing(spark, history, monkeypatch):
    history.upsert(frame(spark, [candle(T, volume="1")]))
    claim = store.Files.claim
    monkeypatch.setattr(store.Files, "claim", lambda self, name: 1 / 0 if "READY" in name else claim(self, name))
    with pytest.raises(ZeroDivisionError):
        history.upsert(frame(spark, [candle(T, volume="2")]))
    monkeypatch.undo()
    assert by_time(history) == {T: "1"}
    history.upsert(frame(spark, [candle(T, volume="3")]))
    assert by_time(history) == {T: "3"}


@pytest.mark.parametrize("after", [0, 1, 2])
def test_a_crash_while_folders_move_is_finished(spark, history, monkeypatch, after):
    """Three months of minutes are three folders; the write dies after some of them, or between two steps of a move."""
    times = [epoch(2024, m, 1) for m in (1, 2, 3)]
    history.upsert(frame(spark, [candle(t, interval="1m", volume="old") for t in times]))
    move, done = store.Files.move, []

    def dying(self, name, target):
        if len(done) == after:
            self.delete(target)  # the old folder is gone, the new one not yet there
            raise KeyboardInterrupt
        done.append(name)
        move(self, name, target)

    monkeypatch.setattr(store.Files, "move", dying)
    with pytest.raises(KeyboardInterrupt):
        history.upsert(frame(spark, [candle(t, interval="1m", volume="new") for t in times]))
    monkeypatch.undo()
    with pytest.raises(store.BusyError):
        history.upsert(frame(spark, [candle(T)]))
    history.recover()
    assert by_time(history) == {t: "new" for t in times}
    history.recover()
    history.upsert(frame(spark, [candle(times[0], interval="1m", volume="newer")]))
    assert by_time(history) == {times[0]: "newer", times[1]: "new", times[2]: "new"}


def test_two_writers(spark, history):
    history.upsert(frame(spark, [candle(T, volume="1")]))
    with store.writing(spark, history.root):
        store.write_status(spark, history.root, frame(spark, [candle(T, status=OK)]))
        for write in (lambda: history.upsert(frame(spark, [candle(T)])), history.fold):
            with pytest.raises(store.BusyError):
                write()
    assert by_time(history) == {T: "1"} and statuses(history) == {T: OK}
    history.upsert(frame(spark, [candle(T + 3600, volume="2")]))
    assert by_time(history) == {T: "1", T + 3600: "2"}


def test_keys_that_come_twice_are_refused(spark, history):
    with pytest.raises(Exception, match="several incoming rows have one key"):
        history.upsert(frame(spark, [candle(T, volume="1"), candle(T, volume="2")]))
    history.upsert(frame(spark, [candle(T, volume="3")]))
    assert by_time(history) == {T: "3"}
