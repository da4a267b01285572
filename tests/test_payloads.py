from __future__ import annotations

import json

from helpers import epoch

from candlewick.dims import Layout, layout_rows
from candlewick.sources import catalog, payloads

T = epoch(2024, 1, 1)


def normalised(spark, exchange, body, interval="1h", layouts=payloads.LAYOUTS):
    body = body if isinstance(body, str) else json.dumps(body)
    df = spark.createDataFrame(
        [("p", exchange, "A/USD", interval, None, body)],
        "payload_id string, exchange string, symbol string, interval string, request_start long, body string",
    )
    return payloads.normalise(df, layouts).orderBy("pos").collect()


def binance_item(t, close=None):
    return [t * 1000, "1.10", "4.0", "0.5", "2.20", "7.00", (close or t + 3600) * 1000 - 1, "0", 1, "0", "0", "0"]


def test_binance_order_fields_and_tail(spark):
    rows = normalised(spark, "binance", [binance_item(T + i * 3600) for i in range(3)])
    assert [(r.pos, r.open_time, r.close_time) for r in rows] == [(0, T, T + 3600), (1, T + 3600, T + 7200)]
    r = rows[0]
    assert (r.open_price, r.high, r.low, r.close_price, r.volume) == ("1.10", "4.0", "0.5", "2.20", "7.00")
    assert r.status == "__NON_CHECK__" and r.trading_type == "SPOT"


def test_single_rows(spark):
    # Dropped where the newest is always in progress, kept where only one of several is.
    assert normalised(spark, "binance", [binance_item(T)]) == []
    assert normalised(spark, "binanceus", [binance_item(T)]) == []
    bybit = {"retCode": 0, "result": {"list": [[str(T * 1000), "1", "4", "0", "2", "7", "9"]]}}
    assert len(normalised(spark, "bybit", bybit)) == 1
    bingx = {"code": 0, "data": [[T * 1000, 1, 4, 0, 2, 7, (T + 3600) * 1000 - 1, 0]]}
    assert len(normalised(spark, "bingx", bingx)) == 1


def test_newest_first(spark):
    items = [[str((T + i * 3600) * 1000), "1", "4", "0", "2", "7", "9"] for i in (2, 1, 0)]
    rows = normalised(spark, "bybit", {"retCode": 0, "result": {"list": items}})
    assert [(r.pos, r.open_time) for r in rows] == [(0, T), (1, T + 3600)]
    assert rows[0].close_time == T + 3600


def test_bingx_numbers_as_text(spark):
    items = [[(T + i * 3600) * 1000, 1.5, 4, 0.25, 2.125, 7.5, (T + i * 3600 + 3600) * 1000 - 1, 0] for i in (1, 0)]
    (row,) = normalised(spark, "bingx", {"code": 0, "data": items})
    assert (row.open_time, row.close_time) == (T, T + 3600)
    assert (row.open_price, row.high, row.low, row.close_price, row.volume) == ("1.5", "4", "0.25", "2.125", "7.5")


def test_kucoin_columns_seconds_and_code(spark):
    items = [[str(T + i * 3600), "open", "close", "high", "low", "vol", "x"] for i in (1, 0)]
    rows = normalised(spark, "kucoin", {"code": "200000", "data": items})
    assert [r.open_time for r in rows] == [T, T + 3600]
    r = rows[0]
    assert (r.open_price, r.close_price, r.high, r.low, r.volume) == ("open", "close", "high", "low", "vol")
    assert normalised(spark, "kucoin", {"code": "400100", "data": items}) == []


def okx_item(t, done="1"):
    return [str(t * 1000), "1", "4", "0", "2", "7", "0", "0", done]


def test_okx_confirmed_only(spark):
    items = [okx_item(T + 7200, "0"), okx_item(T + 3600), okx_item(T)[:8], okx_item(T)]
    rows = normalised(spark, "okx", {"code": "0", "data": items})
    assert [(r.pos, r.open_time) for r in rows] == [(0, T), (1, T + 3600)]


def test_close_from_interval(spark):
    feb = epoch(2024, 2, 1)
    for interval, seconds in (("3d", 259200), ("1w", 604800), ("1mo", 29 * 86400)):
        (row,) = normalised(spark, "okx", {"code": "0", "data": [okx_item(feb)]}, interval)
        assert row.close_time - row.open_time == seconds
    (row,) = normalised(spark, "kucoin", {"code": "200000", "data": [[str(feb), "1", "2", "3", "4", "5", "6"]]}, "8h")
    assert row.close_time - row.open_time == 28800


def test_odd_bodies(spark):
    good = binance_item(T)
    for body in ('{"data":{"a":1}}', '{"data":5}', '{"code":"200000","data":null}'):
        assert normalised(spark, "bingx", body) == [], body
    for body in ("", "[", "{}", "null", "[]", '{"code":1}', "12", '"x"'):
        assert normalised(spark, "binance", body) == [], body
    assert normalised(spark, "nowhere", [good, good]) == []
    # Short items, nulls and times that are no numbers are left out, the rest stays.
    mixed = [good[:11], None, 5, "x", {"a": 1}, ["x"] + good[1:], good, binance_item(T + 3600)]
    assert [r.open_time for r in normalised(spark, "binance", mixed)] == [T]


def test_new_exchange_is_data(spark):
    layout = Layout(root="$.rows", min_len=6, unit_ms=False, newest_first=False, tail="none")
    body = {"rows": [[T, "1", "4", "0", "2", "7"]]}
    (row,) = normalised(spark, "mine", body, "1d", {"mine": layout})
    assert (row.open_time, row.close_time, row.high) == (T, T + 86400, "4")


def test_new_exchange_is_a_row(spark):
    layout = Layout(root="$.a.rows", min_len=6, unit_ms=False, newest_first=True, tail="last", success=("$.ok", "true"))
    rows = layout_rows(spark).unionByName(layout_rows(spark, {"mine": layout}))
    items = [[T + 3600, 2, 4, 0, 2, 7], [T, 0.00000010, "4.50", 1e3, 2, 12345678901234567890]]
    (row,) = normalised(spark, "mine", {"ok": True, "a": {"rows": items}}, "1h", rows)
    assert (row.pos, row.open_time, row.close_time, row.high, row.volume) == (0, T, T + 3600, "4.50", "12345678901234567890")
    assert float(row.open_price) == 1e-7 and float(row.low) == 1000
    assert normalised(spark, "mine", {"ok": False, "a": {"rows": items}}, "1h", rows) == []
    assert len(normalised(spark, "binance", [binance_item(T), binance_item(T + 3600)], layouts=rows)) == 1


def test_quarantine(spark):
    df = spark.createDataFrame([(1, "[]"), (2, "{"), (3, None), (4, '{"a":1}')], "id int, body string")
    good, bad = payloads.split_payloads(df)
    assert {r.id for r in good.collect()} == {1, 4}
    assert {r.id for r in bad.collect()} == {2, 3}


def test_drift(spark):
    rows = [
        ("a", T, '{"x":1}'), ("a", T + 60, '{"x":2}'),
        ("a", T + 86400, '{"x":3}'),
        ("a", T + 2 * 86400, '{"x":"3"}'),
        ("b", T, "[1]"), ("b", T + 86400, "[1.5]"),
    ]
    df = spark.createDataFrame(rows, "exchange string, received long, body string")
    found = {(r.exchange, str(r.day)): r.drifted for r in payloads.drift(df).collect()}
    assert found == {
        ("a", "2024-01-01"): False, ("a", "2024-01-02"): False, ("a", "2024-01-03"): True,
        ("b", "2024-01-01"): False, ("b", "2024-01-02"): True,
    }


def infos(spark):
    pairs = [{"baseAsset": "btc", "quoteAsset": "usdt"}, {"baseAsset": "eth"}, {"baseAsset": "btc", "quoteAsset": "USDT"}]
    rows = [
        ("binance", json.dumps({"symbols": pairs})),
        ("bybit", json.dumps({"retCode": 10001, "result": {"list": [{"baseCoin": "BTC", "quoteCoin": "USDT"}]}})),
        ("okx", json.dumps({"code": "0", "data": [{"baseCcy": "AB", "quoteCcy": "C"}, {"baseCcy": "A", "quoteCcy": "BC"}]})),
        ("kucoin", json.dumps({"code": "200000", "data": [{"baseCurrency": "BTC", "quoteCurrency": "USDT"}]})),
        ("bingx", json.dumps({"code": 0, "data": {"symbols": [{"symbol": "Btc-USDT"}, {"other": 1}]}})),
    ]
    return spark.createDataFrame(rows, "exchange string, body string")


def test_symbol_catalog_and_maps(spark):
    listed = catalog.symbol_catalog(infos(spark))
    assert {(r.exchange, r.symbol, r.pos) for r in listed.collect()} == {
        ("binance", "BTC/USDT", 0), ("okx", "AB/C", 0), ("okx", "A/BC", 1),
        ("kucoin", "BTC/USDT", 0), ("bingx", "Btc/USDT", 0),
    }
    natives = spark.createDataFrame(
        [("binance", "btcusdt"), ("okx", "A-BC"), ("kucoin", "BTC-USDT"), ("binance", "XYZ")], "exchange string, native_symbol string"
    )
    unified = {(r.exchange, r.native_symbol): r.symbol for r in catalog.with_unified_symbol(natives, listed).collect()}
    # Without separators two symbols read the same: the first listed one wins.
    assert unified == {
        ("binance", "btcusdt"): "BTC/USDT", ("okx", "A-BC"): "AB/C", ("kucoin", "BTC-USDT"): "BTC/USDT", ("binance", "XYZ"): "XYZ",
    }
    wanted = spark.createDataFrame([("binance", "BTC/USDT"), ("okx", "AB/C"), ("okx", "Q/R")], "exchange string, symbol string")
    native = {(r.exchange, r.symbol): r.native_symbol for r in catalog.with_native_symbol(wanted, listed).collect()}
    assert native == {("binance", "BTC/USDT"): "BTCUSDT", ("okx", "AB/C"): "AB-C", ("okx", "Q/R"): "Q/R"}


def test_validation(spark):
    specs = [
        ("binance", "BTC/USDT", "1m"), ("binance", "BTC/EUR", "1m"), ("okx", "AB/C", "8h"),
        ("nowhere", "BTC/USDT", "1m"), ("kucoin", "BTC/USDT", "3d"), ("kucoin", "BTC/USDT", "1mo"),
    ]
    df = spark.createDataFrame(specs, "exchange string, symbol string, interval string")
    found = catalog.validate(df, catalog.symbol_catalog(infos(spark)))
    assert {(r[0], r[1], r[2]): r.reason for r in found.collect()} == dict(
        zip(specs, [None, "unknown symbol", "unsupported interval", "unknown exchange", "unsupported interval", None])
    )
    assert catalog.accepted(found).count() == 2 and catalog.rejected(found).count() == 4


def test_separator_counts_on_bingx(spark):
    body = json.dumps({"code": 0, "data": {"symbols": [{"symbol": "AB-C"}, {"symbol": "A-BC"}]}})
    listed = catalog.symbol_catalog(spark.createDataFrame([("bingx", body)], "exchange string, body string"))
    natives = spark.createDataFrame([("bingx", "a-bc"), ("bingx", "ABC")], "exchange string, native_symbol string")
    found = {r.native_symbol: r.symbol for r in catalog.with_unified_symbol(natives, listed).collect()}
    assert found == {"a-bc": "A/BC", "ABC": "ABC"}
