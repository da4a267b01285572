"""Column names, types and status values of the candle table."""

from __future__ import annotations

from pyspark.sql import types as T

SERIES = ("exchange", "trading_type", "symbol", "interval")
KEY = (*SERIES, "open_time")
PARTITION = ("exchange", "interval", "part", "bucket")

# Candle values an upsert replaces. Prices stay text to keep the exchange's precision.
VALUES = ("open_price", "close_time", "close_price", "low", "high", "volume")
PRICES = ("open_price", "close_price", "low", "high", "volume")

# Stored status texts.
UNCHECKED = "__NON_CHECK__"
OK = "__OK__"
ERROR = "__ERROR__"

SPOT = "SPOT"

KLINE = T.StructType(
    [
        T.StructField("exchange", T.StringType(), False),
        T.StructField("trading_type", T.StringType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("interval", T.StringType(), False),
        T.StructField("open_time", T.LongType(), False),
        T.StructField("open_price", T.StringType(), False),
        T.StructField("close_time", T.LongType(), False),
        T.StructField("close_price", T.StringType(), False),
        T.StructField("low", T.StringType()),
        T.StructField("high", T.StringType()),
        T.StructField("volume", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)
KLINE_COLUMNS = tuple(KLINE.fieldNames())
STORED = T.StructType([*KLINE.fields, T.StructField("part", T.IntegerType()), T.StructField("bucket", T.IntegerType())])

# One change of a status, and what is kept of each series in each folder.
STATUS = T.StructType([*(f for f in KLINE.fields if f.name in (*KEY, "status")), T.StructField("batch", T.LongType())])
EXTENT_FIGURES = ("first_open", "last_open", "last_close", "first_unchecked", "last_not_ok", "n_candles", "n_errors")
EXTENT = T.StructType(
    [
        *(f for f in STORED.fields if f.name in (*SERIES, *PARTITION)),
        *(T.StructField(name, T.LongType()) for name in EXTENT_FIGURES),
    ]
)

PAYLOAD = T.StructType(
    [
        T.StructField("payload_id", T.StringType(), False),
        T.StructField("exchange", T.StringType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("interval", T.StringType(), False),
        T.StructField("request_start", T.LongType()),
        T.StructField("body", T.StringType()),
    ]
)

# Live candle as a feed delivers it: times in ms, "hight" spelt as the feed spells it.
LIVE = T.StructType(
    [
        T.StructField("open_time", T.LongType()),
        T.StructField("close_time", T.LongType()),
        T.StructField("open", T.StringType()),
        T.StructField("close", T.StringType()),
        T.StructField("low", T.StringType()),
        T.StructField("hight", T.StringType()),
        T.StructField("volume", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("interval", T.StringType()),
        T.StructField("is_closed", T.BooleanType()),
        T.StructField("seq", T.LongType()),
    ]
)

META = T.StructType(
    [
        T.StructField("exchange", T.StringType(), False),
        T.StructField("trading_type", T.StringType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("interval", T.StringType(), False),
        T.StructField("cache_type", T.StringType(), False),
        T.StructField("data", T.StringType()),
    ]
)
META_KEY = (*SERIES, "cache_type")
