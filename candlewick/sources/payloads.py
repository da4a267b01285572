"""Candles out of landed API payloads, one layout per exchange.

Everything up to the explode works inside the payload row, so a payload is
put in order, trimmed and numbered without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.dims import EXCHANGES, Layout, layout_of
from candlewick.functions.calendar import date_of, interval_seconds, rounded_seconds
from candlewick.functions.text import is_json, same_structure, structure_of_all
from candlewick.schema import KLINE_COLUMNS, SPOT, UNCHECKED

LAYOUTS: dict[str, Layout] = {name: e.layout for name, e in EXCHANGES.items()}


T = TypeVar("T")


def split_payloads(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Payloads with a JSON body, and the others for quarantine."""
    good = is_json("body")
    return payloads.where(good), payloads.where(f"not {good}")


def by_exchange(layouts: Mapping[str, T], value: Callable[[T], str]) -> str:
    """``value`` of the layout of the row's exchange; one branch per different text."""
    names: dict[str, list[str]] = {}
    for name, layout in layouts.items():
        names.setdefault(value(layout), []).append(f"'{name}'")
    return "case " + " ".join(f"when exchange in ({', '.join(n)}) then {text}" for text, n in names.items()) + " end"


def _epoch(place: str) -> str:
    number = f"cast(get(item, {place}) as bigint)"
    return f"if(layout.unit_ms, {rounded_seconds(number)}, {number})"


# Conditions on an item ``i`` of the candle list.
_USABLE = """coalesce(
    size(i) >= layout.min_len
    and try_cast(get(i, layout.open) as bigint) is not null
    and (layout.close is null or try_cast(get(i, layout.close) as bigint) is not null)
    and (layout.flag is null or get(i, layout.flag) = '1'), false)"""
_SUCCESS = "layout.success_path is null or try_variant_get(parsed, layout.success_path, 'string') = layout.success_value"
# Whether the newest of ``ordered`` is in progress.
_OPEN_TAIL = "(layout.tail = 'last' or layout.tail = 'last_of_many' and size(ordered) >= 2)"


def normalise(payloads: DataFrame, layouts: Mapping[str, Layout] | DataFrame = LAYOUTS) -> DataFrame:
    """Candles of all payloads, oldest first by ``pos`` within a payload.

    ``layouts`` tells where each exchange puts its fields, as a mapping or as rows (exchange, layout) of ``dims.layout_rows``, of which
    there are as many as exchanges. A body is parsed once, and its fields are looked up by the paths and places in the row.

    Items that are no list, too short, or without whole numbers as times are left
    out, and so is the candle still in progress. Bodies that are no JSON, of
    an unknown exchange, or with a failure code give nothing.
    """
    known = {r.exchange: r.layout.asDict() for r in layouts.collect()} if isinstance(layouts, DataFrame) else layouts
    items = (
        payloads.select("payload_id", "request_start", "exchange", "symbol", "interval", "body", layout_of("exchange", known).alias("layout"))
        .where("layout is not null")
        .selectExpr("*", "try_parse_json(body) as parsed")
        .selectExpr("*", f"if({_SUCCESS}, try_variant_get(parsed, layout.root, 'array<array<string>>'), null) as items")
        .selectExpr("*", f"filter(items, i -> {_USABLE}) as kept")
        .selectExpr("*", "if(layout.newest_first, reverse(kept), kept) as ordered")
        # An outer explode: for a plain one Spark looks for empty lists first, and parses the body for that as well.
        .selectExpr(
            "payload_id",
            "request_start",
            "exchange",
            "symbol",
            "interval",
            "layout",
            f"posexplode_outer(slice(ordered, 1, size(ordered) - if({_OPEN_TAIL} and size(ordered) > 0, 1, 0))) as (pos, item)",
        )
        .where("item is not null")
        .selectExpr("*", f"{_epoch('layout.open')} as open_time")
    )
    length = interval_seconds(anchor="open_time")
    return items.selectExpr(
        "payload_id",
        "request_start",
        "pos",
        "exchange",
        f"'{SPOT}' as trading_type",
        "symbol",
        "interval",
        "open_time",
        "get(item, layout.open_price) as open_price",
        f"if(layout.close is null, open_time + {length}, {_epoch('layout.close')}) as close_time",
        "get(item, layout.close_price) as close_price",
        "get(item, layout.low) as low",
        "get(item, layout.high) as high",
        "get(item, layout.volume) as volume",
        f"'{UNCHECKED}' as status",
    ).select("payload_id", "request_start", "pos", *KLINE_COLUMNS)


def drift(payloads: DataFrame, received: str = "received") -> DataFrame:
    """Shape of each exchange's payloads per day and whether it differs from the day before.

    ``received`` is the epoch second a payload came in.
    """
    days = (
        payloads.selectExpr("exchange", "body", f"{date_of(received)} as day")
        .groupBy("exchange", "day")
        .agg(F.expr(f"{structure_of_all('body')} as structure"))
    )
    # One row per exchange and day: small whatever the number of payloads.
    linked = days.selectExpr("*", "lag(structure) over (partition by exchange order by day) as before")
    drifted = F.coalesce(~same_structure("before", "structure"), F.lit(False)).alias("drifted")
    return linked.select(*days.columns, drifted)
