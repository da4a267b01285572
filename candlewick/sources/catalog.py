"""Symbol catalogs, name lookups and validation of fetch requests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.dims import EXCHANGES, Catalog, interval_codes
from candlewick.functions.text import bare_symbol, native_symbol
from candlewick.sources.payloads import by_exchange


def _success(c: Catalog) -> str:
    if c.success is None:
        return "true"
    code = f"get_json_object(body, '{c.success[0]}')"
    return f"{code} is not null" if c.success[1] is None else f"{code} = '{c.success[1]}'"


def _entries(c: Catalog) -> str:
    listed = "body" if c.root == "$" else f"get_json_object(body, '{c.root}')"
    return f"from_json({listed}, 'array<map<string,string>>')"


def _symbol(c: Catalog) -> str:
    """The symbol of an ``entry``."""
    return f"translate(entry['{c.joined}'], '-', '/')" if c.joined else f"upper(concat(entry['{c.base}'], '/', entry['{c.quote}']))"


def symbol_catalog(infos: DataFrame) -> DataFrame:
    """``BASE/QUOTE`` symbols of exchange-info payloads (exchange, body), in one pass.

    ``pos`` is the place of the symbol's first listing. Replies with a failure
    code, or without any code where one is due, and entries without names are left out.
    """

    def pick(value: Callable[[Catalog], str]) -> str:
        return by_exchange({name: e.catalog for name, e in EXCHANGES.items()}, value)

    return (
        infos.where(pick(_success))
        .selectExpr("exchange", f"posexplode({pick(_entries)}) as (pos, entry)")
        .selectExpr("exchange", f"{pick(_symbol)} as symbol", "pos")
        .where("symbol is not null")
        .groupBy("exchange", "symbol")
        .agg(F.expr("min(pos) as pos"))
    )


def symbol_lists(catalog: DataFrame) -> DataFrame:
    """The symbols of each exchange as one sorted list; an exchange has some thousands."""
    return catalog.groupBy("exchange").agg(F.expr("array_sort(collect_set(symbol)) as symbols"))


def with_native_symbol(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add ``native_symbol``; symbols the exchange does not list stay as they are."""
    listed = catalog.selectExpr("exchange", "symbol", "true as listed")
    return requests.join(listed, ["exchange", "symbol"], "left").selectExpr(
        *requests.columns, f"if(listed, {native_symbol()}, symbol) as native_symbol"
    )


def with_unified_symbol(natives: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add the catalog symbol that ``native_symbol`` stands for, the first listed one
    if several do; unknown names stay as they are."""
    names = (
        catalog.selectExpr("exchange", "symbol", "pos", f"{bare_symbol('symbol', unified=True)} as bare")
        .groupBy("exchange", "bare")
        .agg(F.expr("min_by(symbol, pos) as unified"))
    )
    return (
        natives.selectExpr("*", f"{bare_symbol('native_symbol', unified=False)} as bare")
        .join(names, ["exchange", "bare"], "left")
        .selectExpr(*natives.columns, "coalesce(unified, native_symbol) as symbol")
    )


def with_native_interval(requests: DataFrame) -> DataFrame:
    """Add the exchange's own interval code, null where it has none."""
    codes = interval_codes(requests.sparkSession).withColumnRenamed("native", "native_interval")
    # At most 15 rows per exchange.
    return requests.join(F.broadcast(codes), ["exchange", "interval"], "left").select(
        *requests.columns, "native_interval"
    )


def validate(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Requests with ``reason``: null if they can be fetched, else what is wrong."""
    listed = catalog.select("exchange", "symbol").distinct().selectExpr("*", "true as listed")
    joined = with_native_interval(requests).join(listed, ["exchange", "symbol"], "left")
    known = ", ".join(f"'{name}'" for name in EXCHANGES)
    reason = (
        f"case when exchange not in ({known}) then 'unknown exchange' "
        "when listed is null then 'unknown symbol' "
        "when native_interval is null then 'unsupported interval' end"
    )
    return joined.selectExpr(*requests.columns, f"{reason} as reason")


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where("reason is null").drop("reason")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where("reason is not null")
