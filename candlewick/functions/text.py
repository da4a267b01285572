"""Names, keys and payload text."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from candlewick.dims import EXCHANGES


def series_name(
    exchange: str = "exchange", trading_type: str = "trading_type", symbol: str = "symbol", interval: str = "interval"
) -> str:
    """Flat name of a series: ``exchange__trading__base_quote__interval``."""
    return (
        f"concat_ws('__', {exchange}, lower(translate({trading_type}, '/-', '__')), "
        f"lower(translate({symbol}, '/', '_')), {interval})"
    )


def partition_name(series: str, year: str = "year") -> str:
    return f"concat_ws('__', {series}, {year})"


def meta_key(cache_type: str = "cache_type") -> str:
    """Hashed metadata key of a row with the series columns, as other readers of the table compute it."""
    # Fixed value: the format of the text that is hashed.
    return f"sha2(format_string('_____%s_%s_%s_%s_%s_____', exchange, symbol, interval, trading_type, {cache_type}), 256)"


def native_symbol(exchange: str = "exchange", symbol: str = "symbol") -> str:
    """``BASE/QUOTE`` as the exchange writes it."""
    dashed = ", ".join(f"'{name}'" for name, e in EXCHANGES.items() if e.native_separator == "-")
    return f"upper(replace({symbol}, '/', if({exchange} in ({dashed}), '-', '')))"


def bare_symbol(symbol: str, unified: bool, exchange: str = "exchange") -> str:
    """A symbol as it is compared with others of the exchange: lower case and, unless
    the exchange tells symbols apart by it, without the separator."""
    kept = ", ".join(f"'{name}'" for name, e in EXCHANGES.items() if e.separator_counts)
    dashed = ", ".join(f"'{name}'" for name, e in EXCHANGES.items() if e.native_separator == "-")
    separator = "'/'" if unified else f"if({exchange} in ({dashed}), '-', '/')"
    return (
        f"lower(if({exchange} in ({kept}), replace({symbol}, '/', '-'), replace({symbol}, {separator})))"
    )


def is_json(text: str) -> str:
    return f"(try_parse_json({text}) is not null)"


def structure(body: str) -> str:
    """Shape of one JSON text; decimals of any size count as one type."""
    return _plain(f"schema_of_variant(try_parse_json({body}))")


def structure_of_all(body: str) -> str:
    """Merged shape of many JSON texts (aggregate)."""
    return _plain(f"schema_of_variant_agg(try_parse_json({body}))")


# Names of types and fields (quoted where they aren't plain), and the marks between them.
_TOKEN = re.compile(r"`(?:[^`]|``)*`|[<>:,]|[^`<>:,\s]+")


@lru_cache(maxsize=4096)
def _parsed(schema: str) -> tuple:
    """A shape as nested tuples: (ARRAY, inner), (OBJECT, fields) or (type,). Deep ones need no deep call stack."""
    stack: list[list] = [["", []]]
    name = None
    for token in _TOKEN.findall(schema):
        if token == "<":
            stack.append([stack[-1][1].pop()[0], [], name])
            name = None
        elif token == ">":
            kind, inner, name = stack.pop()
            stack[-1][1].append((kind, inner[0] if kind == "ARRAY" else tuple(sorted(zip(inner[::2], inner[1::2], strict=True)))))
        elif token == ":":
            stack[-1][1][-1] = stack[-1][1][-1][0]
        elif token != ",":
            stack[-1][1].append((token,))
    return stack[0][1][0]


def _agree(one: tuple, other: tuple) -> bool:
    """Whether one shape agrees with the other, in which empty lists stand for any list."""
    todo = [(one, other)]
    while todo:
        a, b = todo.pop()
        if a[0] != b[0] or len(a) != len(b):
            return False
        if a[0] == "ARRAY" and len(a) == 2:
            if a[1] != ("VOID",):
                todo.append((a[1], b[1]))
        elif len(a) == 2:
            if [n for n, _ in a[1]] != [n for n, _ in b[1]]:
                return False
            todo += [(x, y) for (_, x), (_, y) in zip(a[1], b[1], strict=True)]
    return True


@F.pandas_udf(BooleanType())
def same_structure(one: pd.Series, other: pd.Series) -> pd.Series:
    """Whether two shapes agree at any depth; an empty list agrees with any list, but only on one of the two sides."""
    return pd.Series(
        [
            None if a is None or b is None else a == b or _agree(_parsed(a), _parsed(b)) or _agree(_parsed(b), _parsed(a))
            for a, b in zip(one, other, strict=True)
        ],
        dtype="object",
    )


def _plain(schema: str) -> str:
    return f"regexp_replace({schema}, 'DECIMAL[(][0-9]+,[0-9]+[)]', 'DOUBLE')"
