"""Last-wins deduplication and key merges."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.schema import KEY, KLINE_COLUMNS, META_KEY, UNCHECKED, VALUES


def last_wins(rows: DataFrame, order: Sequence[str], key: Sequence[str] = KEY) -> DataFrame:
    """One row per key: the one that comes last by ``order``, which must be unique per key.

    A plain aggregate, so copies of a hot key are reduced before the shuffle.
    """
    rest = ", ".join(c for c in rows.columns if c not in key and c not in order)
    latest = f"max_by(struct({rest}), struct({', '.join(order)})) as latest"
    return rows.groupBy(*key).agg(F.expr(latest)).select(*key, "latest.*")


def merge_rows(
    stored: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    replaced: Sequence[str],
    defaults: dict[str, str],
    place: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Stored rows after an upsert of ``incoming`` (both unique by key; an incoming key that comes twice fails the job).

    ``replaced`` columns come from the incoming row, missing values included;
    ``defaults`` columns keep their stored value and take the default (an
    expression) on insert. Both sides are put together and grouped by key, so
    each is shuffled once; ``place`` may lay out the rows itself, and if it
    does so by columns of the key, grouping needs no further shuffle.
    """
    both = stored.selectExpr(*key, *replaced, *defaults, "0 as turn").unionByName(
        incoming.selectExpr(*key, *replaced, *[f"{d} as {c}" for c, d in defaults.items()], "1 as turn")
    )
    grouped = (place(both) if place else both).groupBy(*key)
    newest = F.expr(f"max_by(struct({', '.join(replaced)}), turn) as newest")
    kept = [F.expr(f"min_by({c}, turn) as {c}") for c in defaults]
    merged = grouped.agg(newest, *kept, F.expr("sum(turn) as arrivals"))
    single = "assert_true(arrivals <= 1, 'several incoming rows have one key: give the columns that order them') is null"
    return merged.where(single).select(*key, "newest.*", *defaults)


def merge_klines(
    stored: DataFrame,
    incoming: DataFrame,
    key: Sequence[str] = KEY,
    place: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Upsert candles: new values replace old ones, a stored status is never touched.

    ``key`` may have columns besides the candle key that follow from it.
    """
    merged = merge_rows(stored, incoming, key, VALUES, {"status": f"'{UNCHECKED}'"}, place)
    return merged.select(*KLINE_COLUMNS, *[c for c in key if c not in KEY])


def merge_meta(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    return merge_rows(stored, incoming, META_KEY, ("data",), {})


def merge_status(
    stored: DataFrame,
    changes: DataFrame,
    key: Sequence[str] = KEY,
    place: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Stored candles with the status of ``changes`` (unique by key); keys not stored stay out."""
    both = stored.selectExpr(*key, *VALUES, "status", "0 as turn").unionByName(
        changes.selectExpr(*key, "status", "1 as turn"), allowMissingColumns=True
    )
    return (
        (place(both) if place else both)
        .groupBy(*key)
        .agg(
            F.expr(f"min_by(struct({', '.join(VALUES)}), turn) as old"),
            F.expr("max_by(status, turn) as status"),
            F.expr("min(turn) as turn"),
        )
        .where("turn = 0")
        .select(*key, "old.*", "status")
        .select(*KLINE_COLUMNS, *[c for c in key if c not in KEY])
    )
