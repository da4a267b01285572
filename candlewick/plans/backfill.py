"""Requests that bring stale series up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame

from candlewick.dims import EXCHANGES
from candlewick.functions.calendar import interval_seconds
from candlewick.schema import SERIES

# A backfill starts this many intervals before the last stored close.
OVERLAP = 10
# Requests starting within this many intervals of now may ask for more rows.
RECENT = 250


def backfill_plan(profile: DataFrame, as_of: int) -> DataFrame:
    """One row per request of each series with ``stale``: start time and row limit.

    Needs ``high_water`` and ``stale``. Starts run from ten intervals before
    the high-water mark to ``as_of``, one full reply apart.
    """

    def limit(of: dict[str, int]) -> str:
        return "case exchange " + " ".join(f"when '{name}' then {n}" for name, n in of.items()) + " end"

    usual = limit({name: e.limit for name, e in EXCHANGES.items()})
    recent = limit({name: e.recent_limit or e.limit for name, e in EXCHANGES.items()})
    return (
        profile.where("stale")
        .selectExpr(*SERIES, "high_water", f"{interval_seconds()} as delta", f"{usual} as usual", f"{recent} as recent")
        .selectExpr(
            "*",
            f"explode(sequence(least(greatest(high_water - {OVERLAP} * delta, 0L), {as_of}L), {as_of}L, "
            "usual * delta)) as request_start",
        )
        .selectExpr(
            *SERIES, "request_start", f"if(request_start >= {as_of} - {RECENT} * delta, recent, usual) as limit"
        )
    )
