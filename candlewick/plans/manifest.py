"""Which archive files cover the history of a series."""

from __future__ import annotations

from pyspark.sql import DataFrame

from candlewick.dims import EXCHANGES, MONTHLY_ONLY
from candlewick.functions.calendar import DAY, date_of, month_start, previous_month
from candlewick.functions.text import native_symbol
from candlewick.schema import SERIES

# The current month's file is looked for from this day on.
MONTHLY_FROM_DAY = 8
# Yesterday's file is looked for from this hour on.
DAILY_FROM_HOUR = 15


def _file(date: str, pattern: str) -> str:
    return f"concat({native_symbol()}, '-', interval, '-', date_format({date}, '{pattern}'), '.zip')"


def archive_manifest(
    requests: DataFrame, as_of: int, available: DataFrame | None = None, force_daily: bool = False
) -> DataFrame:
    """Files to load for each requested series.

    ``requests`` has the series, ``last_open`` (0 if nothing is stored) and
    ``first_month_time``. Months run from the one before the last stored
    candle, or the first-listed one, to the one before ``as_of``. A month is
    covered by its monthly file; daily files stand in if ``available`` (file)
    does not list that file, or are added if ``force_daily``.
    Without ``available`` all candidate files are returned.
    """
    today = date_of(str(as_of))
    sources = ", ".join(f"'{name}'" for name, e in EXCHANGES.items() if e.has_archive)
    months = (
        requests.where(f"exchange in ({sources})")
        .selectExpr(
            *SERIES,
            f"if(last_open > 0, {previous_month(date_of('last_open'))}, {month_start(date_of('first_month_time'))})"
            " as start",
        )
        .selectExpr(
            *SERIES, f"explode(sequence(start, greatest(start, {previous_month(today)}), interval 1 month)) as month"
        )
        .selectExpr("*", f"{_file('month', 'yyyy-MM')} as file")
    )
    too_early = f"month = {month_start(today)} and dayofmonth({today}) < {MONTHLY_FROM_DAY}"
    monthly = months.where(f"not ({too_early})")

    if available is None:
        covered, to_split = monthly, months
    else:
        landed = available.select("file").distinct()
        covered = monthly.join(landed, "file", "left_semi")
        missing = months.where(too_early).unionByName(monthly.join(landed, "file", "left_anti"))
        to_split = months if force_daily else missing

    # Past months to their last day, the current month to yesterday or the day before.
    back = 1 if as_of % DAY // 3600 >= DAILY_FROM_HOUR else 2
    last_day = f"least(last_day(month), date_add({today}, -{back}))"
    longer = ", ".join(f"'{i}'" for i in MONTHLY_ONLY)
    daily = (
        to_split.where(f"interval not in ({longer}) and month <= {last_day}")
        .selectExpr(*SERIES, "month", f"explode(sequence(month, {last_day}, interval 1 day)) as day")
        .selectExpr(*SERIES, "month", f"{_file('day', 'yyyy-MM-dd')} as file")
    )
    if available is not None:
        daily = daily.join(landed, "file", "left_semi")
    return covered.selectExpr(*SERIES, "month", "'monthly' as kind", "file").unionByName(
        daily.selectExpr(*SERIES, "month", "'daily' as kind", "file")
    )
