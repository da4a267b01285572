"""Calendar expressions on epoch seconds. All are UTC whatever the session zone."""

from __future__ import annotations

from candlewick.dims import INTERVAL_SECONDS

DAY = 86400
# First second of the year 10000: larger "seconds" are really milliseconds.
_YEAR_10000 = 253402300800


def date_of(epoch: str) -> str:
    """UTC date of an epoch second."""
    return f"date_from_unix_date(cast(floor(({epoch}) / {DAY}) as int))"


def epoch_of(date: str) -> str:
    """First second of a date."""
    return f"(cast(unix_date({date}) as bigint) * {DAY})"


def time_text(epoch: str) -> str:
    """``YYYY-MM-DD HH:MM:SS`` of an epoch second."""
    return f"cast(timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {epoch}) as string)"


def year_of(epoch: str) -> str:
    return f"year({date_of(epoch)})"


def month_of(epoch: str) -> str:
    return f"month({date_of(epoch)})"


def day_of(epoch: str) -> str:
    return f"dayofmonth({date_of(epoch)})"


def month_start(date: str) -> str:
    return f"trunc({date}, 'MM')"


def next_month_time(epoch: str) -> str:
    """First second of the month after the one ``epoch`` falls in."""
    return epoch_of(next_month(date_of(epoch)))


def previous_month(date: str) -> str:
    return f"add_months({month_start(date)}, -1)"


def next_month(date: str) -> str:
    return f"add_months({month_start(date)}, 1)"


def previous_day(date: str) -> str:
    return f"date_add({date}, -1)"


def next_day_until(date: str, today: str) -> str:
    """The next day, but today stays today."""
    return f"if({date} = {today}, {date}, date_add({date}, 1))"


def next_month_until(date: str, today: str) -> str:
    """The next month, but the current month stays the current month."""
    return f"if({month_start(date)} = {month_start(today)}, {month_start(date)}, {next_month(date)})"


def seconds_from_midnight(date: str, as_of: str) -> str:
    """Seconds from the start of ``date`` to ``as_of``, one day at most."""
    return f"least({as_of} - {epoch_of(date)}, {DAY})"


def months_ago(date: str, today: str) -> str:
    """Whole calendar months from the month of ``date`` to the month of ``today``."""
    return f"((year({today}) - year({date})) * 12 + month({today}) - month({date}))"


def part_of(interval: str, epoch: str) -> str:
    """Folder a candle is stored in: the month (202401) of minute candles, the year
    (2024) of hour candles, 0 for longer ones. Grows with time within an interval."""
    day = date_of(epoch)
    month = f"year({day}) * 100 + month({day})"
    return f"case right({interval}, 1) when 'm' then {month} when 's' then {month} when 'h' then year({day}) else 0 end"


def interval_seconds(interval: str = "interval", anchor: str | None = None, month_days: int = 28) -> str:
    """Length of an interval in seconds.

    With ``anchor`` (an epoch second) ``Nmo`` is the length of the N calendar
    months from the anchor's month on; without, N times ``month_days`` days.
    A bare number counts seconds.
    """
    number = f"cast(regexp_replace({interval}, '[^0-9]', '') as bigint)"

    def months(n: str) -> str:
        if anchor is None:
            return f"{n} * {month_days * DAY}L"
        first = month_start(date_of(anchor))
        return f"datediff(add_months({first}, cast({n} as int)), {first}) * {DAY}L"

    known = " ".join(f"when '{code}' then {seconds}L" for code, seconds in INTERVAL_SECONDS.items())
    units = {"m": 60, "h": 3600, "d": DAY, "w": 7 * DAY}
    others = " ".join(f"when '{unit}' then {number} * {seconds}L" for unit, seconds in units.items())
    # The usual codes are settled by comparison; only other codes reach the regular expressions.
    return (
        f"(case {interval} {known} when '1mo' then {months('1')} else "
        f"case regexp_replace({interval}, '[0-9]', '') {others} when 'mo' then {months(number)} else {number} end end)"
    )


def rounded_seconds(millis: str) -> str:
    """Milliseconds to seconds, halves to the even second."""
    whole, rest = f"cast(floor(({millis}) / 1000) as bigint)", f"pmod({millis}, 1000)"
    return f"({whole} + if({rest} > 500 or ({rest} = 500 and {whole} % 2 != 0), 1L, 0L))"


def archive_seconds(raw: str) -> str:
    """Archive times to seconds: milliseconds, or microseconds in newer files."""
    value = rounded_seconds(raw)
    return f"if({value} >= {_YEAR_10000}, cast(floor({value} / 1000) as bigint), {value})"
