"""Reference dates, milestones, periods and elapsed times."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def plus_days(col: Column | str, days: int) -> Column:
    """Timestamp moved by whole days, clock time kept."""
    return _c(col) + F.make_dt_interval(days=F.lit(days))


def reference_date(accepted: Column | str, handed_over: Column | str, *fallbacks: Column | str) -> Column:
    """Accepted, else handed over plus one day, else the first fallback."""
    return F.coalesce(_c(accepted), plus_days(handed_over, 1), *[_c(f) for f in fallbacks])


def earliest(*cols: Column | str) -> Column:
    """Smallest non-NULL value, NULL if all are NULL."""
    return F.least(*[_c(c) for c in cols])


def latest(*cols: Column | str) -> Column:
    return F.greatest(*[_c(c) for c in cols])


def cut_off_date(col: Column | str, clock: str = "23:59") -> Column:
    """Date of a timestamp, moved to the next day after the cut-off.

    The clock text is compared as text, so "23:59:00" is already later than
    "23:59", as in the rule this follows.
    """
    t = _c(col).cast("timestamp")
    day = t.cast("date")
    return F.when(F.date_format(t, "HH:mm:ss") <= F.lit(clock), day).otherwise(F.date_add(day, 1))


def elapsed_days(start: Column | str, end: Column | str, digits: int | None = None) -> Column:
    """Elapsed days with fractions, from whole seconds."""
    seconds = F.unix_timestamp(_c(end).cast("timestamp")) - F.unix_timestamp(_c(start).cast("timestamp"))
    days = seconds / F.lit(86400)
    return days if digits is None else F.round(days, digits)


def hours_after_boundary(reported: Column | str, event: Column | str, days: int) -> Column:
    """Whole hours the report came after the start of day ``event + days``.

    NULL when the report is on an earlier day.
    """
    boundary = F.date_add(_c(event).cast("date"), days)
    seconds = F.unix_timestamp(_c(reported).cast("timestamp")) - F.unix_timestamp(boundary.cast("timestamp"))
    return F.when(_c(reported).cast("date") >= boundary, F.floor(seconds / F.lit(3600)).cast("int"))


def year_quarter(col: Column | str, sep: str = "_Q") -> Column:
    d = _c(col)
    return F.concat(F.year(d).cast("string"), F.lit(sep), F.quarter(d).cast("string"))


def month_bucket(col: Column | str) -> Column:
    return F.date_format(_c(col), "yyyy-MM")


# -- periods: plain dates so they can be used as pushed-down literals ---------


def _month_start(day: dt.date, back: int = 0) -> dt.date:
    months = day.year * 12 + day.month - 1 - back
    return dt.date(months // 12, months % 12 + 1, 1)


def previous_month(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """``[start, end)`` of the month before ``as_of``."""
    return _month_start(as_of, 1), _month_start(as_of)


def previous_quarter(as_of: dt.date) -> tuple[dt.date, dt.date]:
    start = dt.date(as_of.year, (as_of.month - 1) // 3 * 3 + 1, 1)
    return _month_start(start, 3), start


def until_month_start(as_of: dt.date, first: dt.date) -> tuple[dt.date, dt.date]:
    return first, _month_start(as_of)


def in_period(col: Column | str, period: tuple[dt.date, dt.date]) -> Column:
    """Half-open test on the raw column, so file and row-group pruning apply."""
    c = _c(col)
    start, end = (F.lit(dt.datetime(d.year, d.month, d.day)) for d in period)
    return (c >= start) & (c < end)


def partition_values(period: tuple[dt.date, dt.date]) -> list[tuple[str, str]]:
    """(year, zero-padded month) text pairs covered by a period."""
    out, day = [], _month_start(period[0])
    while day < period[1]:
        out.append((f"{day.year:04d}", f"{day.month:02d}"))
        day = _month_start(day, -1)
    return out
