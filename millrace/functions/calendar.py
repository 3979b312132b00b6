"""Working-day calendar compiled to plain column arithmetic.

A working-day count is the difference of two running indexes. The weekday part
of the index has a closed form; the holidays so far are read from a small array
with one entry per day between the first and the last holiday. There is no join
and no Python in the plan, and days outside the holiday list are simply days
without holidays.
"""

from __future__ import annotations

import bisect
import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# National holidays that fall on the same (month, day) each year.
FIXED_HOLIDAYS = [
    (1, 1),
    (1, 6),
    (4, 25),
    (5, 1),
    (6, 2),
    (8, 15),
    (11, 1),
    (12, 8),
    (12, 25),
    (12, 26),
]
# Holidays added later: (month, day, first year).
ADDED_HOLIDAYS = [(10, 4, 2026)]


def easter(year: int) -> dt.date:
    """Easter Sunday in the Gregorian calendar (anonymous computus)."""
    cycle, century, rest = year % 19, year // 100, year % 100
    lunar = (19 * cycle + century - century // 4 - (century - (century + 8) // 25 + 1) // 3 + 15) % 30
    shift = (32 + 2 * (century % 4) + 2 * (rest // 4) - lunar - rest % 4) % 7
    late = (cycle + 11 * lunar + 22 * shift) // 451
    month, day = divmod(lunar + shift - 7 * late + 114, 31)
    return dt.date(year, month, day + 1)


def national_holidays(first_year: int, last_year: int) -> list[dt.date]:
    """Fixed holidays plus Easter Sunday and Monday for each year."""
    days: list[dt.date] = []
    for year in range(first_year, last_year + 1):
        days += [dt.date(year, month, day) for month, day in FIXED_HOLIDAYS]
        days += [dt.date(year, month, day) for month, day, since in ADDED_HOLIDAYS if year >= since]
        days += [easter(year), easter(year) + dt.timedelta(days=1)]
    return sorted(days)


# Day number of 1970-01-01 counted from 0001-01-01.
_EPOCH = dt.date(1970, 1, 1).toordinal() - 1


def _as_date(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("date")


@dataclass(frozen=True)
class WorkCalendar:
    """Monday-to-Friday calendar minus a list of holidays."""

    holidays: tuple[dt.date, ...]
    _weekday_holidays: tuple[dt.date, ...] = field(init=False, repr=False)

    def __init__(self, holidays: Iterable[dt.date]):
        kept = tuple(sorted(set(holidays)))
        object.__setattr__(self, "holidays", kept)
        object.__setattr__(self, "_weekday_holidays", tuple(d for d in kept if d.weekday() < 5))

    @classmethod
    def national(cls, first_year: int, last_year: int) -> WorkCalendar:
        return cls(national_holidays(first_year, last_year))

    # -- driver-side helpers, bounded by the span of the holiday list ----------

    def _is_work(self, day: dt.date) -> bool:
        return day.weekday() < 5 and day not in self._weekday_holidays

    def _spans(self) -> tuple[int, list[int], list[int]]:
        """First day number, then per day: weekday holidays so far, days to wait.

        Entry 0 is the day before the first holiday; clamping a day to the
        table therefore counts none before it and all after it.
        """
        if not self._weekday_holidays:
            return 0, [0], [0]
        days = [d.toordinal() - 1 for d in self._weekday_holidays]
        first, closed = min(days) - 1, set(days)
        counts, waits, running = [], [], 0
        for number in range(first, max(days) + 1):
            running += number in closed
            counts.append(running)
            probe = dt.date.fromordinal(number + 1)
            wait = 0
            while not self._is_work(probe + dt.timedelta(days=wait)):
                wait += 1
            waits.append(wait)
        # After the table only weekends remain.
        return first, [*counts, running], [*waits, 0]

    # -- column expressions ---------------------------------------------------
    #
    # Each expression names its input only a few times and has no branches, so
    # generated code stays small and common parts are computed once.

    def _number(self, day: Column) -> Column:
        """Days since 0001-01-01, a Monday."""
        return F.unix_date(day) + F.lit(_EPOCH)

    def _lookup(self, number: Column, first: int, table: list[int]) -> Column:
        slot = F.greatest(F.least(number - F.lit(first), F.lit(len(table) - 1)), F.lit(0))
        # One text literal instead of thousands of number literals; the optimiser
        # folds it into a constant array.
        folded = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")
        return F.get(folded, slot)

    def _index(self, number: Column) -> Column:
        first, counts, _ = self._spans()
        weeks = F.call_function("div", number, F.lit(7)).cast("int")
        in_week = F.get(F.lit([1, 2, 3, 4, 5, 5, 5]), F.pmod(number, F.lit(7)))
        return weeks * 5 + in_week - self._lookup(number, first, counts)

    def index(self, day: Column | str) -> Column:
        """Running number of working days up to and including ``day``."""
        return self._index(self._number(_as_date(day)))

    def is_workday(self, day: Column | str) -> Column:
        number = self._number(_as_date(day))
        return self._index(number) > self._index(number - 1)

    def days_between(self, start: Column | str, end: Column | str) -> Column:
        """Working days in ``(start, end]``; 0 if end precedes start, NULL on NULL.

        The index never falls, so an end on or before the start gives a
        difference of at most zero.
        """
        return self.span(self.index(start), self.index(end))

    @staticmethod
    def span(start_index: Column, end_index: Column) -> Column:
        """:meth:`days_between` from indexes computed before."""
        days = end_index - start_index
        return days * (days > 0).cast("int")

    def next_workday(self, day: Column | str) -> Column:
        """First working day on or after ``day``."""
        d = _as_date(day)
        number = self._number(d)
        first, counts, waits = self._spans()
        # Inside the table the wait is looked up, outside only weekends count.
        weekend = F.get(F.lit([0, 0, 0, 0, 0, 2, 1]), F.pmod(number, F.lit(7)))
        inside = (number >= first) & (number < first + len(counts) - 1)
        return F.date_add(d, F.when(inside, self._lookup(number, first, waits)).otherwise(weekend))

    def nth_workday(self, index: Column | str) -> Column:
        """The working day with a running number; the inverse of :meth:`index`, without a horizon.

        Beside the holiday list a number is five per week. Inside it the days
        before the number is reached are found in the table of the holidays.
        """
        n = F.col(index) if isinstance(index, str) else index
        if not self._weekday_holidays:
            return self._weekday_of(n)
        # Each holiday at or before the day found pushes it on by one weekday: a table of
        # how many did by the time a number is reached.
        keys = [self._weekday_number(d) - i for i, d in enumerate(self._weekday_holidays)]
        table = [bisect.bisect_right(keys, number) for number in range(keys[0] - 1, keys[-1] + 1)]
        passed = self._lookup(n, keys[0] - 1, table)
        return self._weekday_of(n + passed)

    @staticmethod
    def _weekday_number(day: dt.date) -> int:
        """Running number of weekdays up to and including a weekday, without holidays."""
        number = day.toordinal() - 1
        return number // 7 * 5 + number % 7 + 1

    @staticmethod
    def _weekday_of(n: Column) -> Column:
        """The weekday with a running number of weekdays."""
        weeks = F.call_function("div", n - 1, F.lit(5))
        return F.date_from_unix_date((weeks * 7 + F.pmod(n - 1, F.lit(5)) - F.lit(_EPOCH)).cast("int"))

    # -- as data --------------------------------------------------------------

    def frame(self, spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
        """One row per day: ``day, is_workday, workday_index, next_workday``.

        ``workday_index`` is comparable with :meth:`index`.
        """
        days = spark.range((last - first).days + 1).select(
            F.date_add(F.lit(first), F.col("id").cast("int")).alias("day")
        )
        return days.select(
            "day",
            self.is_workday("day").alias("is_workday"),
            self.index("day").alias("workday_index"),
            self.next_workday("day").alias("next_workday"),
        )
