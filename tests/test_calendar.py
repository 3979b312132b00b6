"""Working-day arithmetic against a day-by-day count."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions.calendar import WorkCalendar, easter, national_holidays

CAL = WorkCalendar.national(2023, 2026)


def work(day, holidays=frozenset(CAL.holidays)):
    return day.weekday() < 5 and day not in holidays


def count(start, end):
    if start is None or end is None:
        return None
    return sum(work(start + dt.timedelta(days=i)) for i in range(1, (end - start).days + 1))


def test_easter_and_monday():
    # Published dates of Easter Sunday.
    known = {2023: (4, 9), 2024: (3, 31), 2025: (4, 20), 2026: (4, 5), 1999: (4, 4), 2000: (4, 23)}
    assert {y: (easter(y).month, easter(y).day) for y in known} == known
    assert len(national_holidays(2023, 2026)) == 49


CASES = [
    (None, dt.date(2024, 5, 2)),
    (dt.date(2024, 5, 2), None),
    (dt.date(2024, 5, 2), dt.date(2024, 5, 2)),
    (dt.date(2024, 5, 8), dt.date(2024, 5, 2)),
    (dt.date(2024, 5, 3), dt.date(2024, 5, 6)),  # Friday to Monday
    (dt.date(2024, 5, 1), dt.date(2024, 5, 5)),  # holiday to Sunday
    (dt.date(2024, 12, 24), dt.date(2024, 12, 27)),  # two holidays in a row
    (dt.date(2024, 6, 1), dt.date(2024, 6, 3)),  # holiday on Sunday
    (dt.date(2022, 12, 30), dt.date(2023, 1, 9)),  # starts before the list
    (dt.date(2026, 12, 24), dt.date(2027, 1, 8)),  # ends after the list
    (dt.date(2019, 2, 1), dt.date(2031, 8, 1)),
]


def test_days_between(spark):
    rows = [(i, s, e) for i, (s, e) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, s date, e date").withColumn("n", CAL.days_between("s", "e"))
    assert {r["i"]: r["n"] for r in df.collect()} == {i: count(s, e) if not (s and e and e < s) else 0 for i, (s, e) in enumerate(CASES)}


@pytest.mark.parametrize("holidays", [CAL.holidays, (), (dt.date(2024, 12, 24), dt.date(2024, 12, 25), dt.date(2024, 12, 26), dt.date(2024, 12, 27))])
def test_next_workday_and_flags(spark, holidays):
    calendar, known = WorkCalendar(holidays), frozenset(holidays)
    days = calendar.frame(spark, dt.date(2022, 11, 1), dt.date(2027, 2, 28)).collect()
    running = None
    for row in days:
        assert row["is_workday"] == work(row["day"], known), row
        probe = row["day"]
        while not work(probe, known):
            probe += dt.timedelta(days=1)
        assert row["next_workday"] == probe, row
        if running is not None:
            assert row["workday_index"] == running + row["is_workday"]
        running = row["workday_index"]


def test_timestamps_are_cut_to_days(spark):
    df = spark.sql("SELECT timestamp'2024-05-02 23:00:00' AS s, timestamp'2024-05-03 01:00:00' AS e")
    assert df.select(CAL.days_between("s", "e").alias("n")).first()["n"] == 1


def test_plan_has_no_python_and_no_join(spark):
    df = spark.range(10).select(F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("d"))
    plan = df.select(CAL.days_between("d", F.lit(dt.date(2024, 6, 1))))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan
