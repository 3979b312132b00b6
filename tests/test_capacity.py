"""Daily capacity against a plain item-by-item fold."""

import datetime as dt
import random

import numpy as np
import pytest

from millrace.functions.calendar import WorkCalendar
from millrace.operators import capacity

CAL = WorkCalendar.national(2024, 2025)


def next_work(day):
    while not CAL._is_work(day):
        day += dt.timedelta(days=1)
    return day


def brute(items, limit, last=None, used=0):
    """items: (eligible, order key, pages) in any order."""
    out, day = {}, last
    queue = []
    for eligible, key, pages in items:
        e = next_work(eligible)
        queue.append((max(e, last) if last else e, key, pages))
    for e, key, pages in sorted(queue):
        if day is None or e > day:
            day, used = e, 0
        elif used > 0 and used + pages > limit:
            day, used = next_work(day + dt.timedelta(days=1)), 0
        used += pages
        out[key] = day
    return out, day, used


def make(n, days, seed, big=0.0, zero=0.0):
    rnd = random.Random(seed)
    start = dt.date(2024, 12, 20)
    rows = []
    for key in range(n):
        pages = 0 if rnd.random() < zero else (150 if rnd.random() < big else rnd.randint(1, 40))
        rows.append((start + dt.timedelta(days=rnd.randint(0, days)), key, pages))
    return rows


def frame(spark, rows, lane=None):
    if lane is None:
        return spark.createDataFrame(rows, "eligible date, key int, pages int")
    return spark.createDataFrame([(lane, *r) for r in rows], "lane string, eligible date, key int, pages int")


def result(df):
    return {r["key"]: r["assigned_day"] for r in df.collect()}


@pytest.mark.parametrize(
    "n,days,chunk,big,zero",
    [(300, 40, 10**6, 0.0, 0.0), (300, 40, 20, 0.0, 0.0), (400, 3, 25, 0.0, 0.05), (250, 0, 16, 0.05, 0.1), (300, 200, 15, 0.1, 0.0)],
)
def test_matches_fold(spark, n, days, chunk, big, zero):
    rows = make(n, days, seed=n + days, big=big, zero=zero)
    got = capacity.assign_days(
        frame(spark, rows), CAL, eligible="eligible", order=["key"], pages="pages", capacity=100, chunk_items=chunk
    )
    want, _, _ = brute(rows, 100)
    assert result(got) == want
    ranks = sorted(r["rank"] for r in got.collect())
    assert ranks == list(range(1, n + 1))


def test_lanes_are_independent(spark):
    a, b = make(120, 5, 1), make(150, 60, 2)
    both = frame(spark, a, "a").unionByName(frame(spark, b, "b"))
    got = capacity.assign_days(
        both, CAL, eligible="eligible", order=["key"], pages="pages", capacity=100, lane=["lane"], chunk_items=30
    ).collect()
    for name, rows in (("a", a), ("b", b)):
        assert {r["key"]: r["assigned_day"] for r in got if r["lane"] == name} == brute(rows, 100)[0]


@pytest.mark.parametrize("chunk", [10**6, 12])
def test_resume_equals_sequential_state(spark, chunk):
    rows = make(260, 12, 7)
    cut = dt.date(2024, 12, 27)
    early = [r for r in rows if r[0] <= cut]
    later = [r for r in rows if r[0] > cut]
    kw = dict(eligible="eligible", order=["key"], pages="pages", capacity=100, chunk_items=chunk)
    first = capacity.assign_days(frame(spark, early), CAL, **kw)
    state = capacity.last_state(first, pages="pages")
    second = capacity.assign_days(frame(spark, later), CAL, state=state, **kw)
    want, day, used = brute(early, 100)
    saved = state.first()
    assert (saved["last_day"], saved["used_pages"], saved["last_rank"]) == (day, used, len(early))
    assert result(second) == brute(later, 100, day, used)[0]
    assert min(r["rank"] for r in second.collect()) == len(early) + 1


def test_capacity_never_exceeded(spark):
    rows = make(500, 20, 11)
    got = capacity.assign_days(frame(spark, rows), CAL, eligible="eligible", order=["key"], pages="pages", capacity=90, chunk_items=40)
    load = capacity.daily_load(got, pages="pages").collect()
    assert max(r["pages"] for r in load) <= 90
    assert sum(r["items"] for r in load) == 500


def test_empty_input(spark):
    df = frame(spark, make(3, 2, 1)).limit(0)
    got = capacity.assign_days(df, CAL, eligible="eligible", order=["key"], pages="pages", capacity=10)
    assert got.count() == 0 and got.columns == ["eligible", "key", "pages", "assigned_day", "rank"]


def test_transfer_equals_fold_for_every_fill():
    rng = np.random.default_rng(3)
    for _ in range(60):
        pages = rng.integers(0, 12, rng.integers(1, 30))
        limit = 20
        if rng.random() < 0.3:
            pages[rng.integers(0, len(pages))] = 33
        steps = capacity._transfer(pages, limit)
        for used in [*range(0, limit + 1), 33]:
            at = capacity._fold(np.zeros(len(pages), dtype=np.int64), pages, limit, 0, used)
            end = pages[at == at[-1]].sum() + (used if at[-1] == 0 else 0)
            assert capacity._step(steps, used) == (at[-1], end), (pages, used)
            assert (capacity._deal(pages, limit, used) == at).all()


def test_missing_pages_days_and_state(spark):
    schema = "eligible date, key int, pages int"
    day = dt.date(2024, 5, 2)
    df = spark.createDataFrame([(dt.date(2024, 4, 30), 1, 100), (day, 2, 40), (day, 3, None), (day, 4, 90), (None, 5, 10)], schema)
    how = dict(eligible="eligible", order=["key"], pages="pages", capacity=100)
    plain = capacity.assign_days(df, CAL, **how)
    got = {r["key"]: (r["assigned_day"], r["rank"], r["pages"]) for r in plain.collect()}
    assert got[3] == (day, 3, None) and got[4] == (dt.date(2024, 5, 3), 4, 90) and got[5] == (None, None, 10)
    with pytest.raises(Exception, match="has no pages"):
        capacity.assign_days(df, CAL, null_pages=None, **how).collect()
    state = capacity.last_state(plain.filter("rank is not null"), pages="pages")
    empty = capacity.assign_days(df, CAL, state=state.limit(0), **how)
    assert {r["key"]: (r["assigned_day"], r["rank"], r["pages"]) for r in empty.collect()} == got
    with pytest.raises(Exception, match="several state rows"):
        capacity.assign_days(df, CAL, state=state.union(state), **how).collect()


def test_no_last_day(spark):
    rows = [(dt.date(2100, 12, 30), i, 100) for i in range(5)]
    got = capacity.assign_days(frame(spark, rows), CAL, eligible="eligible", order=["key"], pages="pages", capacity=100)
    assert max(result(got).values()) == dt.date(2101, 1, 5)


def test_transfers_compose():
    rng = np.random.default_rng(8)
    limit = 20
    for _ in range(60):
        chunks, day = [], 0
        for _ in range(rng.integers(2, 7)):
            day += int(rng.integers(0, 4))
            pages = rng.integers(0, 15, rng.integers(1, 25))
            if rng.random() < 0.2:
                pages[rng.integers(0, len(pages))] = 31
            chunks.append((day, pages))
        parts = [capacity._stretch(capacity._transfer(p, limit), d) for d, p in chunks]
        cut = int(rng.integers(1, len(parts)))
        whole = capacity._then(capacity.reduce(capacity._then, parts[:cut]), capacity.reduce(capacity._then, parts[cut:]))
        assert whole == capacity.reduce(capacity._then, parts)
        for at in range(-1, day + 4):
            for used in [*range(0, limit + 1), 31]:
                a, u = at, used
                for d, pages in chunks:
                    if d > a:
                        a, u = d, 0
                    got = capacity._fold(np.zeros(len(pages), dtype=np.int64), pages, limit, 0, u)
                    u = int(pages[got == got[-1]].sum()) + (u if got[-1] == 0 else 0)
                    a += int(got[-1])
                assert capacity._through(whole, at, used) == (a, u)


@pytest.mark.parametrize("fan_in", [2, 3, 256])
@pytest.mark.parametrize("days,resumed", [(0, False), (25, True)])
def test_tree_of_transfers(spark, monkeypatch, fan_in, days, resumed):
    monkeypatch.setattr(capacity, "FAN_IN", fan_in)
    rows = make(400, days, seed=fan_in + days, big=0.03, zero=0.05)
    state = None
    last, used = None, 0
    if resumed:
        last, used = dt.date(2024, 12, 23), 35
        state = spark.createDataFrame([(last, used, 9)], "last_day date, used_pages bigint, last_rank bigint")
    got = capacity.assign_days(frame(spark, rows), CAL, eligible="eligible", order=["key"], pages="pages", capacity=100, chunk_items=15, state=state)
    assert result(got) == brute(rows, 100, last, used)[0]


def test_only_key_order_and_pages_go_through(spark):
    rows = make(200, 9, 4)
    wide = frame(spark, rows).selectExpr("*", "concat('x', key) as text", "array(key) as list")
    how = dict(eligible="eligible", order=["key"], pages="pages", capacity=100)
    slim = capacity.assign_days(wide, CAL, key=["key"], **how)
    assert result(slim) == brute(rows, 100)[0] and slim.columns == [*wide.columns, "assigned_day", "rank"]
    assert all(r["text"] == f"x{r['key']}" and r["list"] == [r["key"]] for r in slim.collect())
    plan = slim._jdf.queryExecution().optimizedPlan().toString()
    through = next(line for line in plan.split("\n") if "FlatMapGroupsInArrow" in line)
    assert "text" not in through and "list" not in through
