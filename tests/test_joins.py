"""Joins against brute force on small frames."""

import datetime as dt
import random

import pytest

from millrace.operators import joins

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def points_and_spans():
    rnd = random.Random(9)
    points = [(i, rnd.choice("xxxyz"), at(rnd.randint(0, 4_000_000))) for i in range(150)]
    spans = []
    for j in range(80):
        lo = rnd.randint(-1_000, 4_000_000)
        width = rnd.choice([0, 1, 63, 64, 4096, 300_000, 10**9])
        spans.append((j, rnd.choice("xxxy"), at(lo), at(lo + width)))
    # Boundary rows: a point exactly on a start and on an end.
    points += [(900, "x", at(5000)), (901, "x", at(6000))]
    spans += [(900, "x", at(5000), at(6000)), (901, "x", at(10), dt.datetime(2999, 12, 31))]
    return points, spans


def frames(spark, data):
    points = spark.createDataFrame(data[0], "id int, k string, t timestamp")
    spans = spark.createDataFrame(data[1], "sid int, k string, lo timestamp, hi timestamp")
    return points, spans


@pytest.mark.parametrize("limit", [0, 100_000])
def test_interval_join(spark, points_and_spans, limit):
    points, spans = frames(spark, points_and_spans)
    got = joins.interval_join(points, spans, on={"k": "k"}, at="t", start="lo", end="hi", broadcast_rows=limit)
    want = sorted(
        (p[0], s[0]) for p in points_and_spans[0] for s in points_and_spans[1] if p[1] == s[1] and s[2] <= p[2] < s[3]
    )
    assert sorted((r["id"], r["sid"]) for r in got.select("id", "sid").collect()) == want


@pytest.mark.parametrize("hot", [None, 40])
def test_coverage(spark, points_and_spans, hot):
    points, spans = frames(spark, points_and_spans)
    got = joins.coverage(points, spans, on={"k": "k"}, at="t", start="lo", end="hi", hot_rows=hot, piece_rows=20)
    known = {s[1] for s in points_and_spans[1]}

    def label(p):
        if any(p[1] == s[1] and s[2] <= p[2] < s[3] for s in points_and_spans[1]):
            return "valid"
        return "present_not_valid" if p[1] in known else "absent"

    assert {r["id"]: r["coverage"] for r in got.collect()} == {p[0]: label(p) for p in points_and_spans[0]}


def test_rule_join_prefers_specific_and_keeps_rows(spark):
    facts = spark.createDataFrame(
        [(1, "a", "p", "r", at(0)), (2, "a", "q", None, at(0)), (3, "a", "p", "r", at(100)), (4, "b", "p", "r", at(0)), (5, None, "p", "r", at(0)), (6, "a", "p", "r", None), (7, "a", "p", "r", at(101))],
        "id int, lot string, product string, region string, t timestamp",
    )
    rules = spark.createDataFrame(
        [
            (1, "a", None, None, at(0), at(100), 5),
            (2, "a", "p", None, at(0), at(50), 7),
            (3, "a", "p", "r", at(0), at(10), 9),
            (4, "a", "p", None, at(0), at(100), 8),
        ],
        "rid int, lot string, product string, region string, lo timestamp, hi timestamp, days int",
    )
    got = joins.rule_join(
        facts, rules, equal={"lot": "lot"}, wildcard={"product": "product", "region": "region"}, between=("t", "lo", "hi"), values=["days"], rule_id="rid"
    )
    assert {r["id"]: r["days"] for r in got.collect()} == {1: 9, 2: 5, 3: 8, 4: None, 5: None, 6: None, 7: None}
    assert got.columns == [*facts.columns, "days"]


@pytest.mark.parametrize("keys", [[], [1], [1, None], [None]])
def test_not_in_follows_sql(spark, keys):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(k,) for k in keys], "j int")
    left.createOrReplaceTempView("l_t")
    right.createOrReplaceTempView("r_t")
    want = spark.sql("SELECT k FROM l_t WHERE k NOT IN (SELECT j FROM r_t)").collect()
    got = joins.not_in(left, "k", right, "j").collect()
    assert sorted(got, key=str) == sorted(want, key=str)


def test_not_in_plain_keeps_null(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (None,)], "j int")
    got = joins.not_in(left, "k", right, "j", null_aware=False).collect()
    assert sorted(r["k"] is None for r in got) == [False, True]


def test_full_outer_coalesces(spark):
    a = spark.createDataFrame([(1, 10), (2, 20)], "k int, x int")
    b = spark.createDataFrame([(2, 5), (3, 6)], "k int, y int")
    got = joins.full_outer(a, b, ["k"], {"x": "x"}, {"y": "y"}).collect()
    assert sorted(map(tuple, got)) == [(1, 10, None), (2, 20, 5), (3, None, 6)]


@pytest.mark.parametrize("timed", [True, False])
def test_rule_index_equals_the_lists(spark, monkeypatch, timed):
    rnd = random.Random(21)
    rules = []
    for i in range(300):
        lo = rnd.randint(0, 900_000)
        rules.append((rnd.randint(0, 10**6), rnd.choice("xxxxyz"), rnd.choice([None, "a", "b"]), rnd.choice([None, None, 1, 2]), at(lo), at(lo + rnd.choice([-5, 0, 1, 5000, 400_000])), i))
    rules = list({r[0]: r for r in rules}.values()) + [(-1, "x", None, None, None, at(5), 999), (-2, None, None, None, at(0), at(900_000), 998)]
    facts = [(i, rnd.choice(["x", "x", "y", "z", "w", None]), rnd.choice(["a", "b", "c", None]), rnd.choice([1, 2, 3, None]), None if i % 50 == 0 else at(rnd.randint(0, 1_300_000))) for i in range(400)]
    facts += [(1000 + i, r[1], r[2] or "c", r[3] or 3, t) for i, r in enumerate(rules[:60]) for t in (r[4], r[5])]
    table = spark.createDataFrame(rules, "id int, k string, a string, b int, lo timestamp, hi timestamp, value int")
    points = spark.createDataFrame(facts, "fact int, k string, a string, b int, t timestamp")
    how = dict(equal={"k": "k"}, wildcard={"a": "a", "b": "b"}, between=("t", "lo", "hi") if timed else None, values=["value"], rule_id="id")
    results = []
    for limit in (10**6, 0):
        monkeypatch.setattr(joins, "RULES_PER_KEY", limit)
        results.append(sorted(map(tuple, joins.rule_join(points, table, **how).collect()), key=str))
    assert results[0] == results[1] and len(results[0]) == len(facts)

    def best(fact):
        _, k, a, b, t = fact
        fit = [r for r in rules if r[1] == k and k is not None and r[2] in (None, a) and r[3] in (None, b) and (not timed or (t is not None and r[4] is not None and r[4] <= t <= r[5]))]
        return min(fit, key=lambda r: ((r[2] is None) + (r[3] is None), r[0]))[6] if fit else None

    assert results[0] == sorted(((*f, best(f)) for f in facts), key=str)


def test_index_of_no_rules(spark, monkeypatch):
    monkeypatch.setattr(joins, "RULES_PER_KEY", -1)
    table = spark.createDataFrame([], "id int, k string, a string, value int")
    points = spark.createDataFrame([("x", "a")], "k string, a string")
    got = joins.rule_join(points, table, equal={"k": "k"}, wildcard={"a": "a"}, values=["value"], rule_id="id")
    assert [tuple(r) for r in got.collect()] == [("x", "a", None)]
