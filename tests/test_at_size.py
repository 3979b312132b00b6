"""What keeps jobs in proportion to their input: shapes of plans, written rows, generated code."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions.calendar import WorkCalendar
from millrace.operators import capacity, joins, older_tender, ordered, reports
from millrace.plans import domain, penalties, tender, windows

T0 = dt.datetime(2024, 1, 1)


def methods(df):
    """Bytes of the longest generated method of each stage."""
    stages = df._jdf.queryExecution().debug().codegenToSeq()
    return [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]


def test_small_chunks_of_a_large_lane_are_bounded_in_number():
    assert capacity._pieces(1_000, 100) == 20 and capacity._pieces(1, 500) == 2
    assert capacity._pieces(36_000_000, 500) == capacity.MAX_PIECES
    assert capacity._pieces(4_000_000_000, 500) * capacity.CHUNK_ITEMS == 2 * 4_000_000_000


def test_pieces_beyond_the_bound_give_the_same_days(spark, monkeypatch):
    rows = [(dt.date(2024, 1, 2) + dt.timedelta(days=i % 3), i, 1 + i * 7 % 40) for i in range(300)]
    df, calendar = spark.createDataFrame(rows, "eligible date, key int, pages int"), WorkCalendar.national(2024, 2025)

    def days():
        out = capacity.assign_days(df, calendar, eligible="eligible", order=["key"], pages="pages", capacity=100, chunk_items=10)
        return sorted(out.collect())

    many = days()
    monkeypatch.setattr(capacity, "MAX_PIECES", 3)
    assert days() == many


def test_no_calendar_in_the_filters_of_the_capacity_queries(spark, folder):
    out = capacity.assign_days(domain.entrusted(spark, folder), domain.CALENDAR, eligible="entry_day", order=domain.TIE, pages="pages", capacity=60, lane=["supp_key"])
    filters = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter " in line]
    assert filters and not any("unix_date" in line for line in filters)


def test_keys_with_few_spans_are_not_cut_into_blocks(spark, monkeypatch):
    spans = spark.createDataFrame([(i, i % 10, T0, T0 + dt.timedelta(days=30)) for i in range(50)], "sid int, k int, lo timestamp, hi timestamp")
    points = spark.createDataFrame([(i, i % 10, T0 + dt.timedelta(days=i)) for i in range(40)], "id int, k int, t timestamp")
    monkeypatch.setattr(joins, "_span_blocks", lambda *a: pytest.fail("cut"))
    assert joins.interval_join(points, spans, on={"k": "k"}, at="t", start="lo", end="hi", broadcast_rows=0).count() == 30 * 5


def test_keys_with_few_and_many_spans(spark, monkeypatch):
    monkeypatch.setattr(joins, "SPANS_PER_KEY", 5)
    at = lambda s: T0 + dt.timedelta(seconds=s)
    spans = [(i, i % 4 if i < 12 else 7, at(i * 311), at(i * 311 + 3 ** (i % 15))) for i in range(90)] + [(900, None, at(0), at(9)), (901, 7, at(0), at(10**9))]
    points = [(i, i % 9, at(i * 97)) for i in range(400)] + [(900, None, at(5))]
    got = joins.interval_join(
        spark.createDataFrame(points, "id int, k int, t timestamp"), spark.createDataFrame(spans, "sid int, k int, lo timestamp, hi timestamp"),
        on={"k": "k"}, at="t", start="lo", end="hi", broadcast_rows=0,
    )
    want = sorted((p[0], s[0]) for p in points for s in spans if p[1] is not None and p[1] == s[1] and s[2] <= p[2] < s[3])
    assert sorted((r["id"], r["sid"]) for r in got.collect()) == want


def test_an_interval_has_few_blocks(spark):
    row = spark.range(1).select(F.size(joins._span_blocks(F.lit(1_700_000_001).cast("bigint"), F.lit(1_720_000_003).cast("bigint"))).alias("n")).first()
    assert row["n"] <= 6 * 13


def test_active_purposes_are_made_distinct_before_they_meet(spark):
    p = spark.createDataFrame([(1, 5, 3, [(0, "Active", 10), (0, "Active", 10), (1, "Archived", 10)])] * 2, "id int, eserviceid int, consumerid int, versions array<struct<id:int,state:string,dailycalls:int>>")
    a = spark.createDataFrame([(8, 1, 5, 3, 0, "active"), (8, 1, 5, 3, 0, "SUSPENDED"), (9, 1, 5, 3, 0, "active")], "id int, producerid int, eserviceid int, consumerid int, descriptorid int, state string")
    t = spark.createDataFrame([(3, "t"), (3, "t")], "id int, name string")
    s = spark.createDataFrame([(5, "svc", 1, [(0, 1, 5, 50)] * 2)], "id int, name string, producerid int, descriptors array<struct<id:int,version:int,dailycallsperconsumer:int,dailycallstotal:int>>")
    out = reports.active_purposes(p, a, t, s, producers=[1])
    assert sorted((r["purpose_id"], r["version_id"], r["agreement_id"]) for r in out.collect()) == [(1, 0, 8), (1, 0, 9)]
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    first = next(i for i, line in enumerate(plan) if "Join" in line)
    assert not any("Aggregate" in line for line in plan[:first])


def test_tender_clocks_fit_the_compiler(spark, folder):
    timed = older_tender.milestones(tender.items(spark, folder), older_tender.national_grace(), cols=tender.COLUMNS)
    assert max(methods(timed)) <= 8000


def test_more_grace_rules_than_one_number_holds(spark):
    rows = [(str(lot), dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 1)) for lot in (0, 59, 60, 130, 999)]
    blank = {n: F.lit(None).cast("timestamp" if n.endswith(("accepted", "entrusted", "reported", "scanned", "notice", "certified")) else "string").alias(n) for n in tender.COLUMNS}
    frame = spark.createDataFrame(rows, "lot string, storage timestamp, storage_reported timestamp")
    df = frame.select(*frame.columns, *[c for n, c in blank.items() if n not in frame.columns])
    grace = [older_tender.Grace(n, ("storage",), lots=(str(n),)) for n in range(131)]
    got = older_tender.milestones(df, grace, cols=tender.COLUMNS).where("milestone = 'storage'")
    assert {r["lot"]: r["hours"] for r in got.collect()} == {"0": 60 * 24, "59": 24, "60": 0, "130": None, "999": 0}


def test_both_poolings_read_pieces_written_once(spark, folder, monkeypatch):
    labels, real = [], penalties.materialise
    for module in (penalties, ordered):
        monkeypatch.setattr(module, "materialise", lambda df, label: labels.append(label) or real(df, label))
    penalties.rank_group_choice(spark, folder)
    assert labels.count("timed") == 1 and "quota-rows" not in labels


@pytest.mark.parametrize("query,function", [("global_rank", "row_number"), ("ranked_share", "ranked_share")])
def test_ranked_lines_carry_what_the_rank_needs(spark, folder, monkeypatch, query, function):
    seen, real = [], getattr(ordered, function)
    monkeypatch.setattr(ordered, function, lambda df, *a, **k: seen.append(df.columns) or real(df, *a, **k))
    getattr(windows, query)(spark, folder)
    assert not {"state", "accepted", "reported", "attempt"} & set(seen[0])


def test_rate_cards_are_made_on_all_cores(spark, folder):
    assert domain.rate_card(spark, folder).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
