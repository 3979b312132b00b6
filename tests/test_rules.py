"""Rules, quality flags, penalties and rate cards on boundary rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates, money, presets, rules, text
from millrace.functions.calendar import WorkCalendar
from millrace.operators import aggregates, events, penalty, quality, rates, stages

CAL = WorkCalendar.national(2024, 2026)


def values(spark, schema, rows, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column.alias("v")).collect()]


def test_first_match_order_and_nulls(spark):
    label = rules.first_match([(F.col("a") == 1, "one"), (F.col("b") > 0, "b")], "none")
    assert values(spark, "a int, b int", [(1, 1), (2, 1), (None, 1), (None, None)], label) == ["one", "b", "b", "none"]


def test_carrier_prefixes(spark):
    codes = [("R14X", "z"), ("PSTAQ777A", "z"), ("2110", "z"), ("381", "z"), ("690", "z"), ("XX", "z"), (None, "z")]
    got = values(spark, "c string, r string", codes, rules.prefix_label("c", presets.CARRIER_PREFIXES, F.col("r")))
    assert got == ["Fulmine", "POST & SERVICE", "RTI Sailpost-Snem", "Poste", "Poste", "z", "z"]


def test_bands_and_text(spark):
    got = values(spark, "w int", [(0,), (1,), (20,), (21,), (2000,), (2001,), (None,)], rules.band_code("w", presets.WEIGHT_BANDS))
    assert got == [None, 1, 1, 2, 7, None, None]
    assert values(spark, "t string", [("12,34",), ("7",), ("x",), (None,)], text.decimal_comma_cents("t")) == [1234, 700, None, None]
    assert values(spark, "t string", [("2024-01-02T03:04Z",), ("2024-01-02T03:04:05Z",)], text.repair_timestamp("t")) == [
        "2024-01-02T03:04:00Z",
        "2024-01-02T03:04:05Z",
    ]
    assert values(spark, "t string", [("x.ATTEMPT_12.y",), ("none",)], text.attempt_number("t")) == [12, None]
    day = text.parse_day_or_minute("t", "23:59")
    assert values(spark, "t string", [("05/02/2024",), ("05/02/2024 08:30",), ("bad",)], day) == [
        dt.datetime(2024, 2, 5, 23, 59),
        dt.datetime(2024, 2, 5, 8, 30),
        None,
    ]


def test_periods():
    assert dates.previous_month(dt.date(2024, 1, 15)) == (dt.date(2023, 12, 1), dt.date(2024, 1, 1))
    assert dates.previous_quarter(dt.date(2024, 2, 1)) == (dt.date(2023, 10, 1), dt.date(2024, 1, 1))
    assert dates.partition_values((dt.date(2023, 11, 3), dt.date(2024, 2, 1))) == [("2023", "11"), ("2023", "12"), ("2024", "01")]


def test_fees(spark):
    fee = money.proportional_fee(F.col("c"), F.col("d"), 20)
    rows = [(1000, 0), (1000, 1), (333, 7), (1000, 19), (1000, 20), (1000, 99), (1000, None)]
    assert values(spark, "c bigint, d int", rows, fee) == [0, 50, 117, 950, 1000, 1000, None]
    double = money.proportional_fee(F.col("c"), F.col("d"), 30, cap_at=60, cap_times=2)
    assert values(spark, "c bigint, d int", [(900, 30), (900, 59), (900, 60)], double) == [900, 1770, 1800]
    assert values(spark, "d int", [(1,), (3,), (4,), (None,)], money.stepped_fee(F.col("d"), 3, 300, 500)) == [300, 900, 1400, None]


def test_quota_keeps_null_lateness_in_total(spark):
    rows = [(i, 5, 100, True, False) for i in range(8)] + [(8, None, 100, None, None), (9, 0, 100, True, False)]
    df = spark.createDataFrame(rows, "id int, late int, cost bigint, s boolean, i boolean").withColumn("g", F.lit(1))
    got = penalty.delivery_penalty(df, group=["g"], tie=["id"], late="late", in_standard="s", in_improved="i", cost="cost", quota_standard=0.5)
    by_id = {r["id"]: r for r in got.collect()}
    assert by_id[9]["rank"] == 1 and by_id[8]["rank"] is None and by_id[8]["total"] == 10
    # Shares below 0.5 pay: ranks 2 to 4; rank 5 sits exactly at the limit.
    assert sorted(i for i, r in by_id.items() if r["fee_cents"] > 0) == [0, 1, 2]
    assert by_id[0]["fee_cents"] == 25 and by_id[0]["weighted_cents"] == 13


def test_offer_and_reporting_tables(spark):
    offer = penalty.offer_days(
        presets.IMPROVED_OFFER, lot="l", product="p", zone="z", relaxed=presets.RELAXED_OFFER, region="r", date_cols={"accepted": "a", "handed_over": "h"}
    )
    t = dt.datetime
    rows = [
        ("10", "890", "AM", None, t(2024, 3, 1), t(2024, 3, 1)),
        ("10", "890", "EU", None, t(2024, 3, 1), t(2024, 3, 1)),
        ("12", "890", "EU", None, t(2024, 3, 1), t(2024, 3, 1)),
        ("27", "AR", "AM", None, t(2024, 6, 1), t(2024, 6, 1)),
        ("27", "AR", "AM", None, t(2024, 12, 15), None),
        ("27", "AR", "AM", "Campania", t(2025, 6, 2), None),
        ("30", "AR", "AM", None, None, t(2024, 6, 1)),
    ]
    assert values(spark, "l string, p string, z string, r string, a timestamp, h timestamp", rows, offer) == [2, 4, None, 30, 30, 45, 50]
    got = values(spark, "l string, p string", [("8", "890"), ("26", "AR"), ("26", "RIR"), ("21", "RIS"), ("97", "RS"), ("40", "AR")], penalty.reporting_allowance("l", "p"))
    assert got == [5, 7, 15, 15, 15, None]


def test_reporting_cases(spark):
    names = ["final", "final_day", "final_reported", "attempt", "certified", "notice_reported", "allowance", "in_workdays"]
    schema = "final string, final_day timestamp, final_reported timestamp, attempt timestamp, certified timestamp, notice_reported timestamp, allowance int, in_workdays int"
    d = lambda day: dt.datetime(2024, 3, day)
    rows = [
        ("RECRN001C", d(10), d(20), d(1), d(2), None, 5, None),  # 19 calendar days, 5 allowed
        ("RECRN001C", d(10), d(20), d(1), d(2), None, 5, 1),  # 13 working days, 5 allowed
        ("RECAG005C", d(10), d(25), d(1), d(12), d(8), 5, None),  # 7 + 13 against 17 + 5
        ("RECAG006C", d(10), d(25), d(1), d(5), d(8), 5, None),  # 24 against 9 + 5
        ("RECAG008C", d(10), d(20), d(1), d(5), d(28), 5, None),  # to the later: 27 against 9 + 21
        ("RECAG008C", d(10), d(29), d(1), d(9), None, 5, None),  # 28 against 9 + 21
        ("RECRN005C", d(3), d(29), d(1), d(9), None, 5, None),  # 28 against 2 + 21
        ("RECRN003C", d(3), d(29), d(1), d(9), None, 5, None),  # 28 against 2 + 5
        ("OTHER", d(3), d(29), d(1), d(9), None, 5, None),
    ]
    cols = {n: n for n in names}
    df = penalty.with_reporting_delay(spark.createDataFrame(rows, schema), CAL, cols)
    got = penalty.with_reporting_lateness(df, CAL, cols).collect()
    assert [r["spent"] for r in got] == [19, 13, 20, 24, 27, 28, 28, 28, 28]
    assert [r["report_late"] for r in got] == [14, 8, 0, 10, 0, 0, 5, 21, 0]
    assert [r["use_case"] for r in got][3:] == [
        penalty.USE_CASES[3], penalty.USE_CASES[8], penalty.USE_CASES[9], "giacenza_AR_RS", "giacenza_AR_RS", None,
    ]


def test_stuck_stage_counts_from_the_right_milestone(spark):
    as_of = dt.date(2024, 5, 15)
    cols = {c: c for c in ("entrusted", "printed", "ready", "handed_over", "accepted")}
    schema = "id int, entrusted date, printed date, ready date, handed_over date, accepted date"
    d = lambda day: dt.date(2024, 5, day)
    rows = [
        (1, d(8), None, None, None, None),
        (2, d(13), None, None, None, None),  # two days: inside the limit
        (3, d(6), d(8), None, None, None),
        (4, d(6), d(8), d(9), None, None),
        (5, d(6), d(8), d(9), d(10), None),
        (6, d(6), d(8), d(9), d(10), d(13)),
    ]
    got = stages.stuck_stage(spark.createDataFrame(rows, schema), CAL, F.lit(as_of), cols)
    assert sorted((r["id"], r["stage"], r["priority"], r["excess_days"]) for r in got.collect()) == [
        (1, "Stampa Imbustamento", 4, 3), (3, "Materialita Pronta", 3, 3), (4, "Pick Up", 2, 3), (5, "Accettazione Recapitista", 1, 2),
    ]


def test_validity_intervals(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    rows = [
        (1, t(1), "INSERT", False, t(0), None),
        (2, t(3), "MODIFY", None, t(0), t(4)),
        (3, t(6), "REMOVE", True, None, None),
        (4, t(8), " insert ", False, t(0), None),  # re-activation starts at its own time
        (5, t(9), "REMOVE", False, None, None),  # unsupported: ignored
        (6, t(10), "MODIFY", True, None, None),  # unsupported: ignored
    ]
    log = spark.createDataFrame(rows, "id int, at timestamp, kind string, gone boolean, s timestamp, e timestamp").withColumn("k", F.lit("x"))
    log = log.withColumn("active", events.activity(F.col("kind"), F.col("gone")))
    for hot in (None, 1):
        got = events.validity_intervals(log, ["k"], time="at", tie=["id"], active="active", start="s", end="e", hot_rows=hot, piece_rows=2)
        spans = {r["id"]: (r["valid_from"], r["valid_to"]) for r in got.collect()}
        assert spans == {1: (t(0), t(3)), 2: (t(0), t(4)), 4: (t(8), dt.datetime(2999, 12, 31))}


def test_quality_flags(spark):
    assert values(spark, "c string, r string", [("RECRN002A", "M05"), ("RECRN002A", "M01"), ("RECRN002D", None), ("RECRN001A", "M02"), ("RECRN001A", None)], quality.reason_flag("c", "r")) == [0, 1, 1, 1, 0]
    rows = [("RECAG005A", "RECAG011B", None, "RECAG005C"), ("RECAG005A", None, "RECAG005B", "RECAG005C"), ("RECAG005A", "RECAG006B", None, "RECAG005C"), (None, "RECAG011B", None, "RECAG005C")]
    assert values(spark, "a string, s string, p string, c string", rows, quality.triplet_flag("a", ["s", "p"], "c")) == [0, 0, 1, 1]
    assert values(spark, "c string, a string", [("RECRN003A", None), ("RECRN003A", "RECRS010"), ("RECRN001A", "RECRN001A"), ("RECRN001A", "x")], quality.attempt_flag("c", "a")) == [0, 1, 0, 1]


def test_citizen_cost(spark):
    df = spark.createDataFrame(
        [(True, False, False, "DELIVERY_MODE", 100, 333, 22), (False, False, False, "DELIVERY_MODE", 100, 333, 22), (True, True, False, "DELIVERY_MODE", 100, 333, 22), (True, False, False, "FLAT_RATE", 100, 333, 22), (True, False, False, None, None, 50, 10)],
        "a boolean, r boolean, c boolean, p string, f int, s int, v int",
    )
    cost = rates.citizen_cost(applies="a", refused="r", cancelled="c", policy="p", fee="f", shipping="s", vat="v")
    assert [r[0] for r in df.select(cost).collect()] == [606, 0, 0, 0, 155]


def test_granularity_raises(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(aggregates.GranularityError):
        aggregates.require_granularity(df, ["k"])
    assert aggregates.require_granularity(df.distinct(), ["k"]).count() == 1


def test_key_kinds_split(spark):
    df = spark.createDataFrame([("123",), ("ZONE",), ("Z1",)], "k string")
    national, foreign = rates.split_by_key_kind(df, "k")
    assert [r["k"] for r in national.collect()] == ["00123"] and [r["k"] for r in foreign.collect()] == ["ZONE"]
