import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import presets
from millrace.functions.calendar import WorkCalendar
from millrace.operators.older_tender import NEVER, TENDER_COLUMNS, Grace, fine_summary, fines, milestones, national_grace, other_grace, rate_table, working_hours

NAMES = list(TENDER_COLUMNS)
COLS = {n: n for n in NAMES}
TIMES = [n for n in NAMES if n not in ("carrier", "product", "lot") and not n.endswith("_state") and n != "final"]


def item(**values):
    values = {"carrier": "Poste", "product": "890", "lot": "1", "entrusted": "2025-01-07 10:00:00", "accepted": "2025-01-08 10:00:00"} | values
    return tuple(dt.datetime.fromisoformat(values[n]) if n in TIMES and values.get(n) else values.get(n) for n in NAMES)


def frame(spark, *rows):
    return spark.createDataFrame(rows, ", ".join(f"{n} {'timestamp' if n in TIMES else 'string'}" for n in NAMES))


def timed(spark, *rows, grace=None, **kw):
    got = milestones(frame(spark, *rows), grace or national_grace(), cols=COLS, **kw).collect()
    return {r["milestone"]: (r["kind"], r["outcome"], r["hours"], r["violation"]) for r in got}


def test_clock_starts_at_the_first_late_day(spark):
    base = dict(attempt_state="RECAG010", attempt="2025-01-10 15:00:00", final="RECAG001C", certified_state="RECAG001A", certified="2025-01-10 15:00:00")
    in_time = timed(spark, item(**base, attempt_reported="2025-01-15 23:59:59", receipt_scanned="2025-01-20 05:30:00"))
    assert in_time["attempt"] == ("no_packet", 1, None, 0)
    # Day six after the 10th is the 16th; the closing report of the 20th is 4 days and 5 hours into it.
    assert in_time["closing"] == ("no_packet", 1, 101, 1)
    late = timed(spark, item(**base, attempt_reported="2025-01-16 03:10:00", receipt_scanned="2025-01-16 00:00:00"))
    assert late["attempt"] == ("no_packet", 1, 3, 1) and late["closing"] == ("no_packet", 1, 0, 0) and late["packet"] == ("packet", 0, None, 0)


def test_certified_at_the_attempt_counts_the_closing_only(spark):
    got = timed(spark, item(attempt_state="RECAG010", certified_state="RECAG010", attempt="2025-01-10 00:00:00", attempt_reported="2025-02-10 00:00:00", certified="2025-01-10 00:00:00", final="RECRS001C", final_reported="2025-02-10 00:00:00"))
    assert got["attempt"][2] > 0 and got["attempt"][3] == 0 and got["closing"][3] == 1


def test_packet_has_its_own_clock_and_kind(spark):
    got = timed(spark, item(final="RECAG008C", certified="2025-01-01 12:00:00", packet_scanned="2025-01-23 02:00:00", receipt_scanned="2025-01-20 00:00:00"))
    assert got["packet"] == ("packet", 1, 2, 1) and got["closing"] == ("no_packet", 0, None, 0)


def test_start_up_comes_before_relaxations_and_the_grid(spark):
    row = dict(lot="27", product="AR", attempt_state="RECRN010", attempt="2024-06-10 00:00:00", attempt_reported="2024-06-27 00:00:00", accepted="2024-06-02 00:00:00")
    assert timed(spark, item(**row, entrusted="2024-04-30 00:00:00"))["attempt"][2] == 24
    assert timed(spark, item(**row, entrusted="2024-05-01 00:00:00"))["attempt"][2] is None
    assert timed(spark, item(**{**row, "carrier": "other", "accepted": "2024-08-02 00:00:00"}))["attempt"][2] == 11 * 24


def test_unknown_lots(spark):
    row = dict(attempt_state="RECRN010", attempt="2025-01-10 00:00:00", attempt_reported="2025-06-10 00:00:00", storage="2025-01-10 00:00:00", storage_reported="2025-06-10 00:00:00", lot="77")
    known_product = timed(spark, item(**row, product="AR"))
    assert known_product["attempt"][2] is None and known_product["storage"][2] == 0
    assert timed(spark, item(**row, product="RIS"))["attempt"][2] == 0


def test_rules_in_order_and_never(spark):
    grace = [Grace(NEVER, ("attempt",), lots=("1",)), Grace(1, ("attempt", "storage"))]
    row = dict(attempt_state="RECRN010", attempt="2025-01-10 00:00:00", attempt_reported="2025-01-12 00:00:00")
    assert timed(spark, item(**row), grace=grace)["attempt"][2] is None
    assert timed(spark, item(**row, lot="2"), grace=grace)["attempt"][2] == 24


@pytest.mark.parametrize(
    "event, reported, hours",
    [
        ("2024-06-07 10:00:00", "2024-06-10 15:00:00", 15),  # Friday to Monday: two whole days, a weekend
        ("2024-06-07 00:00:00", "2024-06-10 15:00:00", 24 + 15),
        ("2024-06-10 09:00:00", "2024-06-10 15:00:00", 15),
        ("2024-06-10 09:00:00", "2024-06-10 08:00:00", 0),
        ("2024-12-23 08:00:00", "2024-12-31 01:00:00", 3 * 24 + 1),  # Christmas and the day after are holidays
    ],
)
def test_working_hours(spark, event, reported, hours):
    df = spark.createDataFrame([(dt.datetime.fromisoformat(event), dt.datetime.fromisoformat(reported))], "a timestamp, b timestamp")
    assert df.select(working_hours(F.col("a"), F.col("b"), WorkCalendar.national(2024, 2025))).first()[0] == hours


def test_regional_relaxation_in_working_days(spark):
    df = frame(spark, item(lot="22", product="RS", carrier="Fulmine", accepted="2025-06-10 00:00:00", attempt_state="RECRS010", attempt="2025-06-16 00:00:00", attempt_reported="2025-07-01 05:00:00"))
    cols = COLS | {"regione": "region", "provincia": "province"}
    for region, hours in (("Campania", 24 + 5), ("Lazio", 4 * 24 + 5)):
        got = milestones(df.withColumns({"region": F.lit(region), "province": F.lit("Napoli")}), other_grace(), calendar=WorkCalendar.national(2025, 2026), cols=cols)
        assert got.where("milestone = 'attempt'").first()["hours"] == hours


def sums(spark, rows):
    return spark.createDataFrame(rows, "carrier string, product string, lot string, kind string, outcome int, hours int, violation int")


def test_fines_in_whole_cents(spark):
    rows = [("a", "890", "5", "no_packet", 1, 30 if i < 3 else None, int(i < 3)) for i in range(40)]
    rows += [("a", "RS", "97", "no_packet", 1, 30_000_000, 1), ("a", "RS", "97", "packet", 1, 47, 1), ("a", "890", "27", "no_packet", 1, 5, 1)]
    rows += [("pool", p, p, "packet", 1, 48, 1) for p in ("890", "RS")] + [("pool", None, None, "packet", 2, None, 0)]
    rates = rate_table(spark, [*presets.TENDER_RATES, *presets.TENDER_POOLED_RATES])
    got = {(r["carrier"], r["product"], r["lot"], r["kind"]): r for r in fines(sums(spark, rows), rates, pooled=["pool"]).collect()}
    first = got["a", "890", "5", "no_packet"]
    assert (first["outcomes"], first["violations"], first["delays"], first["mean_delay_hours"]) == (40, 3, 3, 30.0)
    assert first["fine_cents"] == round((3 / 40 - 0.021) * 1000 * 500 * 100)
    assert got["a", "RS", "97", "no_packet"]["fine_cents"] == round(30_000_000 / 24 * 0.0678 * 0.001 * 100)
    assert got["a", "RS", "97", "packet"]["fine_cents"] == 0 and got["a", "RS", "97", "packet"]["basis"] == "per_day"
    assert (got["a", "890", "27", "no_packet"]["basis"], got["a", "890", "27", "no_packet"]["fine_cents"]) == ("none", 0)
    pool = got["pool", None, None, "packet"]
    assert (pool["outcomes"], pool["violations"], pool["fine_cents"], pool["mean_delay_hours"]) == (4, 2, round((0.5 - 0.021) * 1000 * 300 * 100), 48.0)
    wide = {(r["carrier"], r["product"], r["lot"]): r for r in fine_summary(fines(sums(spark, rows), rates, pooled=["pool"])).collect()}
    assert wide["pool", None, None]["fine_cents"] == pool["fine_cents"] and wide["pool", None, None]["outcomes_no_packet"] == 0


def test_nothing_is_charged_up_to_the_quota_or_without_outcomes(spark):
    rows = [("a", "890", "1", "packet", 1, None, int(i < 21)) for i in range(1000)] + [("a", "890", "2", "packet", 0, None, 0)]
    got = fines(sums(spark, rows), rate_table(spark, presets.TENDER_RATES)).collect()
    assert [r["fine_cents"] for r in got] == [0, 0]
    assert fines(sums(spark, []), rate_table(spark, presets.TENDER_RATES)).collect() == []


@pytest.mark.parametrize("row", [("packet", "890", ["1", "1"], "share", "3"), ("other", "890", ["1"], "share", "3"), ("packet", "890", ["1"], "weekly", "3"), ("packet", "890", ["1"], "share", "-1"), ("packet", "890", ["1"], "share", "0.00001")])
def test_rate_tables_are_checked(spark, row):
    with pytest.raises(ValueError):
        rate_table(spark, [row])
