"""Calendar, service level and penalty queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates, money
from millrace.functions.rules import first_match
from millrace.operators import joins, penalty
from millrace.plans.registry import query
from millrace.plans.standin import CAL_SQL, CALENDAR, LINES_SQL, PIECE_KEY, PIECES_SQL, lines, load, pieces, workdays_sql
from millrace.session import materialise

WD = workdays_sql


@query(
    "k1_working_days",
    f"""WITH {CAL_SQL}, {LINES_SQL},
    n AS (SELECT {WD("ship", "attempt")} AS days FROM lines)
    SELECT days, count(*) AS items FROM n GROUP BY days""",
)
def working_days(spark: SparkSession, folder: str) -> DataFrame:
    """Distribution of working days between shipping and attempt."""
    days = CALENDAR.days_between("ship", "attempt").alias("days")
    return lines(spark, folder).select(days).groupBy("days").agg(F.count(F.lit(1)).alias("items"))


@query(
    "k1_working_days_reversed",
    f"""WITH {CAL_SQL}
    SELECT o_orderkey, {WD("o_orderdate", "l_shipdate")} AS days, count(*) AS items
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""",
)
def working_days_reversed(spark: SparkSession, folder: str) -> DataFrame:
    """Order to ship working days; almost half of the ends precede the start."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    li = load(spark, folder, "lineitem").select("l_orderkey", "l_shipdate")
    days = CALENDAR.days_between("o_orderdate", "l_shipdate").alias("days")
    joined = orders.join(li, F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", days)
    return joined.groupBy("o_orderkey", "days").agg(F.count(F.lit(1)).alias("items"))


@query(
    "k2_next_working_day",
    f"""WITH {CAL_SQL}, {LINES_SQL}
    SELECT strftime(ship, '%Y-%m-%d') AS day,
           strftime((SELECT min(d) FROM cal WHERE is_work AND d >= CAST(ship AS DATE)), '%Y-%m-%d') AS next_day,
           count(*) AS items
    FROM lines GROUP BY ship""",
)
def next_working_day(spark: SparkSession, folder: str) -> DataFrame:
    shipped = lines(spark, folder).groupBy(F.col("ship").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("items"))
    return shipped.withColumn("next_day", CALENDAR.next_workday("day"))


@query(
    "k3_holiday_calendar",
    f"""WITH {CAL_SQL}, b AS (SELECT CAST(min(l_shipdate) AS DATE) lo, CAST(max(l_shipdate) AS DATE) hi FROM lineitem)
    SELECT year(d) AS year, count(*) FILTER (is_work) AS working_days,
           count(*) FILTER (NOT is_work AND isodow(d) < 6) AS weekday_holidays
    FROM cal, b WHERE d BETWEEN lo AND hi GROUP BY 1""",
)
def holiday_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Working days and weekday holidays per year over the shipped period."""
    ship = load(spark, folder, "lineitem").agg(
        F.min("l_shipdate").cast("date").alias("lo"), F.max("l_shipdate").cast("date").alias("hi")
    )
    days = ship.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    return days.groupBy(F.year("day").alias("year")).agg(
        F.count_if(CALENDAR.is_workday("day")).alias("working_days"),
        F.count_if(~CALENDAR.is_workday("day") & (F.weekday("day") < 5)).alias("weekday_holidays"),
    )


START_SQL = "CASE WHEN accepted IS NULL THEN ship + INTERVAL 1 DAY ELSE least(accepted, ship + INTERVAL 1 DAY) END"


@query(
    "k4_delivery_time",
    f"""WITH {CAL_SQL}, {LINES_SQL}, s AS (SELECT *, {START_SQL} AS start FROM lines)
    SELECT supp_key, {WD("start", "attempt")} AS days, count(*) AS items FROM s GROUP BY 1, 2""",
)
def delivery_time(spark: SparkSession, folder: str) -> DataFrame:
    timed = penalty.with_delivery_days(lines(spark, folder), CALENDAR, accepted="accepted", handed_over="ship", attempt="attempt")
    return timed.groupBy("supp_key", "days").agg(F.count(F.lit(1)).alias("items"))


# Offered days on the stand-in: (lots, product, zones, days).
LOTS = [f"Brand#{n}" for n in range(1, 26)]
STANDARD = [
    (LOTS[:10], "1-URGENT", ["SMALL", "MEDIUM", "LARGE"], 12),
    (LOTS[:10], "2-HIGH", ["SMALL", "MEDIUM"], 14),
    (LOTS[10:20], "3-MEDIUM", ["PROMO", "ECONOMY", "STANDARD"], 18),
    (LOTS[10:], "1-URGENT", ["SMALL", "PROMO"], 10),
    (LOTS[20:], "5-LOW", ["STANDARD", "LARGE"], 25),
    (LOTS, "4-NOT SPECIFIED", ["SMALL", "MEDIUM", "LARGE", "PROMO", "ECONOMY", "STANDARD"], 20),
]
IMPROVED = [
    (LOTS[:5], "1-URGENT", ["SMALL", "MEDIUM"], 6),
    (LOTS[5:10], "1-URGENT", ["SMALL"], 8),
    (LOTS, "4-NOT SPECIFIED", ["SMALL", "LARGE"], 9),
]
RELAXED = [(LOTS[:3], None, "accepted", "1997-01-01", "1997-06-30", 30)]


def _offer_sql(offers, relaxed=()) -> str:
    def names(values):
        return "(" + ", ".join(f"'{v}'" for v in values) + ")"

    whens = [
        f"WHEN lot IN {names(lots)} AND accepted BETWEEN TIMESTAMP '{a}' AND TIMESTAMP '{b}' THEN {days}"
        for lots, _, _, a, b, days in relaxed
    ]
    whens += [
        f"WHEN lot IN {names(lots)} AND product = '{product}' AND zone IN {names(zones)} THEN {days}"
        for lots, product, zones, days in offers
    ]
    return "CASE " + " ".join(whens) + " END"


TIMED_SQL = f"""{CAL_SQL}, {PIECES_SQL},
offered AS (SELECT *, {START_SQL} AS start, {_offer_sql(STANDARD, RELAXED)} AS standard,
                   {_offer_sql(IMPROVED, RELAXED)} AS improved FROM pieces),
timed AS (
  SELECT *, CASE WHEN days IS NULL THEN NULL ELSE coalesce(days <= standard, false) END AS in_standard,
         CASE WHEN days IS NULL THEN NULL ELSE coalesce(days <= improved, false) END AS in_improved,
         CASE WHEN days IS NOT NULL AND coalesce(improved, standard) IS NOT NULL
              THEN greatest(days - coalesce(improved, standard), 0) END AS late
  FROM (SELECT *, {WD("start", "attempt")} AS days FROM offered)
)"""


def timed_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces with delivery days, offers, verdicts and lateness."""
    where = {"lot": "lot", "product": "product", "zone": "zone"}
    return (
        penalty.with_delivery_days(pieces(spark, folder), CALENDAR, accepted="accepted", handed_over="ship", attempt="attempt")
        .withColumns(
            {
                "standard": penalty.offer_days(STANDARD, relaxed=RELAXED, **where),
                "improved": penalty.offer_days(IMPROVED, relaxed=RELAXED, **where),
            }
        )
        .withColumns(
            {
                "in_standard": penalty.within("days", "standard"),
                "in_improved": penalty.within("days", "improved"),
                "late": penalty.lateness("days", "standard", "improved"),
            }
        )
    )


@query(
    "k5_service_level",
    f"""WITH {TIMED_SQL}
    SELECT lot, product, in_standard, in_improved, count(*) AS items, CAST(sum(late) AS BIGINT) AS late_days
    FROM timed GROUP BY ALL""",
)
def service_level(spark: SparkSession, folder: str) -> DataFrame:
    return timed_pieces(spark, folder).groupBy("lot", "product", "in_standard", "in_improved").agg(
        F.count(F.lit(1)).alias("items"), F.sum("late").alias("late_days")
    )


# Only what the ranking and the reports need: with hot groups it is written.
CHARGED_COLUMNS = [*PIECE_KEY, "lot", "product", "reported", "days", "late", "in_standard", "in_improved"]


def charged_pieces(spark: SparkSession, folder: str, group=("lot", "product"), **terms) -> DataFrame:
    return charged(timed_pieces(spark, folder).select(*CHARGED_COLUMNS), group, **terms)


def charged(timed: DataFrame, group=("lot", "product"), **terms) -> DataFrame:
    return penalty.delivery_penalty(
        timed,
        group=list(group),
        tie=["reported", "order_key", "line", "part_key", "supp_key", "cost", "ship"],
        late="late",
        in_standard="in_standard",
        in_improved="in_improved",
        cost="cost",
        counted=F.col("days").isNotNull(),
        **terms,
    )


def _charged_sql(group: str = "lot, product", fee: str = "CASE WHEN late < 20 THEN (2 * cost * late + 20) // 40 ELSE cost END", name: str = "charged") -> str:
    return f"""ranked_{name} AS (
  SELECT *, CASE WHEN late IS NOT NULL THEN row_number() OVER (PARTITION BY {group} ORDER BY (late IS NOT NULL) DESC, late,
           reported NULLS FIRST, order_key, line, part_key, supp_key, cost, ship) END AS rk,
         count(days) OVER (PARTITION BY {group}) AS n FROM timed),
{name} AS (
  SELECT *, rk / n AS share,
    CASE WHEN in_standard AND NOT in_improved AND rk / n < 0.9 THEN coalesce({fee}, 0)
         WHEN NOT in_standard AND rk / n < 0.98 THEN coalesce({fee}, 0) ELSE 0 END AS fee
  FROM ranked_{name})"""


@query(
    "k6_delivery_penalty",
    f"""WITH {TIMED_SQL}, {_charged_sql()}
    SELECT order_key, line, part_key, supp_key, cost, rk AS rank, n AS total, share, fee AS fee_cents, (fee + 1) // 2 AS weighted_cents
    FROM charged""",
)
def delivery_penalty(spark: SparkSession, folder: str) -> DataFrame:
    """Detail of the delivery penalty: rank, share, fee and weighted fee."""
    return charged_pieces(spark, folder).select(
        "order_key", "line", "part_key", "supp_key", "cost", "rank", "total", "share", "fee_cents", "weighted_cents"
    )


@query(
    "k10b_delivery_penalty_earlier_form",
    f"""WITH {TIMED_SQL}, {_charged_sql(fee="CASE WHEN late < 60 THEN (2 * cost * late + 30) // 60 ELSE 2 * cost END")}
    SELECT lot, product, count(*) AS items, CAST(sum(fee) AS BIGINT) AS fee_cents,
           CAST(sum((fee + 1) // 2) AS BIGINT) AS weighted_cents FROM charged GROUP BY 1, 2""",
)
def delivery_penalty_earlier(spark: SparkSession, folder: str) -> DataFrame:
    """Earlier terms: a thirtieth of the cost per day, twice the cost from 60 days."""
    charged = charged_pieces(spark, folder, span=30, cap_at=60, cap_times=2, ranks=False)
    return charged.groupBy("lot", "product").agg(
        F.count(F.lit(1)).alias("items"), F.sum("fee_cents").alias("fee_cents"), F.sum("weighted_cents").alias("weighted_cents")
    )


@query(
    "k10c_rank_group_choice",
    f"""WITH {TIMED_SQL}, {_charged_sql("supp_key", name="pooled")}, {_charged_sql("lot", name="by_lot")}
    SELECT p.supp_key, CAST(sum(p.fee) AS BIGINT) AS pool_cents, CAST(sum(b.fee) AS BIGINT) AS lot_cents
    FROM pooled p JOIN by_lot b USING (order_key, line, part_key, supp_key, cost, ship) GROUP BY 1""",
)
def rank_group_choice(spark: SparkSession, folder: str) -> DataFrame:
    """Charged amounts with one pool per carrier and with one pool per lot."""
    # Both poolings read the same pieces, joined and timed once.
    timed = materialise(timed_pieces(spark, folder).select(*CHARGED_COLUMNS), "timed")
    pool = charged(timed, ["supp_key"], ranks=False, written=True).groupBy("supp_key").agg(F.sum("fee_cents").alias("pool_cents"))
    by_lot = charged(timed, ["lot"], ranks=False, written=True).groupBy("supp_key").agg(F.sum("fee_cents").alias("lot_cents"))
    return pool.join(by_lot, "supp_key")


# Relaxation rules on the stand-in; NULL matches anything.
RELAX_ROWS = [
    (1, "Brand#1", "1-URGENT", None, "1996-01-01 00:00:00", "1998-12-31 23:59:00", 9, 1),
    (2, "Brand#1", None, None, "1995-01-01 00:00:00", "2001-12-31 23:59:00", 6, 0),
    (3, "Brand#2", "2-HIGH", "SMALL", "1995-01-01 00:00:00", "2001-12-31 23:59:00", 11, 1),
    (4, "Brand#2", "2-HIGH", None, "1995-01-01 00:00:00", "1999-12-31 23:59:00", 8, 0),
    (5, "Brand#2", None, "SMALL", "1995-01-01 00:00:00", "1999-12-31 23:59:00", 13, 1),
    (6, "Brand#3", None, None, "1997-03-01 00:00:00", "1997-09-30 23:59:00", 21, 1),
]
RELAX_SQL = "relax(id, lot, product, zone, lo, hi, days, working) AS (VALUES " + ", ".join(
    "({}, '{}', {}, {}, TIMESTAMP '{}', TIMESTAMP '{}', {}, {})".format(
        i, lot, f"'{p}'" if p else "CAST(NULL AS VARCHAR)", f"'{z}'" if z else "CAST(NULL AS VARCHAR)", lo, hi, d, w
    )
    for i, lot, p, z, lo, hi, d, w in RELAX_ROWS
) + ")"


def relaxation_rules(spark: SparkSession) -> DataFrame:
    rules = spark.createDataFrame(
        RELAX_ROWS, "id int, lot string, product string, zone string, lo string, hi string, relaxed int, working int"
    )
    return rules.withColumn("lo", F.col("lo").cast("timestamp")).withColumn("hi", F.col("hi").cast("timestamp"))


def relaxed_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return joins.rule_join(
        pieces(spark, folder),
        relaxation_rules(spark),
        equal={"lot": "lot"},
        wildcard={"product": "product", "zone": "zone"},
        between=("ship", "lo", "hi"),
        values=["relaxed", "working"],
        rule_id="id",
    )


RELAXED_SQL = f"""{RELAX_SQL}, matched AS (
  SELECT p.*, r.days AS relaxed, r.working, row_number() OVER (
      PARTITION BY order_key, line, part_key, supp_key, cost, ship
      ORDER BY (CASE WHEN r.product IS NULL THEN 0 ELSE 1 END) + (CASE WHEN r.zone IS NULL THEN 0 ELSE 1 END) DESC, r.id) AS pick
  FROM pieces p LEFT JOIN relax r ON r.lot = p.lot AND (r.product = p.product OR r.product IS NULL)
       AND (r.zone = p.zone OR r.zone IS NULL) AND p.ship BETWEEN r.lo AND r.hi),
relaxed AS (SELECT * FROM matched WHERE pick = 1)"""


@query(
    "j3_rule_join",
    f"""WITH {PIECES_SQL}, {RELAXED_SQL}
    SELECT lot, product, zone, CAST(relaxed AS BIGINT) AS relaxed, CAST(working AS BIGINT) AS working, count(*) AS items
    FROM relaxed GROUP BY ALL""",
)
def rule_join(spark: SparkSession, folder: str) -> DataFrame:
    """Most specific dated rule with wildcards per piece."""
    return relaxed_pieces(spark, folder).groupBy("lot", "product", "zone", "relaxed", "working").agg(
        F.count(F.lit(1)).alias("items")
    )


@query(
    "j3_rule_join_large",
    f"""WITH {LINES_SQL}, rules AS (
      SELECT o_orderkey AS id, ['A', 'N', 'R'][CAST(o_orderkey % 3 AS INTEGER) + 1] AS flag, CASE WHEN o_custkey % 2 = 0 THEN o_orderstatus END AS state, CASE WHEN o_custkey % 5 < 2 THEN o_custkey % 7 + 1 END AS line,
        o_orderdate - 20 * INTERVAL 1 DAY AS lo, o_orderdate + CAST(o_orderkey % 60 AS INTEGER) * INTERVAL 1 DAY AS hi, o_custkey % 40 AS relaxed FROM orders),
    best AS (
      SELECT order_key, l.line, part_key, supp_key, cost, ship, min(struct_pack(s := (r.state IS NULL)::INT + (r.line IS NULL)::INT, id := r.id, relaxed := r.relaxed)) AS b
      FROM lines l JOIN rules r ON r.flag = l.flag AND (r.state IS NULL OR r.state = l.state) AND (r.line IS NULL OR r.line = l.line) AND l.ship BETWEEN r.lo AND r.hi GROUP BY ALL)
    SELECT l.flag, l.state, b.relaxed AS relaxed, count(*) AS items, CAST(sum(b.id) AS BIGINT) AS rules
    FROM lines l LEFT JOIN best USING (order_key, line, part_key, supp_key, cost, ship) GROUP BY ALL""",
)
def rule_join_large(spark: SparkSession, folder: str) -> DataFrame:
    """Thousands of dated rules with wildcards on each of three keys: one rule per order."""
    orders = load(spark, folder, "orders")
    customer = F.col("o_custkey")
    rules = orders.select(
        F.col("o_orderkey").alias("id"), F.get(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (F.col("o_orderkey") % 3).cast("int")).alias("flag"),
        F.when(customer % 2 == 0, F.col("o_orderstatus")).alias("state"), F.when(customer % 5 < 2, customer % 7 + 1).alias("line"),
        dates.plus_days("o_orderdate", -20).alias("lo"), (F.col("o_orderdate") + F.make_dt_interval(days=(F.col("o_orderkey") % 60).cast("int"))).alias("hi"), (customer % 40).alias("relaxed"),
    )
    found = joins.rule_join(
        lines(spark, folder), rules, equal={"flag": "flag"}, wildcard={"state": "state", "line": "line"}, between=("ship", "lo", "hi"), values=["relaxed", "id"], rule_id="id"
    )
    return found.groupBy("flag", "state", "relaxed").agg(F.count(F.lit(1)).alias("items"), F.sum("id").alias("rules"))


# Outcome codes of the stand-in: by return flag and line number.
FINAL_CODES = {
    "A": ["RECAG005C", "RECAG006C", "RECAG007C", "RECAG008C", "RECAG001C", "RECAG002C", "RECAG008C"],
    "R": ["RECRN005C", "RECRS003C", "RECRN003C", "RECRS005C", "RECRN001C", "RECRS004C", "RECRN004C"],
    "N": ["RECRS001C", "RECAG003C", "RECRI003C", "RECAG003F", "RECRN002C", "RECAG008C", "RECRS006"],
}


def _code_sql() -> str:
    whens = [f"WHEN flag = '{f}' AND line = {i + 1} THEN '{c}'" for f, codes in FINAL_CODES.items() for i, c in enumerate(codes)]
    return "CASE " + " ".join(whens) + " END"


def reported_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Relaxed pieces with outcome, storage notice and certification times."""
    final = first_match(
        [((F.col("flag") == f) & (F.col("line") == i + 1), c) for f, codes in FINAL_CODES.items() for i, c in enumerate(codes)]
    )
    gap = (F.col("supp_key") % 5).cast("int")
    notice = F.when(F.col("part_key") % 3 > 0, dates.plus_days("attempt", 12) + F.make_dt_interval(days=gap))
    return relaxed_pieces(spark, folder).withColumns(
        {
            "final": final,
            "certified": F.col("attempt") + F.make_dt_interval(days=(F.col("order_key") % 30).cast("int")),
            "notice": notice,
            "final_day": F.col("attempt") + F.make_dt_interval(days=gap),
            "allowance": F.coalesce("relaxed", F.lit(7)),
        }
    )


REPORTED_SQL = f"""reported AS (
  SELECT * REPLACE (reported AS reported), {_code_sql()} AS final,
    attempt + CAST(order_key % 30 AS INTEGER) * INTERVAL 1 DAY AS certified,
    CASE WHEN part_key % 3 > 0 THEN attempt + INTERVAL 12 DAY + CAST(supp_key % 5 AS INTEGER) * INTERVAL 1 DAY END AS notice,
    attempt + CAST(supp_key % 5 AS INTEGER) * INTERVAL 1 DAY AS final_day, coalesce(relaxed, 7) AS allowance
  FROM relaxed)"""
REPORT_COLS = {
    "final": "final",
    "final_day": "final_day",
    "final_reported": "reported",
    "attempt": "attempt",
    "certified": "certified",
    "notice_reported": "notice",
    "allowance": "allowance",
    "in_workdays": "working",
}


def _spans(days) -> str:
    return f"""CASE WHEN stored AND certified > notice THEN {days("attempt", "notice")} + {days("certified", "reported")}
      WHEN final = 'RECAG008C' AND certified <= notice THEN {days("attempt", "later")}
      ELSE {days("attempt", "reported")} END"""


def _calendar(a: str, b: str) -> str:
    return f"date_diff('day', CAST({a} AS DATE), CAST({b} AS DATE))"


SPENT_SQL = f"""kinds AS (
  SELECT *, final IN ('RECAG005C', 'RECAG006C', 'RECAG007C', 'RECAG008C') AS stored,
    final IN ('RECAG008C', 'RECRN005C', 'RECRS005C') AS packet, greatest(reported, notice) AS later FROM reported),
spent AS (SELECT *, CASE WHEN NOT packet AND working = 1 THEN {_spans(WD)} ELSE {_spans(_calendar)} END AS spent FROM kinds)"""


@query(
    "k7_reporting_delay",
    f"""WITH {CAL_SQL}, {PIECES_SQL}, {RELAXED_SQL}, {REPORTED_SQL}, {SPENT_SQL}
    SELECT final, spent, count(*) AS items FROM spent GROUP BY ALL""",
)
def reporting_delay(spark: SparkSession, folder: str) -> DataFrame:
    delayed = penalty.with_reporting_delay(reported_pieces(spark, folder), CALENDAR, REPORT_COLS)
    return delayed.groupBy("final", "spent").agg(F.count(F.lit(1)).alias("items"))


_DIRECT = "('RECRS001C','RECRS002C','RECRS002F','RECRN001C','RECRN002C','RECRN002F','RECAG001C','RECAG002C','RECAG003C','RECAG003F','RECRI003C','RECRI004C','RECRSI003C','RECRSI004C')"
_HELD = "('RECRN003C','RECRN004C','RECRN005C','RECRS003C','RECRS004C','RECRS005C')"
LATE_SQL = f"""cased AS (
  SELECT *, CASE
      WHEN final IN {_DIRECT} AND NOT packet THEN 1
      WHEN stored AND certified > notice AND packet THEN 2
      WHEN stored AND final <> 'RECAG008C' AND certified <= notice AND NOT packet THEN 3
      WHEN stored AND notice IS NULL AND NOT packet THEN 4
      WHEN final IN {_HELD} AND packet THEN 5
      WHEN final IN {_HELD} THEN 6
      WHEN stored AND certified > notice THEN 7
      WHEN final = 'RECAG008C' AND certified <= notice THEN 8
      WHEN final = 'RECAG008C' AND notice IS NULL THEN 9 END AS kase,
    CASE WHEN working = 1 THEN {WD("attempt", "final_day")} ELSE {_calendar("attempt", "final_day")} END AS span
  FROM spent),
late_report AS (
  SELECT *, coalesce(greatest(CASE
      WHEN kase = 1 THEN spent - allowance WHEN kase = 2 THEN spent - 38
      WHEN kase IN (3, 4, 6) THEN spent - (span + allowance)
      WHEN kase IN (5, 8, 9) THEN spent - ({_calendar("attempt", "final_day")} + 21)
      WHEN kase = 7 THEN spent - (17 + allowance) END, 0), 0) AS report_late FROM cased)"""


def late_reports(spark: SparkSession, folder: str) -> DataFrame:
    spent = penalty.with_reporting_delay(reported_pieces(spark, folder), CALENDAR, REPORT_COLS)
    return penalty.with_reporting_lateness(spent, CALENDAR, REPORT_COLS)


@query(
    "k8_reporting_lateness",
    f"""WITH {CAL_SQL}, {PIECES_SQL}, {RELAXED_SQL}, {REPORTED_SQL}, {SPENT_SQL}, {LATE_SQL}
    SELECT CASE kase WHEN 1 THEN 'consegna_mancata_consegna_irreperibilita' WHEN 2 THEN 'giacenza_890_chiusura_post_rend_RECAG012'
        WHEN 3 THEN 'giacenza_890_chiusura_pre_rend_RECAG012' WHEN 4 THEN 'giacenza_890_chiusura_senza_RECAG012'
        WHEN 5 THEN 'giacenza_AR_RS' WHEN 6 THEN 'giacenza_AR_RS' WHEN 7 THEN 'giacenza_890_chiusura_post_rend_RECAG012'
        WHEN 8 THEN 'compiuta_giacenza_890_pre_rend_RECAG012' WHEN 9 THEN 'anomalia_compiuta_giacenza_890_senza_RECAG012' END AS use_case,
      report_late, count(*) AS items FROM late_report GROUP BY ALL""",
)
def reporting_lateness(spark: SparkSession, folder: str) -> DataFrame:
    return late_reports(spark, folder).groupBy("use_case", "report_late").agg(F.count(F.lit(1)).alias("items"))


@query(
    "k9_reporting_penalty",
    f"""WITH {CAL_SQL}, {PIECES_SQL}, {RELAXED_SQL}, {REPORTED_SQL}, {SPENT_SQL}, {LATE_SQL},
    r AS (SELECT *, row_number() OVER (PARTITION BY lot, product ORDER BY report_late, reported NULLS FIRST, order_key, line,
            part_key, supp_key, cost, ship) / count(*) OVER (PARTITION BY lot, product) AS share FROM late_report),
    f AS (SELECT *, CASE WHEN report_late > 0 AND share < 0.979 THEN CASE WHEN report_late < 60
            THEN (2 * cost * report_late + 60) // 120 ELSE cost END ELSE 0 END AS fee FROM r)
    SELECT lot, product, count(*) AS items, count(*) FILTER (fee > 0) AS charged, CAST(sum(fee) AS BIGINT) AS fee_cents,
      CAST(sum((fee + 1) // 2) AS BIGINT) AS weighted_cents FROM f GROUP BY 1, 2""",
)
def reporting_penalty(spark: SparkSession, folder: str) -> DataFrame:
    cols = [*PIECE_KEY, "lot", "product", "reported", "report_late"]
    charged = penalty.reporting_penalty(
        late_reports(spark, folder).select(*cols),
        group=["lot", "product"],
        tie=["reported", "order_key", "line", "part_key", "supp_key", "cost", "ship"],
        late="report_late",
        cost="cost",
        ranks=False,
    )
    return charged.groupBy("lot", "product").agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(F.col("report_fee_cents") > 0).alias("charged"),
        F.sum("report_fee_cents").alias("fee_cents"),
        F.sum("report_weighted_cents").alias("weighted_cents"),
    )


def _summary_sql(period: str) -> str:
    return f"""WITH {TIMED_SQL}, {_charged_sql()}
    SELECT supp_key, lot, product, quarter({period}) AS quarter, year({period}) AS year, count(*) AS items,
      count(*) FILTER ((fee + 1) // 2 > 0) AS delivery_charged, CAST(sum((fee + 1) // 2) AS BIGINT) AS delivery_cents,
      CAST(sum((fee + 1) // 2) AS BIGINT) AS total_cents
    FROM charged GROUP BY 1, 2, 3, 4, 5"""


def _summary(spark: SparkSession, folder: str, period: str) -> DataFrame:
    return penalty.penalty_summary(
        charged_pieces(spark, folder, ranks=False), ["supp_key", "lot", "product"], period=period, weighted={"delivery": "weighted_cents"}
    )


@query("k10_penalty_summary", _summary_sql("ship"))
def penalty_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Penalty per carrier, lot, product and quarter of hand-over."""
    return _summary(spark, folder, "ship")


@query("k10d_penalty_summary_by_report", _summary_sql("reported"))
def penalty_summary_by_report(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the quarter of the final report."""
    return _summary(spark, folder, "reported")


@query(
    "k11_reporting_hours",
    f"""WITH {LINES_SQL}, b AS (
      SELECT *, CAST(attempt AS DATE) + (CASE WHEN supp_key % 7 = 0 THEN 31 WHEN flag = 'R' THEN 16 ELSE 4 END) AS boundary
      FROM lines),
    h AS (SELECT *, CASE WHEN CAST(reported AS DATE) >= boundary
            THEN (epoch(reported) - epoch(CAST(boundary AS TIMESTAMP))) // 3600 END AS hours FROM b),
    s AS (SELECT supp_key, count(attempt) AS outcomes, count(hours) AS violations, coalesce(sum(hours), 0) AS delay FROM h GROUP BY 1)
    SELECT supp_key, outcomes, violations, CAST(delay AS BIGINT) AS delay_hours, violations AS delays,
      coalesce(violations / nullif(outcomes, 0), 0.0) AS violation_share,
      greatest((coalesce(violations / nullif(outcomes, 0), 0.0) - 0.021::DOUBLE) * 1000 * 500, 0.0) AS penalty,
      CASE WHEN delay > 0 THEN CAST(delay AS DOUBLE) / violations ELSE 0.0 END AS mean_delay_hours FROM s""",
)
def reporting_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Older terms: hours after a day boundary, violation quota of 2.1 percent."""
    rules = [(F.col("supp_key") % 7 == 0, 31), (F.col("flag") == "R", 16)]
    timed = lines(spark, folder).withColumns(
        {
            "hours": penalty.milestone_hours("attempt", "reported", rules, 4),
            "outcomes": F.when(F.col("attempt").isNotNull(), 1),
        }
    )
    timed = timed.withColumn("violations", F.when(F.col("hours").isNotNull(), 1))
    return penalty.share_penalty(timed, ["supp_key"], outcomes="outcomes", violations="violations", hours=["hours"])


@query(
    "k12_fixed_penalty",
    f"""WITH {LINES_SQL}
    SELECT CASE flag WHEN 'A' THEN '890' WHEN 'R' THEN 'RIR' ELSE 'AR' END AS product, count(*) AS items,
      CAST(sum(CASE flag WHEN 'A' THEN cost * 5 WHEN 'R' THEN cost ELSE 200 END) AS BIGINT) AS cents
    FROM lines WHERE line = 7 GROUP BY 1""",
)
def fixed_penalty(spark: SparkSession, folder: str) -> DataFrame:
    """Fixed penalty of stolen and unreportable items (line 7 stands for them)."""
    product = F.when(F.col("flag") == "A", "890").when(F.col("flag") == "R", "RIR").otherwise("AR")
    stolen = lines(spark, folder).filter(F.col("line") == 7).withColumn("product", product)
    return stolen.groupBy("product").agg(
        F.count(F.lit(1)).alias("items"), F.sum(penalty.fixed_penalty("product", "cost")).alias("cents")
    )


ANALOGUE_SQL = f"""{CAL_SQL}, {LINES_SQL},
d AS (SELECT *, {WD("ship", "reported")} AS wd FROM lines),
l AS (SELECT *, CASE WHEN wd IS NOT NULL THEN greatest(wd - 30, 0) END AS late_days,
        concat(CAST(year(ship) AS VARCHAR), '_Q', CAST(quarter(ship) AS VARCHAR)) AS yq FROM d),
r AS (SELECT *, CASE WHEN late_days IS NOT NULL THEN row_number() OVER (ORDER BY (late_days IS NOT NULL) DESC, late_days,
        reported NULLS FIRST, order_key, line, part_key, supp_key, cost, ship) END / count(*) OVER () AS share FROM l),
c AS (SELECT *, CASE WHEN share < 0.97 AND late_days > 0 THEN 1 ELSE 0 END AS charged FROM r)"""


@query(
    "k13_sender_penalty_analogue",
    f"""WITH {ANALOGUE_SQL}, g AS (
      SELECT yq, state, count(*) AS items, count(*) FILTER (late_days = 0) AS in_time, count(*) FILTER (late_days > 0) AS late,
        count(*) FILTER (late_days > 0 AND charged = 0) AS late_in_allowance, count(*) FILTER (charged = 1) AS late_charged
      FROM c GROUP BY GROUPING SETS ((yq, state), ()))
    SELECT *, in_time / items AS in_time_share, late / items AS late_share, late_charged / items AS charged_share FROM g""",
)
def sender_penalty_analogue(spark: SparkSession, folder: str) -> DataFrame:
    """Globally ranked completion lateness with a 97 percent quota, summarised."""
    ranked = penalty.sender_analogue(
        lines(spark, folder).withColumn("yq", dates.year_quarter("ship")).select(*PIECE_KEY, "reported", "yq", "state"),
        CALENDAR,
        start="ship",
        end="reported",
        tie=["order_key", "line", "part_key", "supp_key", "cost", "ship"],
        allowed=30,
        ranks=False,
    )
    return penalty.sender_analogue_summary(ranked, ["yq", "state"])


@query(
    "k13_sender_penalty_digital",
    f"""WITH {CAL_SQL}, {LINES_SQL}, l AS (SELECT greatest(w - 23, 0) AS late FROM (SELECT {WD("ship", "reported")} AS w FROM lines) WHERE w IS NOT NULL),
    s AS (SELECT (SELECT count(*) FROM lines) AS items, count(*) FILTER (late = 0) AS in_time, count(*) FILTER (late > 0) AS late FROM l)
    SELECT items, in_time, late, greatest(late / items - 0.01::DOUBLE, 0.0) AS charged_share,
      greatest(late / items - 0.01::DOUBLE, 0.0) * items * 0.2::DOUBLE AS penalty FROM s""",
)
def sender_penalty_digital(spark: SparkSession, folder: str) -> DataFrame:
    return penalty.sender_digital_summary(lines(spark, folder), CALENDAR, start="ship", end="reported")


@query(
    "p2_threshold_matrix",
    f"""WITH {PIECES_SQL}
    SELECT lot, product, zone, CAST({_offer_sql(STANDARD)} AS BIGINT) AS standard, CAST({_offer_sql(IMPROVED)} AS BIGINT) AS improved,
      count(*) AS items FROM pieces GROUP BY ALL""",
)
def threshold_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Offered days by lot, product and zone, resolved once per combination."""
    combos = pieces(spark, folder).groupBy("lot", "product", "zone").agg(F.count(F.lit(1)).alias("items"))
    where = {"lot": "lot", "product": "product", "zone": "zone"}
    return combos.withColumns(
        {"standard": penalty.offer_days(STANDARD, **where), "improved": penalty.offer_days(IMPROVED, **where)}
    )


@query(
    "p19_rounding_ladder",
    f"""WITH {LINES_SQL}
    SELECT CAST(pages AS BIGINT) AS pages, CAST(sum(CASE WHEN late < 20 THEN (2 * cost * late + 20) // 40 ELSE cost END) AS BIGINT) AS capped,
      CAST(sum((cost + 3) // 7) AS BIGINT) AS seventh
    FROM (SELECT *, greatest(pages - 15, 0) AS late FROM lines) GROUP BY pages""",
)
def rounding_ladder(spark: SparkSession, folder: str) -> DataFrame:
    late = F.greatest(F.col("pages") - 15, F.lit(0))
    fees = lines(spark, folder).select(
        "pages", money.proportional_fee(F.col("cost"), late, 20).alias("capped"), money.half_up_div(F.col("cost"), 7).alias("seventh")
    )
    return fees.groupBy("pages").agg(F.sum("capped").alias("capped"), F.sum("seventh").alias("seventh"))


AS_OF = dt.date(2001, 12, 31)
