"""Capacity, stages, events, rate cards and business reports."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates, presets
from millrace.functions.rules import first_match
from millrace.operators import aggregates, capacity, events as ev, quality, rates, reports, stages
from millrace.operators.interval_table import IntervalTable
from millrace.plans.penalties import AS_OF
from millrace.plans.registry import query
from millrace.plans.standin import (
    CAL_SQL,
    CALENDAR,
    LINES_SQL,
    PIECES_SQL,
    lines,
    load,
    pieces,
    workdays_sql,
)
from millrace.session import scratch_root
from millrace.sources.readers import spread

WD = workdays_sql
CAPACITY = 60
TIE = ["print_day", "order_key", "line", "part_key", "cost", "ship"]
TIE_SQL = "print_day, order_key, line, part_key, cost, ship"


def entrusted(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces with entry day (cut-off applied) and print day."""
    df = lines(spark, folder, spread_out=True)
    clock = F.col("ship") + F.make_dt_interval(hours=(F.col("order_key") % 24).cast("int"), mins=(F.col("part_key") % 60).cast("int"))
    entry = dates.cut_off_date(clock, "22:30")
    gap = (F.col("order_key") % 4).cast("int")
    return df.withColumn("entry_day", entry).withColumn("print_day", F.date_add(F.col("ship").cast("date"), gap + 1))


ENTRUSTED_SQL = LINES_SQL + """,
entrusted AS (
  SELECT *, CASE WHEN strftime(clock, '%H:%M:%S') <= '22:30' THEN CAST(clock AS DATE) ELSE CAST(clock AS DATE) + 1 END AS entry_day,
    CAST(ship AS DATE) + CAST(order_key % 4 + 1 AS INTEGER) AS print_day
  FROM (SELECT *, ship + CAST(order_key % 24 AS INTEGER) * INTERVAL 1 HOUR + CAST(part_key % 60 AS INTEGER) * INTERVAL 1 MINUTE AS clock FROM lines)
)"""


def queued(spark: SparkSession, folder: str) -> DataFrame:
    """What the queues need of a piece: every column of theirs is written, dealt and passed through the workers."""
    return entrusted(spark, folder).select("supp_key", "pages", "entry_day", *TIE)


def assigned(spark: SparkSession, folder: str, lane=("supp_key",), limit: int = CAPACITY, **size) -> DataFrame:
    return capacity.assign_days(
        queued(spark, folder), CALENDAR, eligible="entry_day", order=TIE, pages="pages", capacity=limit, lane=list(lane), **size
    )


# The fold item by item, one lane per recursion branch.
ASSIGNED_SQL = f"""{CAL_SQL}, {ENTRUSTED_SQL},
wd AS (SELECT d, idx FROM cal WHERE is_work),
queue AS (
  SELECT e.*, (SELECT min(idx) FROM wd WHERE wd.d >= e.entry_day) AS w FROM entrusted e),
ranked AS (SELECT *, row_number() OVER (PARTITION BY supp_key ORDER BY w, {TIE_SQL}) AS rank FROM queue),
fold AS (
  SELECT supp_key, rank, w AS at, pages AS used FROM ranked WHERE rank = 1
  UNION ALL
  SELECT r.supp_key, r.rank,
    CASE WHEN r.w > f.at THEN r.w WHEN f.used > 0 AND f.used + r.pages > {CAPACITY} THEN f.at + 1 ELSE f.at END,
    CASE WHEN r.w > f.at OR (f.used > 0 AND f.used + r.pages > {CAPACITY}) THEN r.pages ELSE f.used + r.pages END
  FROM fold f JOIN ranked r ON r.supp_key = f.supp_key AND r.rank = f.rank + 1),
assigned AS (SELECT r.*, wd.d AS assigned_day FROM ranked r JOIN fold f USING (supp_key, rank) JOIN wd ON wd.idx = f.at)"""
ASSIGNED_SQL = "RECURSIVE " + ASSIGNED_SQL


@query(
    "k14_daily_capacity",
    f"""WITH {ASSIGNED_SQL}
    SELECT supp_key, order_key, line, part_key, cost, CAST(pages AS BIGINT) AS pages, rank, strftime(assigned_day, '%Y-%m-%d') AS assigned_day FROM assigned""",
)
def daily_capacity(spark: SparkSession, folder: str) -> DataFrame:
    """Working day assigned to every piece, one queue per supplier."""
    return assigned(spark, folder).select("supp_key", "order_key", "line", "part_key", "cost", "pages", "rank", "assigned_day")


def _one_lane_sql(limit: int, until: str = "2003-12-31") -> str:
    """Load per day of one queue: the recursion jumps from a day's first item to the next day's by prefix sums.

    ``until``: end of the calendar, behind the day by which the queue has drained.
    """
    days = CAL_SQL.replace("TIMESTAMP '2003-12-31'", f"TIMESTAMP '{until}'")
    return f"""WITH RECURSIVE {days}, {ENTRUSTED_SQL},
    wd AS (SELECT d, idx FROM cal WHERE is_work),
    queue AS MATERIALIZED (
      SELECT row_number() OVER o AS rank, CAST(w AS BIGINT) AS w, CAST(sum(pages) OVER o AS BIGINT) AS upto, CAST(sum(pages) OVER o - pages AS BIGINT) AS base
      FROM (SELECT e.*, f.idx AS w FROM entrusted e JOIN
        (SELECT c.d AS day, min(wd.idx) AS idx FROM cal c JOIN wd ON wd.d >= c.d AND wd.d < c.d + 15 GROUP BY 1) f ON f.day = e.entry_day)
      WINDOW o AS (ORDER BY w, {TIE_SQL} ROWS UNBOUNDED PRECEDING)),
    ends AS MATERIALIZED (
      SELECT q.rank, q.base, CASE WHEN n.rank IS NOT NULL THEN greatest(n.rank, q.rank + 1) END AS full_at FROM (SELECT *, base + {limit} AS room FROM queue) q ASOF LEFT JOIN queue n ON q.room < n.upto),
    later AS MATERIALIZED (
      SELECT c.slot, n.rank AS next, n.w FROM (SELECT DISTINCT CAST(idx AS BIGINT) AS slot FROM wd) c
      ASOF LEFT JOIN (SELECT min(rank) AS rank, w FROM queue GROUP BY w) n ON c.slot < n.w),
    lists AS MATERIALIZED (
      SELECT (SELECT list(coalesce(full_at, 1000000000000) ORDER BY rank) FROM ends) AS full_at, (SELECT min(slot) FROM later) AS origin,
        (SELECT list(coalesce(next, 1000000000000) ORDER BY slot) FROM later) AS next, (SELECT list(w ORDER BY slot) FROM later) AS w),
    days AS (
      SELECT CAST(1 AS BIGINT) AS first, (SELECT w FROM queue WHERE rank = 1) AS slot
      UNION ALL
      SELECT least(full_at[first], next[slot - origin + 1]), CASE WHEN next[slot - origin + 1] <= full_at[first] THEN w[slot - origin + 1] ELSE slot + 1 END
      FROM days, lists WHERE least(full_at[first], next[slot - origin + 1]) < 1000000000000),
    opened AS (SELECT days.first, days.slot, ends.base FROM days JOIN ends ON ends.rank = days.first)
    SELECT strftime(wd.d, '%Y-%m-%d') AS assigned_day,
      CAST(lead(base, 1, (SELECT max(upto) FROM queue)) OVER (ORDER BY first) - base AS BIGINT) AS pages,
      lead(first, 1, (SELECT count(*) + 1 FROM queue)) OVER (ORDER BY first) - first AS items
    FROM opened JOIN wd ON wd.idx = opened.slot"""


@query("k14_daily_capacity_single_lane", _one_lane_sql(CAPACITY * 20))
def daily_capacity_single_lane(spark: SparkSession, folder: str) -> DataFrame:
    """The same with one queue for everything; load per assigned day."""
    return capacity.daily_load(assigned(spark, folder, (), CAPACITY * 20), pages="pages")


@query("k14_daily_capacity_in_packs", _one_lane_sql(CAPACITY * 200))
def daily_capacity_in_packs(spark: SparkSession, folder: str) -> DataFrame:
    """One queue that drains often, cut into packs where it does."""
    return capacity.daily_load(assigned(spark, folder, (), CAPACITY * 200, chunk_items=500), pages="pages")


@query("k14_daily_capacity_in_chunks", _one_lane_sql(CAPACITY * 5, "2299-12-31"))
def daily_capacity_in_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """One overloaded queue, cut into chunks inside days."""
    return capacity.daily_load(assigned(spark, folder, (), CAPACITY * 5, chunk_items=2000), pages="pages")


@query(
    "k15_print_lateness",
    f"""WITH {ASSIGNED_SQL},
    c AS (SELECT assigned_day AS day, print_day, count(*) AS n FROM assigned GROUP BY 1, 2),
    m AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY n DESC, print_day) AS rn FROM c),
    t AS (SELECT assigned_day AS day, CAST(sum(pages) AS BIGINT) AS pages FROM assigned GROUP BY 1),
    l AS (SELECT m.day, m.print_day, t.pages, {WD("m.day", "m.print_day")} - 2 AS d FROM m JOIN t USING (day) WHERE rn = 1)
    SELECT strftime(day, '%Y-%m-%d') AS assigned_day, strftime(print_day, '%Y-%m-%d') AS print_day, pages,
      CASE WHEN d > 0 THEN d END AS late_days,
      CASE WHEN d > 3 THEN 900 + (d - 3) * 500 WHEN d > 0 THEN d * 300 END AS penalty,
      month(day) AS month, year(day) AS year, quarter(day) AS quarter FROM l""",
)
def print_lateness(spark: SparkSession, folder: str) -> DataFrame:
    return stages.print_lateness(assigned(spark, folder), CALENDAR, day="assigned_day", printed="print_day", pages="pages")


@query(
    "k16_pickup_lateness",
    f"""WITH {CAL_SQL}, {LINES_SQL},
    s AS (SELECT (SELECT min(d) FROM cal WHERE is_work AND d >= CAST(ship AS DATE)) AS day, CAST(attempt AS DATE) AS ready FROM lines),
    c AS (SELECT day, ready, count(*) AS n FROM s GROUP BY ALL),
    r AS (SELECT *, rank() OVER (PARTITION BY day ORDER BY n DESC, ready NULLS LAST) AS rk FROM c),
    p AS (SELECT day, coalesce(max(ready) FILTER (rk = 1), max(ready) FILTER (rk = 2)) AS pickup FROM r GROUP BY 1),
    l AS (SELECT *, {WD("day", "pickup")} - 2 AS d FROM p)
    SELECT strftime(day, '%Y-%m-%d') AS print_day, strftime(pickup, '%Y-%m-%d') AS pickup_day, CASE WHEN d > 0 THEN d END AS late_days,
      CASE WHEN d > 0 THEN d * 150 END AS penalty, month(day) AS month, year(day) AS year, quarter(day) AS quarter FROM l""",
)
def pickup_lateness(spark: SparkSession, folder: str) -> DataFrame:
    return stages.pickup_lateness(lines(spark, folder), CALENDAR, printed="ship", ready="attempt")


@query(
    "k17_cut_off",
    f"""WITH {ENTRUSTED_SQL}
    SELECT strftime(entry_day, '%Y-%m-%d') AS entry_day, count(*) AS items FROM entrusted GROUP BY 1""",
)
def cut_off(spark: SparkSession, folder: str) -> DataFrame:
    return entrusted(spark, folder).groupBy("entry_day").agg(F.count(F.lit(1)).alias("items"))


AS_OF_SQL = f"DATE '{AS_OF}'"


@query(
    "k18_stuck_stage",
    f"""WITH {CAL_SQL}, {LINES_SQL},
    m AS (SELECT order_key, line, part_key, cost, flag, ship AS entrusted,
        CASE WHEN flag <> 'A' THEN ship + INTERVAL 1 DAY END AS printed,
        CASE WHEN flag = 'N' AND line > 2 THEN ship + INTERVAL 2 DAY END AS ready,
        CASE WHEN flag = 'N' AND line > 4 THEN ship + INTERVAL 3 DAY END AS handed_over FROM lines),
    w AS (SELECT *, {WD("entrusted", AS_OF_SQL)} AS we, {WD("printed", AS_OF_SQL)} AS wp, {WD("handed_over", AS_OF_SQL)} AS wh FROM m),
    s AS (SELECT *, CASE WHEN printed IS NULL AND we >= 2 THEN 1 WHEN ready IS NULL AND wp >= 2 THEN 2
        WHEN handed_over IS NULL AND wp >= 2 THEN 3 WHEN wh >= 1 THEN 4 END AS k FROM w),
    x AS (SELECT k, CASE k WHEN 1 THEN we WHEN 2 THEN wp WHEN 3 THEN wp ELSE wh END AS waiting_days FROM s WHERE k IS NOT NULL)
    SELECT CASE k WHEN 1 THEN 'Stampa Imbustamento' WHEN 2 THEN 'Materialita Pronta' WHEN 3 THEN 'Pick Up' ELSE 'Accettazione Recapitista' END AS stage,
      CAST(5 - k AS BIGINT) AS priority, waiting_days, waiting_days - (CASE WHEN k = 4 THEN 1 ELSE 2 END) AS excess_days, count(*) AS items
    FROM x WHERE waiting_days - (CASE WHEN k = 4 THEN 1 ELSE 2 END) > 0 GROUP BY ALL""",
)
def stuck_stage(spark: SparkSession, folder: str) -> DataFrame:
    """Stage, priority and days over the limit of pieces stuck at the supplier."""
    flag, line = F.col("flag"), F.col("line")
    tracked = lines(spark, folder).select(
        F.col("ship").alias("entrusted"),
        F.when(flag != "A", dates.plus_days("ship", 1)).alias("printed"),
        F.when((flag == "N") & (line > 2), dates.plus_days("ship", 2)).alias("ready"),
        F.when((flag == "N") & (line > 4), dates.plus_days("ship", 3)).alias("handed_over"),
        F.lit(None).cast("timestamp").alias("accepted"),
    )
    cols = {c: c for c in ("entrusted", "printed", "ready", "handed_over", "accepted")}
    stuck = stages.stuck_stage(tracked, CALENDAR, F.lit(AS_OF), cols)
    return stuck.groupBy("stage", "priority", "waiting_days", "excess_days").agg(F.count(F.lit(1)).alias("items"))


@query(
    "k19_criticality",
    """WITH listed AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_mktsegment = 'BUILDING'),
    always AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_acctbal < 0),
    excluded AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_quantity >= 49)
    SELECT CASE WHEN (l.k IS NOT NULL AND o_orderstatus <> 'F' AND e.k IS NULL) OR (a.k IS NOT NULL AND e.k IS NULL) THEN 'Critico' END AS criticita,
      CASE WHEN a.k IS NOT NULL THEN 'SI' ELSE 'NO' END AS ente_attenzionato, o_orderpriority AS product, count(*) AS items
    FROM orders LEFT JOIN listed l ON l.k = o_custkey LEFT JOIN always a ON a.k = o_custkey LEFT JOIN excluded e ON e.k = o_orderkey
    GROUP BY ALL""",
)
def criticality(spark: SparkSession, folder: str) -> DataFrame:
    customers = load(spark, folder, "customer").withColumnRenamed("c_custkey", "o_custkey")
    big = load(spark, folder, "lineitem").filter(F.col("l_quantity") >= 49).select(F.col("l_orderkey").alias("o_orderkey"))
    orders = load(spark, folder, "orders").withColumn("completed", F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")))
    marked = stages.criticality(
        orders,
        sender="o_custkey",
        item="o_orderkey",
        completed="completed",
        listed=customers.filter(F.col("c_mktsegment") == "BUILDING"),
        always=customers.filter(F.col("c_acctbal") < 0),
        excluded=big,
    )
    return marked.groupBy("criticita", "ente_attenzionato", F.col("o_orderpriority").alias("product")).agg(
        F.count(F.lit(1)).alias("items")
    )


# -- events -------------------------------------------------------------------


def keyed_events(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events").withColumn("k", F.get_json_object("props", "$.k").try_cast("bigint"))


@query(
    "k20_event_collapse",
    """WITH t AS (SELECT user_id, event_type, event_id, ts, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
      FROM events WHERE event_type IN ('purchase', 'error'))
    SELECT user_id, max(event_id) FILTER (event_type = 'purchase') AS purchase_id, max(value) FILTER (event_type = 'purchase') AS purchase_value,
      max(event_id) FILTER (event_type = 'error') AS error_id, max(value) FILTER (event_type = 'error') AS error_value
    FROM t WHERE rn = 1 GROUP BY 1""",
)
def event_collapse(spark: SparkSession, folder: str) -> DataFrame:
    """Last event of two kinds per user as one wide row."""
    return ev.collapse(
        load(spark, folder, "events"),
        ["user_id"],
        F.col("event_type"),
        ["purchase", "error"],
        order=["ts", "event_id"],
        keep={"id": "event_id", "value": "value"},
    )


@query(
    "k20_nested_event_log",
    """SELECT l_orderkey AS requestid, count(*) AS events, count(*) FILTER (l_returnflag = 'R') AS returned,
      max(l_shipdate) FILTER (l_returnflag = 'R') IS NOT NULL AS has_return,
      (SELECT arg_max(CASE WHEN l_linenumber % 2 = 0 THEN '23L' ELSE 'AR' END, strftime(x.l_shipdate, '%Y-%m-%dT%H:%M') || ':00Z' || CASE WHEN l_linenumber % 2 = 0 THEN '23L' ELSE 'AR' END)
         FROM lineitem x WHERE x.l_orderkey = l.l_orderkey AND x.l_linestatus = 'F') AS documenttype
    FROM lineitem l GROUP BY 1""",
)
def nested_event_log(spark: SparkSession, folder: str) -> DataFrame:
    """Exploded nested log with repaired times, and the last attachment per item."""
    stamp = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm'Z'")
    doc = F.when(F.col("l_linenumber") % 2 == 0, "23L").otherwise("AR")
    none = F.array().cast("array<struct<documenttype:string>>")
    docs = F.when(F.col("l_linestatus") == "F", F.array(F.struct(doc.alias("documenttype")))).otherwise(none)
    event = F.struct(
        F.col("l_returnflag").alias("statuscode"),
        stamp.alias("statusdatetime"),
        stamp.alias("clientrequesttimestamp"),
        F.lit(None).cast("string").alias("deliveryfailurecause"),
        docs.alias("attachments"),
    )
    # The log arrives nested, a few events per stored row.
    stored = load(spark, folder, "lineitem").groupBy("l_orderkey", (F.col("l_linenumber") > 3).alias("late"))
    nested = stored.agg(F.collect_list(F.struct(event.alias("paperprogrstatus"))).alias("eventslist"))
    nested = nested.select(F.concat(F.lit("item-000~"), F.col("l_orderkey").cast("string")).alias("requestid"), "eventslist")
    log = ev.collapse_nested(nested, "requestid", "eventslist", ["R"], keep={}, attachments=["23L", "AR"], prefix="item-000~")
    return log.select(F.col("requestid").cast("bigint"), "events", F.col("r_events").alias("returned"), F.col("r_at").isNotNull().alias("has_return"), "documenttype")


@query(
    "k21_retransmissions",
    """WITH a AS (SELECT l_orderkey AS k, l_suppkey AS s, l_shipdate AS reported, l_shipdate - CAST(l_quantity AS INTEGER) * INTERVAL 1 DAY AS happened FROM lineitem),
    once AS (SELECT k, s, reported, min(happened) AS happened FROM a GROUP BY 1, 2, 3),
    g AS (SELECT k, s, count(*) AS reports, arg_min(happened, reported) AS fh, min(reported) AS fr, max(reported) AS lr FROM once GROUP BY 1, 2 HAVING count(*) > 1)
    SELECT k, s, reports, date_diff('day', fh, fr) AS first_delay, date_diff('day', fr, lr) AS resend_delay FROM g""",
)
def retransmissions(spark: SparkSession, folder: str) -> DataFrame:
    """Outcomes of one order and supplier reported on several days; reports of one day count once, with the earliest event."""
    li = load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.col("l_suppkey").alias("s"),
        F.col("l_shipdate").alias("reported"),
        (F.col("l_shipdate") - F.make_dt_interval(days=F.col("l_quantity").cast("int"))).alias("happened"),
    )
    once = li.groupBy("k", "s", "reported").agg(F.min("happened").alias("happened"))
    resent = ev.retransmissions(once, ["k", "s"], reported="reported", happened="happened")
    return resent.select("k", "s", "reports", "first_delay", "resend_delay")


@query(
    "k21_retransmission_share",
    """WITH d AS (SELECT user_id, event_type, count(*) AS n, date_diff('day', min(ts), max(ts)) AS gap FROM events GROUP BY 1, 2),
    t AS (SELECT event_type, count(*) AS keys, count(*) FILTER (n > 1) AS resent, count(*) FILTER (n > 1 AND gap = 0) AS same_day,
      count(*) FILTER (n > 1 AND gap BETWEEN 1 AND 10) AS gap_1_10, count(*) FILTER (n > 1 AND gap BETWEEN 11 AND 20) AS gap_11_20,
      count(*) FILTER (n > 1 AND gap > 20) AS gap_over_20 FROM d GROUP BY 1)
    SELECT *, resent / keys AS resent_share FROM t""",
)
def retransmission_share(spark: SparkSession, folder: str) -> DataFrame:
    """Share of keys with repeated outcomes and their resend delay classes."""
    chosen = load(spark, folder, "events")
    per_key = chosen.groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.datediff(F.max("ts"), F.min("ts")).alias("gap")
    )
    resent = F.col("n") > 1
    counted = aggregates.conditional_counts(
        per_key,
        ["event_type"],
        {
            "resent": resent,
            "same_day": resent & (F.col("gap") == 0),
            "gap_1_10": resent & F.col("gap").between(1, 10),
            "gap_11_20": resent & F.col("gap").between(11, 20),
            "gap_over_20": resent & (F.col("gap") > 20),
        },
        total="keys",
    )
    return aggregates.shares(counted, {"resent_share": "resent"}, "keys")


INTERVALS_SQL = """change AS (
  SELECT event_id, user_id, ts, CASE WHEN event_type IN ('signup', 'view', 'click') THEN 1 WHEN event_type = 'error' THEN 0 END AS active,
    CASE WHEN event_type = 'signup' THEN ts - INTERVAL 1 HOUR END AS own_start,
    CASE WHEN event_type = 'view' THEN ts + INTERVAL 6 HOUR END AS own_end FROM events),
linked AS (
  SELECT *, lag(active) OVER w AS prev, lead(ts) OVER w AS next FROM change WHERE active IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
spans AS (
  SELECT event_id, user_id, CASE WHEN prev = 0 THEN ts ELSE coalesce(own_start, ts) END AS valid_from,
    coalesce(least(own_end, next), TIMESTAMP '2999-12-31 00:00:00') AS valid_to FROM linked WHERE active = 1)"""


def change_log(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    event_name = first_match([(kind == "signup", "INSERT"), (kind.isin("view", "click"), "modify "), (kind == "error", "REMOVE")])
    return load(spark, folder, "events").select(
        "event_id",
        "user_id",
        "ts",
        ev.activity(event_name, kind == "error").alias("active"),
        F.when(kind == "signup", F.col("ts") - F.make_dt_interval(hours=F.lit(1))).alias("own_start"),
        F.when(kind == "view", F.col("ts") + F.make_dt_interval(hours=F.lit(6))).alias("own_end"),
    )


def spans(spark: SparkSession, folder: str) -> DataFrame:
    built = ev.validity_intervals(
        change_log(spark, folder), ["user_id"], time="ts", tie=["event_id"], active="active", start="own_start", end="own_end"
    )
    return built.select(F.col("event_id").alias("span_id"), "user_id", "valid_from", "valid_to")


@query(
    "k22_validity_intervals",
    f"""WITH {INTERVALS_SQL}
    SELECT event_id AS span_id, user_id, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from, strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to FROM spans""",
)
def validity_intervals(spark: SparkSession, folder: str) -> DataFrame:
    return spans(spark, folder)


@query(
    "k22_interval_table_two_runs",
    f"""WITH {INTERVALS_SQL}
    SELECT event_id AS span_id, user_id, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from, strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to FROM spans""",
)
def interval_table_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The same intervals from a table on disk: a first run, then the events that came late, out of order, some of them again."""
    log = change_log(spark, folder)
    path = f"{scratch_root(spark).rstrip('/')}/intervals-{uuid.uuid4().hex}"
    kept = IntervalTable(spark, path, ["user_id"], time="ts", tie=["event_id"], active="active", start="own_start", end="own_end", buckets=16)
    came_late = F.col("event_id") % 7 == 0
    kept.create(log.filter(~came_late))
    kept.extend(log.filter(came_late | (F.col("event_id") % 50 == 1)))
    return kept.spans().select(F.col("event_id").alias("span_id"), "user_id", "valid_from", "valid_to")


# -- rate cards ---------------------------------------------------------------

BAND_SQL = "(VALUES (1, 1, 20), (2, 21, 50), (3, 51, 100), (4, 101, 250), (5, 251, 350), (6, 351, 1000), (7, 1001, 2000)) b(code, lo, hi)"


def rate_card(spark: SparkSession, folder: str) -> DataFrame:
    """A wide card per part: decimal-comma prices, some parts are zones."""
    price = F.col("p_retailprice").cast("decimal(10,2)")

    def comma(amount) -> F.Column:
        return F.regexp_replace(amount.cast("decimal(10,2)").cast("string"), r"\.", ",")

    cols = [F.when(F.col("p_partkey") % 10 == 0, F.concat(F.lit("ZONE_"), F.col("p_partkey"))).otherwise(F.col("p_partkey").cast("string")).alias("CAP")]
    for j, product in enumerate(["RS", "AR", "890"]):
        cols += [
            F.concat(F.lit("  "), F.col("p_brand")).alias(f"{product}_Recapitista"),
            F.col("p_size").cast("string").alias(f"{product}_Lotto"),
            comma(price / 100).alias(f"{product}_Plico"),
            comma(price / 200).alias(f"{product}_Foglio"),
            comma(price / 400).alias(f"{product}_dem"),
        ]
        for i, suffix in enumerate(rates.BAND_SUFFIXES):
            # One header of the delivered card ends with a blank.
            name = f"{product}_{suffix}" + (" " if product == "RS" and suffix == "351_1000" else "")
            cols.append(comma(price + 10 * i + j).alias(name))
    # The card's many price texts are long work per part, and parts come in few files.
    return spread(load(spark, folder, "part"), "p_partkey").select(*cols)


def zones(spark: SparkSession, folder: str) -> DataFrame:
    part = load(spark, folder, "part").filter(F.col("p_partkey") % 20 == 0)
    return part.select(F.concat(F.lit("ZONE_"), F.col("p_partkey")).alias("zone"), F.concat(F.lit("Land "), F.col("p_partkey")).alias("countryIt"))


def long_card(spark: SparkSession, folder: str) -> DataFrame:
    long = rates.card_to_long(rate_card(spark, folder))
    return rates.price_zones(long, zones(spark, folder), start="2025-03-31T22:00:00.000Z", end="2999-01-01T23:59:59.999Z")


CARD_SQL = f"""raw AS (SELECT *, CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part),
card AS (
  SELECT CASE WHEN p_partkey % 20 = 0 THEN 'Land ' || p_partkey WHEN p_partkey % 10 = 0 THEN 'ZONE_' || p_partkey ELSE lpad(CAST(p_partkey AS VARCHAR), 5, '0') END AS geokey,
    CASE WHEN p_partkey % 20 = 0 THEN CASE pr.product WHEN 'RS' THEN 'RIS' WHEN 'AR' THEN 'RIR' END ELSE pr.product END AS product,
    p_brand AS recapitista, CAST(p_size AS VARCHAR) AS lotto,
    CAST(round(price * 1.0000, 0) AS BIGINT) AS plico_x, CAST(b.lo AS BIGINT) AS min, CAST(b.hi AS BIGINT) AS max,
    CAST((price + 10 * (b.code - 1) + pr.j) * 100 AS BIGINT) AS costo, CAST((price + pr.j) * 100 AS BIGINT) AS costo_base_20gr
  FROM raw, (VALUES ('RS', 0), ('AR', 1), ('890', 2)) pr(product, j), {BAND_SQL})"""


@query(
    "k23_rate_card_long",
    f"""WITH {CARD_SQL} SELECT geokey, product, recapitista, lotto, min, max, costo, costo_base_20gr FROM card WHERE product IS NOT NULL""",
)
def rate_card_long(spark: SparkSession, folder: str) -> DataFrame:
    """Wide rate card to one row per product and weight band, zones to countries."""
    return long_card(spark, folder).select("geokey", "product", "recapitista", "lotto", "min", "max", "costo", "costo_base_20gr")


@query(
    "k24_rate_card_check",
    f"""WITH {CARD_SQL}, tests AS (SELECT geokey, product, lotto, code AS band, costo + CASE WHEN costo % 7 = 0 THEN 1 ELSE 0 END AS m_cost, costo_base_20gr AS m_base
      FROM card JOIN {BAND_SQL} ON lo = card.min WHERE product IS NOT NULL AND costo % 11 <> 0)
    SELECT c.geokey, c.product, b.code AS band_id, c.costo = t.m_cost AS cost_correct, c.costo_base_20gr = t.m_base AS base_correct,
      (c.costo = t.m_cost) AND (c.costo_base_20gr = t.m_base) AS all_correct
    FROM (SELECT c.*, CAST(b.code AS BIGINT) AS code FROM card c JOIN {BAND_SQL} ON b.lo = c.min WHERE product IS NOT NULL) c
    CROSS JOIN (SELECT 1) one LEFT JOIN tests t ON t.geokey = c.geokey AND t.product = c.product AND t.lotto = c.lotto AND t.band = c.code,
    LATERAL (SELECT c.code AS code) b""",
)
def rate_card_check(spark: SparkSession, folder: str) -> DataFrame:
    """Card prices against measured prices, flag by flag."""
    card = rates.with_band(long_card(spark, folder), "min", "band_id")
    cost = F.col("costo")
    measured = card.filter(cost % 11 != 0).select(
        "geokey", "product", "lotto", "band_id", (cost + F.when(cost % 7 == 0, 1).otherwise(0)).alias("m_cost"), F.col("costo_base_20gr").alias("m_base")
    )
    checked = rates.check_card(
        card, measured, ["geokey", "product", "lotto", "band_id"], {"cost_correct": ("costo", "m_cost"), "base_correct": ("costo_base_20gr", "m_base")}
    )
    return checked.select("geokey", "product", "band_id", "cost_correct", "base_correct", "all_correct")


def notices(spark: SparkSession, folder: str) -> DataFrame:
    """Payment notices per notification, unnested from recipients and payments."""
    orders = load(spark, folder, "orders")
    key = F.col("o_orderkey")

    def payment(n: int):
        return F.struct(
            F.concat(F.lit("T"), (F.col("o_custkey") % 40).cast("string")).alias("creditortaxid"),
            F.concat(F.lit("N"), (key % 500).cast("string"), F.lit(f"-{n}")).alias("noticecode"),
            (key % 5 != 0).alias("applycost"),
        )

    recipient = F.struct(
        F.concat(F.lit("R"), key.cast("string")).alias("recipientid"),
        F.lit("PF").alias("recipienttype"),
        F.array(payment(0), payment(1)).alias("payments"),
    )
    nested = orders.withColumn("recipients", F.array(recipient))
    return rates.payments(nested, ["o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice"])


NOTICES_SQL = """notices AS (
  SELECT o.*, 'T' || (o_custkey % 40) AS creditortaxid, 'N' || (o_orderkey % 500) || '-' || n AS noticecode, o_orderkey % 5 <> 0 AS applycost
  FROM orders o, (VALUES (0), (1)) v(n)),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY creditortaxid, noticecode ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM notices) WHERE rn = 1),
shipping AS (SELECT l_orderkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS shipping FROM lineitem GROUP BY 1),
charged AS (
  SELECT creditortaxid, noticecode, o_orderkey, CASE WHEN NOT applycost OR o_orderstatus = 'F' OR o_orderpriority = '1-URGENT' THEN 0
    ELSE 150 + 100 + CAST(round(CAST(coalesce(shipping, 0) AS DECIMAL(18,0)) * 122 / 100, 0) AS BIGINT) END AS cents
  FROM latest LEFT JOIN shipping ON l_orderkey = o_orderkey)"""


def charged_notices(spark: SparkSession, folder: str) -> DataFrame:
    latest = rates.latest_notice(notices(spark, folder), ["creditortaxid", "noticecode"], "o_orderdate", ["o_orderkey"], ["o_orderkey", "o_orderstatus", "o_orderpriority", "applycost"])
    details = load(spark, folder, "lineitem").select(
        "l_orderkey", F.concat(F.lit('{"analogCost": '), F.col("l_quantity").cast("int"), F.lit("}")).alias("details")
    )
    shipping = rates.json_cost_sum(details, {"l_orderkey": F.col("l_orderkey")}, "details", "$.analogCost", "shipping")
    joined = latest.join(shipping, F.col("l_orderkey") == F.col("o_orderkey"), "left").withColumns(
        {
            "shipping": F.coalesce("shipping", F.lit(0)),
            "fee": F.lit(150),
            "vat": F.lit(22),
            "refused": F.lit(False),
            "cancelled": F.col("o_orderstatus") == "F",
            "policy": F.when(F.col("o_orderpriority") == "1-URGENT", "FLAT_RATE").otherwise("DELIVERY_MODE"),
        }
    )
    cost = rates.citizen_cost(
        applies="applycost", refused="refused", cancelled="cancelled", policy="policy", fee="fee", shipping="shipping", vat="vat"
    )
    return joined.withColumn("cents", cost).select("creditortaxid", "noticecode", "o_orderkey", "cents")


@query("k25_citizen_cost", f"WITH {NOTICES_SQL} SELECT creditortaxid, noticecode, o_orderkey, cents FROM charged")
def citizen_cost(spark: SparkSession, folder: str) -> DataFrame:
    return charged_notices(spark, folder)


EXPECTED_SQL = "expected AS (SELECT DISTINCT 'T' || (p_partkey % 50) AS tax, 'N' || (p_partkey % 600) || '-0' AS nav FROM part)"


@query(
    "k25_reconciliation",
    f"""WITH {NOTICES_SQL}, {EXPECTED_SQL}
    SELECT 'matched' AS result, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM charged JOIN expected ON tax = creditortaxid AND nav = noticecode
    UNION ALL SELECT 'unmatched', count(*), NULL FROM expected WHERE NOT EXISTS (SELECT 1 FROM charged WHERE tax = creditortaxid AND nav = noticecode)""",
)
def reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """Expected payment notices matched and not matched."""
    key = F.col("p_partkey")
    expected = load(spark, folder, "part").select(
        F.concat(F.lit("T"), (key % 50).cast("string")).alias("tax"),
        F.concat(F.lit("N"), (key % 600).cast("string"), F.lit("-0")).alias("nav"),
    ).distinct()
    matched, missing = rates.reconcile(expected, charged_notices(spark, folder), {"tax": "creditortaxid", "nav": "noticecode"})
    a = matched.agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")).withColumn("result", F.lit("matched"))
    b = missing.agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("bigint").alias("cents")).withColumn("result", F.lit("unmatched"))
    return a.unionByName(b)


# -- reports ------------------------------------------------------------------


@query(
    "k26_limit_breaches",
    f"""WITH {PIECES_SQL} SELECT product, order_key, line, part_key, CAST(pages AS BIGINT) AS pages, cost FROM pieces
    WHERE (product = '1-URGENT' AND pages > 40) OR (product = '5-LOW' AND pages > 48)""",
)
def limit_breaches(spark: SparkSession, folder: str) -> DataFrame:
    out = reports.limit_breaches(pieces(spark, folder), {"1-URGENT": 40, "5-LOW": 48}, kind="product", pages="pages")
    return out.select("product", "order_key", "line", "part_key", "pages", "cost")


CONTRACT_SQL = """contract AS (
  SELECT sender, taxid FROM (
    SELECT o_custkey AS sender, 'TAX' || (o_orderkey % 3) AS taxid, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders WHERE o_orderstatus = 'F') WHERE rn = 1)"""


def contracts(spark: SparkSession, folder: str) -> DataFrame:
    """Party master changes stand-in: finished orders of a customer."""
    raw = load(spark, folder, "orders").select(
        F.col("o_custkey").alias("sender"),
        F.concat(F.lit("TAX"), (F.col("o_orderkey") % 3).cast("string")).alias("taxid"),
        "o_orderdate",
        "o_orderkey",
        "o_orderstatus",
    )
    return reports.latest_contract(raw, key="sender", updated="o_orderdate", tie=["o_orderkey"], active=F.col("o_orderstatus") == "F")


@query(
    "k27_taxid_mismatch",
    f"""WITH {CONTRACT_SQL}
    SELECT sender, 'TAX' || (o_orderkey % 3) AS taxid, c.taxid AS expected, count(*) AS n
    FROM orders JOIN contract c ON c.sender = o_custkey
    WHERE o_orderdate >= TIMESTAMP '1998-03-01' AND o_orderdate < TIMESTAMP '1998-04-01' AND 'TAX' || (o_orderkey % 3) <> c.taxid GROUP BY ALL""",
)
def taxid_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    facts = load(spark, folder, "orders").select(
        F.col("o_custkey").alias("sender"), F.concat(F.lit("TAX"), (F.col("o_orderkey") % 3).cast("string")).alias("taxid"), "o_orderdate"
    )
    return reports.mismatch_count(
        facts, contracts(spark, folder), fact_key="sender", contract_key="sender", actual="taxid", expected="taxid",
        by=["sender", "taxid"], period=dates.previous_month(dt.date(1998, 4, 17)), time="o_orderdate",
    )


@query(
    "k28_missing_attachment",
    f"""WITH {LINES_SQL} SELECT supp_key, count(*) AS items FROM lines WHERE accepted IS NOT NULL AND flag IN ('A', 'R') AND attempt IS NULL GROUP BY 1""",
)
def missing_attachment(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted pieces without an attempt record although they were shipped."""
    out = reports.missing_attachment(
        lines(spark, folder), completed="accepted", state="flag", states=["A", "R"], missing="attempt", present=["ship"]
    )
    return out.groupBy("supp_key").agg(F.count(F.lit(1)).alias("items"))


@query(
    "k29_billable_quarter",
    f"""WITH {LINES_SQL}, b AS (SELECT *, CASE WHEN flag = 'R' THEN ship END AS cancelled, CASE WHEN line = 7 THEN 'RECRN006' ELSE 'RECRN001C' END AS final FROM lines)
    SELECT supp_key, count(*) AS items, CAST(sum(cost) AS BIGINT) AS cost FROM b WHERE final <> 'RECRN006' AND (
      (year(attempt) = 1997 AND quarter(attempt) = 2) OR (year(cancelled) = 1997 AND quarter(cancelled) = 2)
      OR (line = 1 AND year(reported) = 1997 AND quarter(reported) = 2)) GROUP BY 1""",
)
def billable_quarter(spark: SparkSession, folder: str) -> DataFrame:
    """Items billable in a quarter: completed, cancelled or returned."""
    df = lines(spark, folder).withColumns(
        {"cancelled": F.when(F.col("flag") == "R", F.col("ship")), "final": F.when(F.col("line") == 7, "RECRN006").otherwise("RECRN001C")}
    )
    out = reports.billable(
        df, year=1997, quarter=2, completed="attempt", cancelled="cancelled", deceased=F.col("line") == 1, final_reported="reported", final="final"
    )
    return out.groupBy("supp_key").agg(F.count(F.lit(1)).alias("items"), F.sum("cost").alias("cost"))


@query(
    "k29_complete_without_events",
    f"""WITH {LINES_SQL}, d AS (SELECT *, coalesce(accepted, ship + INTERVAL 1 DAY) AS ref FROM lines)
    SELECT supp_key, count(*) AS items FROM d WHERE line <> 7 AND attempt IS NULL AND year(ref) = 1998 AND quarter(ref) = 3 GROUP BY 1""",
)
def complete_without_events(spark: SparkSession, folder: str) -> DataFrame:
    df = lines(spark, folder).withColumns(
        {"final": F.when(F.col("line") == 7, "RECRN013").otherwise("RECRN001C"), "gap": F.when(F.col("attempt").isNull(), 1).otherwise(0)}
    )
    out = reports.complete_without_events(df, year=1998, quarter=3, accepted="accepted", handed_over="ship", final="final", missing="gap")
    return out.groupBy("supp_key").agg(F.count(F.lit(1)).alias("items"))


RETRY_SQL = """retry AS (SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS fee, CAST(max(l_suppkey) AS BIGINT) AS tax FROM lineitem GROUP BY 1, 2)"""


def retries(spark: SparkSession, folder: str) -> DataFrame:
    li = load(spark, folder, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("bigint").alias("n")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("fee"), F.max("l_suppkey").alias("tax")
    )


@query(
    "k29_cost_gaps",
    f"""WITH {RETRY_SQL}
    SELECT a.k, a.n, b.fee - a.fee AS delta_fee, b.tax - a.tax AS delta_tax FROM retry a JOIN retry b ON b.k = a.k AND b.n = a.n + 1
    WHERE b.fee <> a.fee OR b.tax <> a.tax""",
)
def cost_gaps(spark: SparkSession, folder: str) -> DataFrame:
    out = reports.cost_gaps(retries(spark, folder), key=["k"], number="n", costs={"fee": "fee", "tax": "tax"})
    return out.select("k", "n", "delta_fee", "delta_tax")


@query(
    "k29_revenue_gaps",
    f"""WITH {LINES_SQL}, a AS (SELECT order_key, CAST(sum(cost) AS BIGINT) AS amount FROM lines WHERE flag = 'A' GROUP BY 1),
    b AS (SELECT order_key, CAST(sum(cost) AS BIGINT) AS amount FROM lines WHERE flag = 'R' GROUP BY 1)
    SELECT coalesce(a.order_key, b.order_key) AS order_key, a.amount AS left_amount, b.amount AS right_amount,
      coalesce(a.amount, 0) - coalesce(b.amount, 0) AS difference FROM a FULL JOIN b ON a.order_key = b.order_key""",
)
def revenue_gaps(spark: SparkSession, folder: str) -> DataFrame:
    df = lines(spark, folder)
    a = df.filter(F.col("flag") == "A").groupBy("order_key").agg(F.sum("cost").alias("amount"))
    b = df.filter(F.col("flag") == "R").groupBy("order_key").agg(F.sum("cost").alias("amount"))
    return reports.revenue_gaps(a, b, ["order_key"], "amount", "amount")


@query(
    "k29_blocked_items",
    f"""WITH {LINES_SQL}, b AS (SELECT *, CASE WHEN flag = 'A' AND line = 1 THEN 'PN999' END AS s1, CASE WHEN flag = 'R' AND line = 2 THEN 'PN998' END AS s2 FROM lines),
    dec AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'P' THEN ' tbd' END AS decision FROM orders)
    SELECT supp_key, decision, count(*) AS items FROM b LEFT JOIN dec ON o_orderkey = order_key
    WHERE (s1 IN ('PN998', 'PN999') OR s2 IN ('PN998', 'PN999')) AND (decision IS NULL OR upper(trim(decision)) = 'TBD') GROUP BY ALL""",
)
def blocked_items(spark: SparkSession, folder: str) -> DataFrame:
    df = lines(spark, folder).withColumns(
        {
            "s1": F.when((F.col("flag") == "A") & (F.col("line") == 1), "PN999"),
            "s2": F.when((F.col("flag") == "R") & (F.col("line") == 2), "PN998"),
        }
    )
    status = F.col("o_orderstatus")
    decisions = load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.when(status == "F", "closed").when(status == "P", " tbd").alias("decision")
    )
    out = reports.blocked_items(df, decisions, key="order_key", states=["s1", "s2"], decision="decision")
    return out.groupBy("supp_key", "decision").agg(F.count(F.lit(1)).alias("items"))


@query(
    "k30_accepted_backlog",
    f"""WITH {CONTRACT_SQL}, e AS (SELECT user_id, max(CAST(json_extract_string(props, '$.k') AS BIGINT)) FILTER (event_type = 'view') AS pages,
        max(ts) FILTER (event_type = 'purchase') AS paid_at, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS flag_kit FROM events GROUP BY 1)
    SELECT o_orderkey, c.taxid, e.pages, strftime(e.paid_at, '%Y-%m-%d %H:%M:%S') AS paid_at, CASE WHEN e.paid_at IS NULL THEN 0 ELSE 1 END::BIGINT AS flag_paid, coalesce(e.flag_kit, 0)::BIGINT AS flag_kit
    FROM orders JOIN contract c ON c.sender = o_custkey LEFT JOIN e ON e.user_id = o_custkey
    WHERE o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1999-01-01'""",
)
def accepted_backlog(spark: SparkSession, folder: str) -> DataFrame:
    """Open notifications with contract and the facts found in their event log."""
    kind = F.col("event_type")
    facts = reports.event_facts(
        load(spark, folder, "events"),
        "user_id",
        {
            "pages": F.when(kind == "view", F.get_json_object("props", "$.k").try_cast("bigint")),
            "paid_at": F.when(kind == "purchase", F.col("ts")),
            "flag_kit": F.when(kind == "error", 1).otherwise(0),
        },
    )
    backlog = reports.stale(
        load(spark, folder, "orders").filter(F.col("o_orderstatus") == "O"), sent="o_orderdate", before=dt.date(1999, 1, 1), completed=[]
    )
    named = backlog.join(contracts(spark, folder).select("sender", "taxid"), F.col("sender") == F.col("o_custkey"))
    out = named.join(facts, F.col("user_id") == F.col("o_custkey"), "left")
    return out.select(
        "o_orderkey", "taxid", "pages", "paid_at", F.when(F.col("paid_at").isNull(), 0).otherwise(1).alias("flag_paid"), F.coalesce("flag_kit", F.lit(0)).alias("flag_kit")
    )


@query(
    "k30_viewed_form",
    """SELECT DISTINCT e.user_id, o_orderkey FROM events e JOIN orders ON o_custkey = e.user_id
    WHERE e.event_type = 'view' AND CAST(json_extract_string(e.props, '$.k') AS BIGINT) > 90 AND e.ts >= TIMESTAMP '2024-01-10' AND o_orderpriority = '1-URGENT'""",
)
def viewed_form(spark: SparkSession, folder: str) -> DataFrame:
    """Notifications viewed through one channel that carry a form."""
    viewed = load(spark, folder, "events").filter(
        (F.col("event_type") == "view") & (F.col("ts") >= F.lit(dt.datetime(2024, 1, 10))) & (F.get_json_object("props", "$.k").try_cast("bigint") > 90)
    ).select("user_id").distinct()
    forms = load(spark, folder, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select("o_custkey", "o_orderkey")
    return viewed.join(forms, F.col("o_custkey") == F.col("user_id")).select("user_id", "o_orderkey").distinct()


@query(
    "k31_territory_trend",
    """SELECT n_name AS area, year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS items
    FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL""",
)
def territory_trend(spark: SparkSession, folder: str) -> DataFrame:
    customer = load(spark, folder, "customer").select("c_custkey", "c_nationkey")
    sent = load(spark, folder, "orders").join(customer, F.col("c_custkey") == F.col("o_custkey"))
    return reports.trend(sent, load(spark, folder, "nation"), on={"c_nationkey": "n_nationkey"}, area={"area": "n_name"}, day="o_orderdate")


@query(
    "k31_lead_time_trend",
    f"""WITH {LINES_SQL}, t AS (SELECT year(ship) AS year, month(ship) AS month, (epoch(reported) - epoch(ship)) AS sec FROM lines WHERE reported IS NOT NULL)
    SELECT year, month, CAST(sum(CAST(sec AS BIGINT)) AS BIGINT) AS seconds, count(*) AS n, CAST(sum(CAST(sec AS BIGINT)) AS DOUBLE) / 86400 / count(*) AS mean_days FROM t GROUP BY 1, 2""",
)
def lead_time_trend(spark: SparkSession, folder: str) -> DataFrame:
    """Mean days from hand-over to report per month, from whole seconds."""
    seconds = F.unix_timestamp("reported") - F.unix_timestamp("ship")
    timed = lines(spark, folder).filter(F.col("reported").isNotNull()).select(F.year("ship").alias("year"), F.month("ship").alias("month"), seconds.alias("s"))
    return timed.groupBy("year", "month").agg(F.sum("s").alias("seconds"), F.count("s").alias("n")).withColumn(
        "mean_days", F.col("seconds").cast("double") / 86400 / F.col("n")
    )


@query(
    "k32_active_purposes",
    """WITH p AS (SELECT c_custkey AS purpose_id, c_nationkey AS service, v.n AS version_id, CASE WHEN (c_custkey + v.n) % 3 = 0 THEN 'Archived' ELSE 'Active' END AS state, c_custkey % 100 AS consumer
      FROM customer, (VALUES (0), (1)) v(n)),
    a AS (SELECT DISTINCT s_nationkey AS service, s_suppkey % 100 AS consumer, s_nationkey % 5 AS producer, s_suppkey % 2 AS descriptor, s_suppkey AS agreement FROM supplier)
    SELECT purpose_id, CAST(version_id AS BIGINT) AS version_id, agreement AS agreement_id, CAST(a.service AS BIGINT) AS eserviceid, n_name AS eservice_name, a.descriptor AS descriptorid
    FROM p JOIN a ON a.service = p.service AND a.consumer = p.consumer JOIN nation ON n_nationkey = a.service WHERE state = 'Active' AND producer IN (1, 2)""",
)
def active_purposes(spark: SparkSession, folder: str) -> DataFrame:
    """Active versions from nested purposes with agreement, descriptor and consumer."""
    key = F.col("c_custkey")

    def version(n: int):
        state = F.when((key + n) % 3 == 0, "Archived").otherwise("Active")
        return F.struct(F.lit(n).alias("id"), state.alias("state"), F.lit(10).alias("dailycalls"))

    purposes = load(spark, folder, "customer").select(
        key.alias("id"), F.col("c_nationkey").alias("eserviceid"), (key % 100).alias("consumerid"), F.array(version(0), version(1)).alias("versions")
    )
    s = F.col("s_suppkey")
    agreements = load(spark, folder, "supplier").select(
        s.alias("id"), (F.col("s_nationkey") % 5).alias("producerid"), F.col("s_nationkey").alias("eserviceid"), (s % 100).alias("consumerid"),
        (s % 2).alias("descriptorid"), F.lit("active").alias("state"),
    )
    tenants = load(spark, folder, "supplier").select((s % 100).alias("id"), F.lit("tenant").alias("name")).distinct()

    def descriptor(n: int):
        return F.struct(F.lit(n).cast("bigint").alias("id"), F.lit(1).alias("version"), F.lit(5).alias("dailycallsperconsumer"), F.lit(50).alias("dailycallstotal"))

    services = load(spark, folder, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), (F.col("n_nationkey") % 5).alias("producerid"), F.array(descriptor(0), descriptor(1)).alias("descriptors")
    )
    out = reports.active_purposes(purposes, agreements, tenants, services, producers=[1, 2])
    return out.select("purpose_id", "version_id", "agreement_id", "eserviceid", "eservice_name", "descriptorid")


@query(
    "k33_area_coverage",
    """SELECT coalesce(CASE WHEN n_regionkey < 3 THEN n_name END, 'uncovered') AS area,
      count(DISTINCT CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END) AS with_kit,
      count(DISTINCT CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderkey END) AS without_kit
    FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""",
)
def area_coverage(spark: SparkSession, folder: str) -> DataFrame:
    customer = load(spark, folder, "customer").select("c_custkey", "c_nationkey")
    sent = load(spark, folder, "orders").join(customer, F.col("c_custkey") == F.col("o_custkey"))
    covered = load(spark, folder, "nation").filter(F.col("n_regionkey") < 3)
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return reports.coverage_by_area(
        sent, covered, on={"c_nationkey": "n_nationkey"}, area={"area": "n_name"}, item="o_orderkey",
        kinds={"with_kit": urgent, "without_kit": ~urgent}, missing="uncovered",
    )


# Wide item table for the quality rules, in the vocabulary of the presets.


def item_table(spark: SparkSession, folder: str) -> DataFrame:
    df = lines(spark, folder, spread_out=True)
    line, flag = F.col("line"), F.col("flag")
    eighth = ((flag == "A") & (line == 7) & (F.col("supp_key") % 2 == 0)).cast("int")
    df = df.withColumn("stem", F.concat(F.when(flag == "A", "RECAG00").otherwise("RECRN00"), (line + eighth).cast("string")))
    stem = F.col("stem")
    scanned = F.when(F.col("part_key") % 4 > 0, F.concat(stem, F.lit("B")))
    final = F.when(F.col("attempt").isNotNull(), F.concat(stem, F.lit("C")))
    stolen = F.when(flag == "A", "RECAG004").otherwise("RECRN006")
    certified = F.when(F.col("cost") % 41 == 0, stolen).when(F.col("supp_key") % 9 > 0, F.concat(stem, F.lit("A")))
    packet = F.when(F.col("part_key") % 8 == 0, F.concat(stem, F.lit("B")))
    notice = F.when(F.col("part_key") % 3 == 0, F.col("reported"))
    tables = [F.when(F.col("cost") % n == 0, 1).otherwise(0) for n in (31, 37)]
    attempt = first_match([(F.col("part_key") % 6 == 0, F.lit(None).cast("string")), (flag == "A", F.lit("RECAG010"))], F.lit("RECRN010"))
    return df.select(
        F.concat_ws("-", "order_key", "line", "part_key", "supp_key", "cost").alias("requestid"),
        "supp_key",
        F.when(flag == "A", "890").otherwise("AR").alias("prodotto"),
        certified.alias("certificazione_recapito_stato"),
        F.when(line % 5 == 0, "M02").when(line == 2, "M05").alias("certificazione_recapito_dettagli"),
        F.when(F.col("order_key") % 7 > 0, F.col("reported")).otherwise(F.col("attempt")).alias("certificazione_recapito_data"),
        F.col("reported").alias("fine_recapito_data"),
        final.alias("fine_recapito_stato"),
        attempt.alias("tentativo_recapito_stato"),
        F.col("ship").alias("tentativo_recapito_data"),
        F.when(F.col("part_key") % 5 > 0, F.lit("GIAC")).alias("messaingiacenza_recapito_stato"),
        scanned.alias("demat_23l_ar_stato"),
        F.when(scanned.isNotNull(), F.col("reported")).alias("demat_23l_ar_data_rendicontazione"),
        packet.alias("demat_plico_stato"),
        F.when(packet.isNotNull(), F.col("reported")).alias("demat_plico_data_rendicontazione"),
        F.when(F.col("part_key") % 9 == 0, F.concat(stem, F.lit("B"))).alias("demat_arcad_stato"),
        F.when(F.col("part_key") % 2 == 0, F.col("reported")).alias("demat_arcad_data_rendicontazione"),
        notice.alias("accettazione_23l_recag012_data"),
        dates.plus_days(notice, 1).alias("accettazione_23l_recag012_data_rendicontazione"),
        F.when(F.col("part_key") % 7 == 0, F.lit("23L")).when(F.col("part_key") % 7 == 1, F.lit("AR")).alias("documenttype"),
        F.when(F.col("cost") % 23 == 0, "PN999").otherwise("ok").alias("statusrequest"),
        F.when(F.col("cost") % 29 == 0, "P010").otherwise("R").alias("ultimo_evento_stato"),
        F.when(F.col("supp_key") % 13 == 0, "CON995").alias("scarto_consolidatore_stato"),
        F.when(F.col("cost") % 11 == 0, F.col("reported")).alias("tms_perfezionamento_notification"),
        F.when(F.col("cost") % 13 == 0, F.col("reported")).alias("tms_cancelled"),
        F.when(F.col("cost") % 17 == 0, 1).otherwise(0).alias("flag_schedule_refinement"),
        tables[0].alias("flag_tavolo_duplicati_poste"),
        tables[1].alias("flag_tavolo_non_rendicontabili_poste"),
        F.greatest(*tables).alias("flag_oggetto_tavoli_poste"),
        F.when(F.col("cost") % 19 == 0, 1).otherwise(0).alias("flag_wi7_report_postalizzazioni_incomplete"),
        F.when(F.col("cost") % 43 == 0, 1).otherwise(0).alias("flag_wi7_consolidatore"),
        (F.col("cost") % 2).cast("int").alias("flag_feedback_attempt_0"),
        F.when(F.col("cost") % 3 == 0, F.col("reported")).alias("tms_date_payment"),
    )


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_TRIPLETS = " ".join(
    f"WHEN cert = '{a}' AND (scan IN {_in(b)} OR packet IN {_in(b)} OR third IN {_in(b)}) AND fin = '{c}' THEN 0" for a, b, c in presets.CODE_TRIPLETS
)
_STORED = _in(presets.STORAGE_AR_RS_CLOSED + presets.STORAGE_890_CLOSED)
_STORED_890 = _in(presets.STORAGE_890_CLOSED)
_FAILED, _UNTRACEABLE = presets.REASON_FAILED, presets.REASON_UNTRACEABLE
_ATTEMPTED = [c for codes, _ in presets.ATTEMPT_CODES for c in codes]
_ATTEMPT_WHEN = " ".join(f"WHEN cert IN {_in(codes)} AND (att = '{a}' OR att IS NULL) THEN 0" for codes, a in presets.ATTEMPT_CODES)

ITEMS_SQL = LINES_SQL + f""",
stem AS (SELECT *, CASE WHEN flag = 'A' THEN 'RECAG00' || (line + (line = 7 AND supp_key % 2 = 0)::INT) ELSE 'RECRN00' || line END AS stem FROM lines),
item AS (
  SELECT concat_ws('-', order_key, line, part_key, supp_key, cost) AS requestid, supp_key, cost, CASE WHEN flag = 'A' THEN '890' ELSE 'AR' END AS prod,
    CASE WHEN cost % 41 = 0 THEN CASE WHEN flag = 'A' THEN 'RECAG004' ELSE 'RECRN006' END WHEN supp_key % 9 > 0 THEN stem || 'A' END AS cert, CASE WHEN line % 5 = 0 THEN 'M02' WHEN line = 2 THEN 'M05' END AS reason,
    CASE WHEN order_key % 7 > 0 THEN reported ELSE attempt END AS cert_day, reported AS fin_day, CASE WHEN attempt IS NOT NULL THEN stem || 'C' END AS fin,
    CASE WHEN part_key % 6 = 0 THEN NULL WHEN flag = 'A' THEN 'RECAG010' ELSE 'RECRN010' END AS att, ship AS att_day,
    CASE WHEN part_key % 5 > 0 THEN 'GIAC' END AS held, CASE WHEN part_key % 4 > 0 THEN stem || 'B' END AS scan, CASE WHEN part_key % 8 = 0 THEN stem || 'B' END AS packet, CASE WHEN part_key % 9 = 0 THEN stem || 'B' END AS third,
    CASE WHEN part_key % 2 = 0 THEN reported END AS arcad, CASE WHEN part_key % 3 = 0 THEN reported END AS notice,
    CASE WHEN part_key % 7 = 0 THEN '23L' WHEN part_key % 7 = 1 THEN 'AR' END AS doc, CASE WHEN cost % 3 = 0 THEN reported END AS paid,
    CASE WHEN supp_key % 13 = 0 THEN 1 END AS scrapped, CASE WHEN cost % 11 = 0 THEN reported END AS perfected, CASE WHEN cost % 13 = 0 THEN reported END AS cancelled
  FROM stem),
flagged AS (
  SELECT *,
    CASE WHEN cert NOT IN {_in(_FAILED[0] + _UNTRACEABLE[0])} AND reason IN {_in(presets.REASONS)} THEN 1
      WHEN cert IN {_in(_FAILED[0])} AND (reason NOT IN {_in(_FAILED[1])} OR reason IS NULL) THEN 1
      WHEN cert IN {_in(_UNTRACEABLE[0])} AND (reason NOT IN {_in(_UNTRACEABLE[1])} OR reason IS NULL) THEN 1 ELSE 0 END::BIGINT AS controllo_causale,
    CASE {_ATTEMPT_WHEN} WHEN cert NOT IN {_in(_ATTEMPTED)} AND att = cert THEN 0 ELSE 1 END::BIGINT AS controllo_inesito_casi_giacenza,
    CASE {_TRIPLETS} ELSE 1 END::BIGINT AS controllo_tripletta,
    CASE WHEN cert_day = fin_day THEN 0 ELSE 1 END::BIGINT AS controllo_date_business,
    CASE WHEN cert = 'RECRN005A' AND date_diff('day', CAST(att_day AS DATE), CAST(cert_day AS DATE)) < 30 THEN 1 ELSE 0 END::BIGINT AS controllo_tempistiche_compiuta_giacenza,
    CASE WHEN prod = '890' AND doc = '23L' THEN 0 WHEN prod = 'AR' AND doc = 'AR' THEN 0 WHEN doc IS NULL THEN 0 ELSE 1 END::BIGINT AS controllo_documenttype,
    CASE WHEN fin IN {_STORED} AND att IS NULL THEN 1 ELSE 0 END::BIGINT AS assenza_inesito,
    CASE WHEN fin IN {_STORED} AND held IS NULL THEN 1 ELSE 0 END::BIGINT AS assenza_messa_in_giacenza,
    CASE WHEN cert IS NULL THEN 1 ELSE 0 END::BIGINT AS assenza_pre_esito,
    CASE WHEN (fin = 'RECAG008C' AND (scan IS NULL OR packet IS NULL)) OR (scan IS NULL AND packet IS NULL) THEN 1 ELSE 0 END::BIGINT AS assenza_dematerializzazione_23l_ar_plico,
    CASE WHEN prod = '890' AND fin IN {_STORED_890} AND arcad IS NULL THEN 1 ELSE 0 END::BIGINT AS assenza_demat_arcad,
    CASE WHEN prod = '890' AND fin IN {_STORED_890} AND notice IS NULL THEN 1 ELSE 0 END::BIGINT AS assenza_recag012
  FROM item),
missing AS (SELECT *, greatest(assenza_inesito, assenza_messa_in_giacenza, assenza_pre_esito, assenza_dematerializzazione_23l_ar_plico, assenza_demat_arcad, assenza_recag012) AS flag_esiti_mancanti FROM flagged),
stated AS (
  SELECT *, CASE WHEN perfected IS NOT NULL THEN 'Oggetto perfezionato' WHEN cancelled IS NOT NULL THEN 'Oggetto cancellato'
    WHEN cost % 17 = 0 THEN 'Oggetto in previsione di perfezionamento' WHEN cost % 23 = 0 THEN 'Oggetto bloccato con PN998 / PN999'
    WHEN cost % 29 = 0 THEN 'Oggetto scartato con P008 / P010 / P011' WHEN scrapped IS NOT NULL THEN 'Oggetto scartato dal Consolidatore'
    WHEN cost % 31 = 0 THEN 'Oggetto rientrante in tavolo Duplicati 23i/23l Poste' WHEN cost % 37 = 0 THEN 'Oggetto rientrante in tavolo Non Rendicontabili Poste'
    WHEN cost % 19 = 0 OR cost % 43 = 0 THEN 'Oggetto fuori sla' WHEN reason = 'M02' THEN 'Oggetto restituito al mittente (esito destinatario deceduto)'
    WHEN cost % 41 = 0 THEN 'Oggetto esitato per Furto / Non Rendicontabile'
    WHEN fin IS NOT NULL AND wrong THEN 'Errore rendicontazione/assenza eventi intermedi'
    WHEN fin IS NOT NULL THEN 'Oggetto con rendicontazione corretta in analisi Team Prodotto' ELSE 'Oggetto in corso di postalizzazione' END AS state_text,
  CASE WHEN cost % 19 = 0 OR cost % 43 = 0 THEN 'Oggetto fuori sla' WHEN reason = 'M02' THEN 'Oggetto restituito al mittente (esito destinatario deceduto)'
    WHEN fin IS NOT NULL AND wrong THEN 'Errore rendicontazione/assenza eventi intermedi'
    WHEN NOT wrong THEN 'Oggetto con rendicontazione corretta in analisi Team Prodotto' ELSE 'Oggetto in corso di postalizzazione' END AS refinement_text
  FROM (SELECT *, (controllo_causale = 1 OR controllo_date_business = 1 OR controllo_tripletta = 1 OR controllo_tempistiche_compiuta_giacenza = 1
      OR controllo_inesito_casi_giacenza = 1 OR controllo_documenttype = 1 OR flag_esiti_mancanti = 1) AS wrong FROM missing))"""
_CONTROLS = ", ".join(quality.CONTROL_FLAGS)
_MISSING = [
    "assenza_inesito", "assenza_messa_in_giacenza", "assenza_pre_esito", "assenza_dematerializzazione_23l_ar_plico", "assenza_demat_arcad", "assenza_recag012", "flag_esiti_mancanti",
]


def flagged_items(spark: SparkSession, folder: str) -> DataFrame:
    return quality.progress_state(quality.missing_events(quality.control_flags(item_table(spark, folder))))


@query("p7_quality_flags", f"WITH {ITEMS_SQL} SELECT requestid, {_CONTROLS} FROM flagged")
def quality_flags(spark: SparkSession, folder: str) -> DataFrame:
    return quality.control_flags(item_table(spark, folder)).select("requestid", *quality.CONTROL_FLAGS)


@query(
    "p7_triplet_rule_table",
    f"WITH {ITEMS_SQL} SELECT controllo AS controllo, count(*) AS items FROM (SELECT CASE {_TRIPLETS.replace(' OR packet IN', ' OR NULL IN').replace(' OR third IN', ' OR NULL IN')} ELSE 1 END::BIGINT AS controllo FROM item) GROUP BY 1",
)
def triplet_rule_table(spark: SparkSession, folder: str) -> DataFrame:
    """The triplet control with the allowed triplets as a table."""
    rules = spark.createDataFrame([(a, b, c) for a, bs, c in presets.CODE_TRIPLETS for b in bs], "code_a string, code_b string, code_c string")
    out = quality.triplet_join_flag(
        item_table(spark, folder), rules, "certificazione_recapito_stato", "demat_23l_ar_stato", "fine_recapito_stato", "controllo"
    )
    return out.groupBy("controllo").agg(F.count(F.lit(1)).alias("items"))


@query("p8_missing_events", f"WITH {ITEMS_SQL} SELECT requestid, {', '.join(_MISSING)} FROM missing")
def missing_events(spark: SparkSession, folder: str) -> DataFrame:
    return quality.missing_events(item_table(spark, folder)).select("requestid", *_MISSING)


_STATE_CONDITIONS = [
    ("Oggetto perfezionato", "perfected IS NOT NULL"), ("Oggetto cancellato", "cancelled IS NOT NULL"), ("Oggetto in previsione di perfezionamento", "cost % 17 = 0"),
    ("Oggetto bloccato con PN998 / PN999", "cost % 23 = 0"), ("Oggetto scartato con P008 / P010 / P011", "cost % 29 = 0"), ("Oggetto scartato dal Consolidatore", "scrapped IS NOT NULL"),
    ("Oggetto rientrante in tavolo Duplicati 23i/23l Poste", "cost % 31 = 0"), ("Oggetto rientrante in tavolo Non Rendicontabili Poste", "cost % 37 = 0"),
    ("Oggetto fuori sla", "(cost % 19 = 0 OR cost % 43 = 0) AND cost % 31 > 0 AND cost % 37 > 0"), ("Oggetto restituito al mittente (esito destinatario deceduto)", "reason = 'M02'"),
    ("Oggetto esitato per Furto / Non Rendicontabile", "cost % 41 = 0"), ("Errore rendicontazione/assenza eventi intermedi", "fin IS NOT NULL AND wrong"),
    ("Oggetto con rendicontazione corretta in analisi Team Prodotto", "fin IS NOT NULL"), ("Oggetto in corso di postalizzazione", "true"),
]


@query(
    "p9_rule_coverage",
    f"WITH {ITEMS_SQL}, counts AS ("
    + " UNION ALL ".join(f"SELECT 'progress_state' AS name, 'weekly' AS version, {i + 1} AS position, '{label}' AS label, count(*) FILTER ({test}) AS held, count(*) FILTER (state_text = '{label}') AS decided FROM stated" for i, (label, test) in enumerate(_STATE_CONDITIONS))
    + ") SELECT name, version, CAST(position AS BIGINT) AS position, label, held, decided, CASE WHEN decided > 0 THEN 'decides' WHEN held = 0 THEN 'never reached' ELSE 'always covered' END AS verdict FROM counts",
)
def rule_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """How often each rule of the weekly state table holds and decides."""
    return quality.PROGRESS_STATES.coverage(quality.missing_events(quality.control_flags(item_table(spark, folder))))


@query("p9_refinement_state", f"WITH {ITEMS_SQL} SELECT requestid, refinement_text AS state_text FROM stated")
def refinement_state(spark: SparkSession, folder: str) -> DataFrame:
    """The second state list, of the refinement report."""
    items = quality.missing_events(quality.control_flags(item_table(spark, folder)))
    return quality.progress_state(items, "state_text", quality.REFINEMENT_STATES).select("requestid", "state_text")


@query("p9_progress_state", f"WITH {ITEMS_SQL} SELECT requestid, state_text FROM stated")
def progress_state(spark: SparkSession, folder: str) -> DataFrame:
    return flagged_items(spark, folder).select("requestid", F.col("stato_avanzamento_oggetti").alias("state_text"))


_TEXTS = [
    ("controllo_causale", "errore rend. causale"), ("controllo_date_business", "errore rend. date business"), ("controllo_tripletta", "errore rend. tripletta"),
    ("controllo_tempistiche_compiuta_giacenza", "errore rend. tempistiche compiuta giacenza"), ("controllo_inesito_casi_giacenza", "errore rend. inesito casi giacenza"),
    ("assenza_inesito", "assenza inesito"), ("assenza_messa_in_giacenza", "assenza messa in giacenza"), ("assenza_pre_esito", "assenza pre-esito"),
    ("assenza_dematerializzazione_23l_ar_plico", "assenza demat 23l_ar / plico"), ("assenza_demat_arcad", "assenza demat ARCAD"), ("assenza_recag012", "assenza RECAG012"),
    ("controllo_documenttype", "errore documentType"),
]


@query(
    "p10_error_detail",
    f"WITH {ITEMS_SQL} SELECT concat_ws(', ', {', '.join(f'CASE WHEN {c} = 1 THEN {chr(39)}{t}{chr(39)} END' for c, t in _TEXTS)}) AS detail, count(*) AS items FROM missing GROUP BY 1",
)
def error_detail(spark: SparkSession, folder: str) -> DataFrame:
    return flagged_items(spark, folder).groupBy(quality.error_detail().alias("detail")).agg(F.count(F.lit(1)).alias("items"))


@query(
    "p10_refinement_detail",
    f"""WITH {ITEMS_SQL} SELECT concat_ws(', ', {', '.join(f'CASE WHEN {c} = 1 AND fin IS NOT NULL THEN {chr(39)}{t}{chr(39)} END' for c, t in _TEXTS)},
      CASE WHEN NOT wrong AND coalesce(reason, '') <> 'M02' AND cost % 2 = 0 THEN 'da perfezionare' END,
      CASE WHEN NOT wrong AND coalesce(reason, '') <> 'M02' AND cost % 2 = 1 THEN 'bloccato al primo attempt' END) AS detail, count(*) AS items FROM stated GROUP BY 1""",
)
def refinement_detail(spark: SparkSession, folder: str) -> DataFrame:
    """Error texts of closed items, and the two texts of clean ones."""
    items = quality.missing_events(quality.control_flags(item_table(spark, folder)))
    return items.groupBy(quality.error_detail(quality.REFINEMENT_DETAILS).alias("detail")).agg(F.count(F.lit(1)).alias("items"))


@query(
    "k34_not_completed_by_cluster",
    f"""WITH {ITEMS_SQL} SELECT state_text AS cluster, count(DISTINCT requestid) AS items, count(DISTINCT CASE WHEN paid IS NOT NULL THEN requestid END) AS paid_items
    FROM stated WHERE perfected IS NULL AND cancelled IS NULL GROUP BY 1""",
)
def not_completed_by_cluster(spark: SparkSession, folder: str) -> DataFrame:
    open_items = flagged_items(spark, folder).filter(F.col("tms_perfezionamento_notification").isNull() & F.col("tms_cancelled").isNull())
    clustered = open_items.withColumnRenamed("stato_avanzamento_oggetti", "cluster")
    return quality.cluster_summary(clustered, "cluster", "requestid", "tms_date_payment")


_SCANNED_PACKET = _in(presets.PACKET_SCAN_REQUIRED)
_SCANNED_RECEIPT = _in(presets.RECEIPT_SCAN_REQUIRED)
# The six companions by name: a final state that lacks what it requires.
_EXCLUSIONS = {
    "notice_after_ten_days": f"fin IN {_in(presets.STORAGE_890_CLOSED[:3])} AND notice IS NULL AND date_diff('day', CAST(att_day AS DATE), CAST(fin_day AS DATE)) > 10",
    "notice": "fin = 'RECAG008C' AND notice IS NULL",
    "storage_document": f"fin IN {_STORED_890} AND arcad IS NULL",
    "packet_scan": f"fin IN {_SCANNED_PACKET} AND (packet IS NULL OR fin_day IS NULL)",
    "receipt_scan": f"fin IN {_SCANNED_RECEIPT} AND (scan IS NULL OR fin_day IS NULL)",
    "storage": f"fin IN {_STORED} AND held IS NULL",
}


@query(
    "p6_consistency_exclusion",
    f"WITH {ITEMS_SQL} SELECT supp_key, count(*) AS items FROM item WHERE NOT coalesce({' OR '.join(f'({test})' for test in _EXCLUSIONS.values())}, false) GROUP BY 1",
)
def consistency_exclusion(spark: SparkSession, folder: str) -> DataFrame:
    """Items that carry every companion event their final state requires."""
    kept = item_table(spark, folder).filter(~quality.excluded("fine_recapito_stato", quality.delivery_exclusions()))
    return kept.groupBy("supp_key").agg(F.count(F.lit(1)).alias("items"))


@query(
    "p6_exclusion_reasons",
    f"WITH {ITEMS_SQL} " + " UNION ALL ".join(f"SELECT '{name}' AS reason, count(*) FILTER ({test}) AS items FROM item" for name, test in _EXCLUSIONS.items()),
)
def exclusion_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Items that each of the six exclusions would take."""
    tests = [F.count_if(quality.excluded("fine_recapito_stato", [need])) for need in quality.delivery_exclusions()]
    rows = F.array(*[F.struct(F.lit(name).alias("reason"), n.alias("items")) for name, n in zip(_EXCLUSIONS, tests)])
    return item_table(spark, folder).agg(rows.alias("rows")).select(F.inline("rows"))
