"""Set operations and run-to-run comparison queries."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import joins
from millrace.operators.ordered import top_row
from millrace.plans.registry import query
from millrace.plans.standin import load
from millrace.session import scratch_root
from millrace.streaming import incremental as inc

RUN = "2024-02-01 08:00:00"


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "orders")


def _previous(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that were open at the first run."""
    return _orders(spark, folder).filter((F.col("o_orderdate") < F.lit(dt.datetime(1999, 1, 1))) & (F.col("o_orderstatus") != "F"))


def _current(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that were open at the second run."""
    return _orders(spark, folder).filter((F.col("o_orderdate") >= F.lit(dt.datetime(1997, 1, 1))) & (F.col("o_orderstatus") != "P"))


PREV_SQL = "prev AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' AND o_orderstatus <> 'F')"
CURR_SQL = "curr AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderstatus <> 'P')"


@query(
    "o2_distinct_on_subset",
    """SELECT l_orderkey, l_suppkey, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_shipdate, l_partkey, l_linenumber, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""",
)
def distinct_on_subset(spark: SparkSession, folder: str) -> DataFrame:
    """One row per key pair, chosen by a stable order."""
    rows = load(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_extendedprice", "l_shipdate", "l_linenumber")
    kept = top_row(rows, ["l_orderkey", "l_suppkey"], ["l_shipdate", "l_partkey", "l_linenumber", "l_extendedprice"], keep="first")
    return kept.drop("l_shipdate", "l_linenumber")


@query(
    "o3_unions",
    """SELECT 'union' AS kind, k, 1::BIGINT AS n FROM (SELECT c_nationkey::BIGINT AS k FROM customer UNION SELECT s_nationkey FROM supplier)
    UNION ALL SELECT 'union_all', k, count(*) FROM (SELECT c_nationkey::BIGINT AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier) GROUP BY k""",
)
def unions(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct union and union of all rows, matched by name."""
    a = load(spark, folder, "customer").select(F.col("c_nationkey").cast("bigint").alias("k"))
    b = load(spark, folder, "supplier").select(F.col("s_nationkey").cast("bigint").alias("k"))
    both = a.unionByName(b)
    distinct = both.distinct().select(F.lit("union").alias("kind"), "k", F.lit(1).cast("bigint").alias("n"))
    counted = both.groupBy("k").agg(F.count(F.lit(1)).alias("n")).select(F.lit("union_all").alias("kind"), "k", "n")
    return distinct.unionByName(counted)


@query(
    "o3b_union_missing_columns",
    "SELECT c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_name, NULL, s_acctbal FROM supplier",
)
def union_missing_columns(spark: SparkSession, folder: str) -> DataFrame:
    a = load(spark, folder, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = load(spark, folder, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return a.unionByName(b, allowMissingColumns=True)


@query(
    "o4_snapshot_diff",
    f"""WITH {PREV_SQL}, {CURR_SQL} SELECT coalesce(c.o_orderkey, p.o_orderkey) AS o_orderkey, CASE WHEN p.o_orderkey IS NULL THEN 'new' WHEN c.o_orderkey IS NULL THEN 'left' ELSE 'kept' END AS status
    FROM curr c FULL JOIN prev p ON p.o_orderkey = c.o_orderkey""",
)
def snapshot_diff(spark: SparkSession, folder: str) -> DataFrame:
    return inc.snapshot_diff(_previous(spark, folder), _current(spark, folder), ["o_orderkey"])


BUCKETS = 16


def _kept(spark: SparkSession, df: DataFrame, keys: list[str]) -> str:
    """The earlier run's snapshot as a table of its own."""
    name = f"snapshot_{uuid.uuid4().hex}"
    inc.write_snapshot(df, name, keys, BUCKETS, f"{scratch_root(spark).rstrip('/')}/{name}")
    return name


@query(
    "o4_snapshot_diff_stored",
    f"""WITH {PREV_SQL}, {CURR_SQL} SELECT coalesce(c.o_orderkey, p.o_orderkey) AS o_orderkey, CASE WHEN p.o_orderkey IS NULL THEN 'new' WHEN c.o_orderkey IS NULL THEN 'left' ELSE 'kept' END AS status
    FROM curr c FULL JOIN prev p ON p.o_orderkey = c.o_orderkey""",
)
def snapshot_diff_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same against a snapshot kept in buckets, which is not shuffled again."""
    table = _kept(spark, _previous(spark, folder).select("o_orderkey"), ["o_orderkey"])
    return inc.diff_to_snapshot(_current(spark, folder), table, ["o_orderkey"], BUCKETS)


@query(
    "o6_new_since_snapshot",
    f"""WITH {PREV_SQL}, {CURR_SQL} SELECT o_orderkey, o_custkey FROM curr WHERE o_orderkey NOT IN (SELECT o_orderkey FROM prev)""",
)
def new_since_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the extraction that the kept snapshot does not have."""
    table = _kept(spark, _previous(spark, folder).select("o_orderkey"), ["o_orderkey"])
    return inc.not_in_snapshot(_current(spark, folder), table, ["o_orderkey"], BUCKETS).select("o_orderkey", "o_custkey")


def _stock(spark: SparkSession, folder: str) -> DataFrame:
    return _previous(spark, folder).select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("first_seen"), F.lit(0).alias("is_new"))


@query(
    "o4_stock_refresh",
    f"""WITH {PREV_SQL}, {CURR_SQL} SELECT c.o_orderkey, c.o_custkey, strftime(coalesce(p.o_orderdate, TIMESTAMP '{RUN}'), '%Y-%m-%d %H:%M:%S') AS first_seen, CASE WHEN p.o_orderkey IS NULL THEN 1 ELSE 0 END::BIGINT AS is_new
    FROM curr c LEFT JOIN prev p ON p.o_orderkey = c.o_orderkey""",
)
def stock_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Current stock with the first-seen time of items that were there before."""
    extract = _current(spark, folder).select("o_orderkey", "o_custkey")
    return inc.refresh_stock(
        _stock(spark, folder), extract, key="o_orderkey", order=["o_custkey"], run_time=F.lit(RUN).cast("timestamp"), first_seen="first_seen", is_new="is_new"
    )


HIST_SQL = "hist AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1996-01-01')"


def _history(spark: SparkSession, folder: str) -> DataFrame:
    gone = _orders(spark, folder).filter((F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < F.lit(dt.datetime(1996, 1, 1))))
    return gone.select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").alias("first_seen"), F.lit("2024-01-01 08:00:00").cast("timestamp").alias("left_at"), F.lit(1).alias("is_new")
    )


def _departed(spark: SparkSession, folder: str) -> DataFrame:
    return inc.append_departed(
        _stock(spark, folder), _current(spark, folder), _history(spark, folder), key="o_orderkey", order=["o_custkey"],
        run_time=F.lit(RUN).cast("timestamp"), left_at="left_at", is_new="is_new",
    )


@query(
    "o4_departed_history",
    f"""WITH {PREV_SQL}, {CURR_SQL}, {HIST_SQL}
    SELECT o_orderkey, o_custkey, '2024-01-01 08:00:00' AS left_at, 0::BIGINT AS is_new FROM hist
    UNION ALL SELECT o_orderkey, o_custkey, '{RUN}', 1 FROM prev WHERE o_orderkey NOT IN (SELECT o_orderkey FROM curr) AND o_orderkey NOT IN (SELECT o_orderkey FROM hist)""",
)
def departed_history(spark: SparkSession, folder: str) -> DataFrame:
    """Items that left, each appended to the history once."""
    return _departed(spark, folder).drop("first_seen")


@query(
    "o5_history_report",
    f"""WITH {PREV_SQL}, {CURR_SQL}, {HIST_SQL}, gone AS (SELECT o_orderkey, o_custkey FROM hist UNION SELECT o_orderkey, o_custkey FROM prev WHERE o_orderkey NOT IN (SELECT o_orderkey FROM curr)),
    al AS (SELECT o_custkey, o_orderkey, max(g) AS g FROM (SELECT o_custkey, o_orderkey, 1 AS g FROM gone UNION ALL SELECT o_custkey, o_orderkey, 0 FROM curr) GROUP BY 1, 2)
    SELECT o_custkey, count(*) AS presented, count(*) FILTER (g = 1) AS resolved, count(*) FILTER (g = 0) AS still_open FROM al GROUP BY 1""",
)
def history_report(spark: SparkSession, folder: str) -> DataFrame:
    return inc.history_report(_current(spark, folder), _departed(spark, folder), key="o_orderkey", by=["o_custkey"])


def _extract(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events").withColumn("cause", F.concat(F.lit(" "), F.col("event_type"), F.lit(" ")))


@query(
    "o6_new_events",
    """WITH p AS (SELECT DISTINCT user_id, upper(event_type) AS c, ts FROM events WHERE ts < TIMESTAMP '2024-01-20'),
    e AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, ts ORDER BY event_id) AS rn FROM events)
    SELECT event_id, e.user_id, value FROM e WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM p WHERE p.user_id = e.user_id AND p.c = upper(e.event_type) AND p.ts = e.ts)""",
)
def new_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events not seen in the previous extraction, by normalised key."""
    now = _extract(spark, folder)
    before = load(spark, folder, "events").filter(F.col("ts") < F.lit(dt.datetime(2024, 1, 20))).withColumn("cause", F.upper("event_type"))
    fresh = inc.new_events(now, before, texts={"user_id": False, "cause": True}, time="ts", order=["event_id"])
    return fresh.select("event_id", "user_id", "value")


@query(
    "o7_weekly_delta",
    f"WITH {PREV_SQL}, {CURR_SQL} SELECT o_orderkey, o_orderstatus FROM curr WHERE o_orderkey NOT IN (SELECT o_orderkey FROM prev)",
)
def weekly_delta(spark: SparkSession, folder: str) -> DataFrame:
    return inc.delta(_current(spark, folder), _previous(spark, folder), ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@query(
    "o8_authorisation_overlay",
    """WITH a AS (SELECT o_custkey, o_orderpriority AS reason, strftime(o_orderdate, '%Y-%m-%d') AS day, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders WHERE o_orderstatus = 'F')
    SELECT c_custkey, CASE WHEN rn = 1 THEN 1 ELSE 0 END::BIGINT AS authorised, reason, day FROM customer LEFT JOIN a ON o_custkey = c_custkey AND rn = 1""",
)
def authorisation_overlay(spark: SparkSession, folder: str) -> DataFrame:
    """Flag, reason and day of the last authorisation per item."""
    granted = _orders(spark, folder).filter(F.col("o_orderstatus") == "F").select(
        F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("c_custkey"), "o_orderdate", "o_orderkey",
        F.col("o_orderpriority").alias("reason"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )
    items = load(spark, folder, "customer").select("c_custkey")
    return inc.overlay_authorisations(items, granted, key="c_custkey", order=["o_orderdate", "o_orderkey"], cols=["reason", "day"])


@query(
    "o9_restart_window",
    """WITH log AS (SELECT ts AS ended, CASE WHEN event_type = 'error' THEN 'KO' ELSE 'OK' END AS state FROM events WHERE ts < TIMESTAMP '2024-01-25')
    SELECT event_type, count(*) AS n FROM events WHERE ts >= (SELECT CAST(CAST(max(ended) AS DATE) AS TIMESTAMP) FROM log WHERE state = 'OK') GROUP BY 1""",
)
def restart_window(spark: SparkSession, folder: str) -> DataFrame:
    """Events from the day of the last successful run on."""
    events = load(spark, folder, "events")
    log = events.filter(F.col("ts") < F.lit(dt.datetime(2024, 1, 25))).select(
        F.col("ts").alias("ended"), F.when(F.col("event_type") == "error", "KO").otherwise("OK").alias("state")
    )
    window = inc.restart_from(log, ended="ended", state="state", done="OK", default=F.lit(dt.date(2024, 1, 1)))
    return inc.since_restart(events, "ts", window).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "o10_event_summary",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS carrier, coalesce(CASE WHEN value > 20 THEN 'dear' END, 'NON DISPONIBILE') AS cap, count(*) AS n FROM events GROUP BY 1, 2, 3""",
)
def event_summary(spark: SparkSession, folder: str) -> DataFrame:
    df = load(spark, folder, "events").select(
        "ts", F.concat(F.lit(" "), F.col("event_type")).alias("carrier"), F.when(F.col("value") > 20, "dear").when(F.col("value") > 5, " ").alias("cap")
    )
    return inc.event_summary(df, time="ts", by=["carrier", "cap"])


@query(
    "o11_key_list",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50 AND l_returnflag = 'R')",
)
def key_list(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a listed key set, however long the list is."""
    listed = load(spark, folder, "lineitem").filter((F.col("l_quantity") == 50) & (F.col("l_returnflag") == "R")).select("l_orderkey")
    return joins.key_list(_orders(spark, folder), "o_orderkey", listed, "l_orderkey").select("o_orderkey", "o_totalprice")
