"""Domain frames derived from the star-schema tables.

A mail piece is a ``lineitem`` row, a notification is an ``orders`` row, and
``events`` stands for the timeline and change logs. Each frame has an SQL twin
(``*_SQL``, a list of CTEs) used by the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.calendar import WorkCalendar
from millrace.functions.dates import plus_days
from millrace.functions.money import cents
from millrace.sources.readers import spread, table

CALENDAR = WorkCalendar.national(1994, 2003)
CALENDAR_2024 = WorkCalendar.national(2023, 2025)

# Columns that identify a mail piece.
PIECE_KEY = ["order_key", "line", "part_key", "supp_key", "cost", "ship"]


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return table(spark, f"{folder.rstrip('/')}/{name}.parquet")


def lines(spark: SparkSession, folder: str, spread_out: bool = False) -> DataFrame:
    """Mail pieces with milestones; no join. ``spread_out``: over all cores first, for long expressions."""
    li = load(spark, folder, "lineitem")
    if spread_out:
        li = spread(li, "l_orderkey")
    ship, pages = F.col("l_shipdate"), F.col("l_quantity").cast("int")
    accepted = F.when(F.col("l_returnflag") != "N", plus_days(ship, 0) + F.make_dt_interval(days=F.col("l_linenumber") - 3))
    attempt = F.when(F.col("l_discount") > 0, ship + F.make_dt_interval(days=pages))
    reported = attempt + F.make_dt_interval(days=F.round(F.col("l_tax") * 500).cast("int"), hours=F.lit(9))
    return li.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supp_key"),
        cents("l_extendedprice").alias("cost"),
        pages.alias("pages"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("state"),
        ship.alias("ship"),
        accepted.alias("accepted"),
        attempt.alias("attempt"),
        reported.alias("reported"),
    )


def pieces(spark: SparkSession, folder: str, spread_out: bool = True) -> DataFrame:
    """Mail pieces with lot, zone (part) and product, notification date (order)."""
    parts = load(spark, folder, "part").select(
        F.col("p_partkey").alias("part_key"), F.col("p_brand").alias("lot"), F.col("p_type").alias("zone")
    )
    orders = load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderpriority").alias("product"),
        F.col("o_orderdate").alias("sent"),
        F.col("o_custkey").alias("sender"),
    )
    return lines(spark, folder, spread_out).join(parts, "part_key").join(orders, "order_key")


def days_since(col: str) -> str:
    return f"CAST({col} AS DATE)"


_HOLIDAYS = ", ".join(f"(DATE '{d}')" for d in CALENDAR.holidays)
_HOLIDAYS_2024 = ", ".join(f"(DATE '{d}')" for d in CALENDAR_2024.holidays)

CAL_SQL = f"""hol(h) AS (VALUES {_HOLIDAYS}),
cal AS (
  SELECT CAST(d AS DATE) AS d,
         (isodow(d) < 6 AND CAST(d AS DATE) NOT IN (SELECT h FROM hol)) AS is_work,
         CAST(sum(CASE WHEN isodow(d) < 6 AND CAST(d AS DATE) NOT IN (SELECT h FROM hol) THEN 1 ELSE 0 END)
              OVER (ORDER BY d) AS BIGINT) AS idx
  FROM generate_series(TIMESTAMP '1994-01-01', TIMESTAMP '2003-12-31', INTERVAL 1 DAY) g(d)
)"""

LINES_SQL = """lines AS (
  SELECT l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line, l_partkey AS part_key, l_suppkey AS supp_key,
         CAST(round(CAST(l_extendedprice AS DECIMAL(18,4)) * 100, 0) AS BIGINT) AS cost,
         CAST(l_quantity AS INTEGER) AS pages, l_returnflag AS flag, l_linestatus AS state,
         l_shipdate AS ship,
         CASE WHEN l_returnflag <> 'N' THEN l_shipdate + (l_linenumber - 3) * INTERVAL 1 DAY END AS accepted,
         CASE WHEN l_discount > 0 THEN l_shipdate + CAST(l_quantity AS INTEGER) * INTERVAL 1 DAY END AS attempt,
         CASE WHEN l_discount > 0 THEN l_shipdate + CAST(l_quantity AS INTEGER) * INTERVAL 1 DAY
              + CAST(round(l_tax * 500) AS INTEGER) * INTERVAL 1 DAY + INTERVAL 9 HOUR END AS reported
  FROM lineitem
)"""

PIECES_SQL = LINES_SQL + """,
pieces AS (
  SELECT l.*, p_brand AS lot, p_type AS zone, o_orderpriority AS product, o_orderdate AS sent, o_custkey AS sender
  FROM lines l JOIN part ON p_partkey = part_key JOIN orders ON o_orderkey = order_key
)"""


def workdays_sql(start: str, end: str) -> str:
    """Scalar SQL for working days in (start, end]; needs ``cal``."""
    s, e = f"CAST({start} AS DATE)", f"CAST({end} AS DATE)"
    return (
        f"CASE WHEN {start} IS NULL OR {end} IS NULL THEN NULL WHEN {e} <= {s} THEN 0 "
        f"ELSE (SELECT idx FROM cal WHERE d = {e}) - (SELECT idx FROM cal WHERE d = {s}) END"
    )
