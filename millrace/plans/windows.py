"""Window queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators import events as ev
from millrace.operators import ordered
from millrace.plans.registry import query
from millrace.plans.standin import LINES_SQL, lines, load

TIE = ["order_key", "line", "part_key", "supp_key", "cost", "ship"]
TIE_SQL = "order_key, line, part_key, supp_key, cost, ship"


@query(
    "w1_latest_row",
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def latest_row(spark: SparkSession, folder: str) -> DataFrame:
    rows = load(spark, folder, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return ordered.top_row(rows, ["user_id"], ["ts", "event_id"]).drop("ts")


def ranked_lines(spark: SparkSession, folder: str) -> DataFrame:
    """What ranks by page count need of a line: hot groups are written and dealt with all their columns."""
    return lines(spark, folder).select(*TIE, "pages", "flag", F.col("attempt").isNotNull().alias("tried"))


@query(
    "w2_ranked_share",
    f"""WITH {LINES_SQL} SELECT order_key, line, part_key, supp_key, cost, CASE WHEN attempt IS NOT NULL THEN row_number() OVER w END AS rank,
      count(*) OVER (PARTITION BY flag) AS total, CASE WHEN attempt IS NOT NULL THEN row_number() OVER w END / count(*) OVER (PARTITION BY flag) AS share
    FROM lines WINDOW w AS (PARTITION BY flag ORDER BY (attempt IS NOT NULL) DESC, pages, {TIE_SQL})""",
)
def ranked_share(spark: SparkSession, folder: str) -> DataFrame:
    """Rank and share in three groups that each hold a third of all rows."""
    order = [F.col("pages").asc(), *[F.col(t).asc_nulls_first() for t in TIE]]
    out = ordered.ranked_share(ranked_lines(spark, folder), ["flag"], order, measured=F.col("tried"))
    return out.select("order_key", "line", "part_key", "supp_key", "cost", "rank", "total", "share")


@query(
    "w2_ranked_share_in_pieces",
    f"""WITH {LINES_SQL} SELECT order_key, line, part_key, supp_key, cost, CASE WHEN attempt IS NOT NULL THEN row_number() OVER w END AS rank,
      count(*) OVER (PARTITION BY flag) AS total, CASE WHEN attempt IS NOT NULL THEN row_number() OVER w END / count(*) OVER (PARTITION BY flag) AS share
    FROM lines WINDOW w AS (PARTITION BY flag ORDER BY (attempt IS NOT NULL) DESC, pages, {TIE_SQL})""",
)
def ranked_share_in_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the limit for hot groups set low, so that they are cut."""
    order = [F.col("pages").asc(), *[F.col(t).asc_nulls_first() for t in TIE]]
    out = ordered.ranked_share(
        ranked_lines(spark, folder), ["flag"], order, measured=F.col("tried"), hot_rows=1000, piece_rows=50_000
    )
    return out.select("order_key", "line", "part_key", "supp_key", "cost", "rank", "total", "share")


@query(
    "w3_global_rank",
    f"WITH {LINES_SQL} SELECT order_key, line, part_key, supp_key, cost, row_number() OVER (ORDER BY pages, {TIE_SQL}) AS rank FROM lines",
)
def global_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Rank over the whole table; large tables are ranked in pieces."""
    order = [F.col("pages").asc(), *[F.col(t).asc_nulls_first() for t in TIE]]
    out = ordered.row_number(lines(spark, folder).select(*TIE, "pages"), [], order)
    return out.select("order_key", "line", "part_key", "supp_key", "cost", "rank")


@query(
    "w3_global_rank_in_pieces",
    f"WITH {LINES_SQL} SELECT order_key, line, part_key, supp_key, cost, row_number() OVER (ORDER BY pages, {TIE_SQL}) AS rank FROM lines",
)
def global_rank_in_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the limit set low, by range pieces and offsets."""
    order = [F.col("pages").asc(), *[F.col(t).asc_nulls_first() for t in TIE]]
    out = ordered.row_number(lines(spark, folder).select(*TIE, "pages"), [], order, hot_rows=0, piece_rows=500_000)
    return out.select("order_key", "line", "part_key", "supp_key", "cost", "rank")


@query(
    "w4_rank_dense_rank",
    """WITH c AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2)
    SELECT *, rank() OVER (PARTITION BY p_brand ORDER BY n DESC) AS rk, dense_rank() OVER (PARTITION BY p_brand ORDER BY n DESC) AS dense FROM c""",
)
def rank_dense_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks over aggregated counts, a few rows per group."""
    counts = load(spark, folder, "part").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    spec = Window.partitionBy("p_brand").orderBy(F.desc("n"))
    return counts.withColumn("rk", F.rank().over(spec)).withColumn("dense", F.dense_rank().over(spec))


@query(
    "w5_running_sum",
    f"WITH {LINES_SQL} SELECT order_key, line, part_key, supp_key, cost, CAST(sum(pages) OVER (PARTITION BY ship ORDER BY order_key, line, part_key, supp_key, cost ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM lines",
)
def running_sum(spark: SparkSession, folder: str) -> DataFrame:
    order = [F.col(t).asc_nulls_first() for t in TIE[:-1]]
    out = ordered.running_sum(lines(spark, folder), ["ship"], order, "pages", "running")
    return out.select("order_key", "line", "part_key", "supp_key", "cost", "running")


@query(
    "w6_partition_total",
    f"""WITH {LINES_SQL} SELECT strftime(ship, '%Y-%m-%d') AS day, supp_key, CAST(sum(pages) AS BIGINT) AS pages, CAST(sum(sum(pages)) OVER (PARTITION BY ship) AS BIGINT) AS day_pages FROM lines GROUP BY ship, supp_key""",
)
def partition_total(spark: SparkSession, folder: str) -> DataFrame:
    """Day total beside each part, summed from the grouped rows."""
    parts = lines(spark, folder).groupBy(F.col("ship").cast("date").alias("day"), "supp_key").agg(F.sum("pages").alias("pages"))
    return parts.withColumn("day_pages", F.sum("pages").over(Window.partitionBy("day")))


@query(
    "w7_lag_lead",
    """SELECT event_id, user_id, lag(event_type) OVER w AS prev_type, strftime(lead(ts) OVER w, '%Y-%m-%d %H:%M:%S') AS next_ts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def lag_lead(spark: SparkSession, folder: str) -> DataFrame:
    rows = load(spark, folder, "events").select("event_id", "user_id", "ts", "event_type")
    out = ordered.lag_lead(rows, ["user_id"], ["ts", "event_id"], lag={"prev_type": "event_type"}, lead={"next_ts": "ts"})
    return out.drop("ts", "event_type")


@query(
    "w8_first_last_event",
    """SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_kind, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_at, arg_max(event_type, (ts, event_id)) AS last_kind, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_at FROM events GROUP BY 1""",
)
def first_last_event(spark: SparkSession, folder: str) -> DataFrame:
    return ev.first_last(load(spark, folder, "events"), ["user_id"], ["ts", "event_id"], {"kind": "event_type", "at": "ts"})


@query(
    "w9_final_attempt",
    f"""WITH {LINES_SQL} SELECT order_key, line, part_key, cost FROM (SELECT *, row_number() OVER (PARTITION BY order_key ORDER BY line DESC, ship DESC, part_key DESC, supp_key DESC, cost DESC) AS rn FROM lines WHERE state = 'F') WHERE rn = 1""",
)
def final_attempt(spark: SparkSession, folder: str) -> DataFrame:
    """Last attempt per notification among the closed ones."""
    rows = lines(spark, folder).filter(F.col("state") == "F").select("order_key", "line", "ship", "part_key", "supp_key", "cost")
    return ordered.top_row(rows, ["order_key"], ["line", "ship", "part_key", "supp_key", "cost"]).select("order_key", "line", "part_key", "cost")
