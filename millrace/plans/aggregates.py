"""Aggregation queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates, money
from millrace.functions.rules import first_match
from millrace.operators import aggregates as ag
from millrace.operators import capacity, events as ev, joins, rates, reports
from millrace.plans.registry import query
from millrace.plans.standin import LINES_SQL, PIECES_SQL, lines, load, pieces


@query(
    "a1_conditional_counts",
    f"""WITH {LINES_SQL} SELECT supp_key, count(*) FILTER (attempt IS NOT NULL) AS completed, count(*) FILTER (attempt IS NULL AND flag <> 'N') AS in_progress,
      count(*) FILTER (pages > 40) AS heavy, count(*) AS total FROM lines GROUP BY 1""",
)
def conditional_counts(spark: SparkSession, folder: str) -> DataFrame:
    done = F.col("attempt").isNotNull()
    return ag.conditional_counts(
        lines(spark, folder), ["supp_key"], {"completed": done, "in_progress": ~done & (F.col("flag") != "N"), "heavy": F.col("pages") > 40}
    )


@query(
    "a2_pivot_with_total",
    f"""WITH {LINES_SQL}, p AS (SELECT CAST(supp_key AS VARCHAR) AS supplier, CAST(sum(CASE WHEN flag = 'A' THEN pages ELSE 0 END) AS BIGINT) AS a, CAST(sum(CASE WHEN flag = 'R' THEN pages ELSE 0 END) AS BIGINT) AS r, CAST(sum(pages) AS BIGINT) AS totale FROM lines GROUP BY 1)
    SELECT * FROM p UNION ALL SELECT 'TOTALE', CAST(sum(a) AS BIGINT), CAST(sum(r) AS BIGINT), CAST(sum(totale) AS BIGINT) FROM p""",
)
def pivot_with_total(spark: SparkSession, folder: str) -> DataFrame:
    df = lines(spark, folder).withColumn("supplier", F.col("supp_key").cast("string"))
    return ag.pivot_with_total(df, "supplier", "flag", {"a": "A", "r": "R"}, F.col("pages"))


@query(
    "a3_grouping_sets",
    f"""WITH {LINES_SQL} SELECT supp_key, strftime(ship, '%Y-%m') AS month, count(*) FILTER (attempt IS NOT NULL) AS completed, count(*) AS total,
      CAST(grouping(supp_key, strftime(ship, '%Y-%m')) AS BIGINT) AS level FROM lines GROUP BY GROUPING SETS ((supp_key, strftime(ship, '%Y-%m')), (supp_key), ())""",
)
def grouping_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Detail, subtotal and grand total in one pass."""
    df = lines(spark, folder).withColumn("month", dates.month_bucket("ship"))
    measures = {"completed": ag.Measure("count", "attempt"), "total": ag.Measure("rows")}
    return ag.level_sets(df, [["supp_key", "month"], ["supp_key"], []], measures, "level")


@query(
    "a4_count_distinct",
    "SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT CASE WHEN value > 20 THEN user_id END) AS big_users FROM events GROUP BY 1",
)
def count_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events").groupBy("event_type").agg(
        F.countDistinct("user_id").alias("users"), F.countDistinct(F.when(F.col("value") > 20, F.col("user_id"))).alias("big_users")
    )


@query(
    "a5_conditional_max_pivot",
    """SELECT user_id, strftime(max(ts) FILTER (event_type = 'error'), '%Y-%m-%d %H:%M:%S') AS failed_at, strftime(max(ts) FILTER (event_type = 'purchase'), '%Y-%m-%d %H:%M:%S') AS done_at FROM events GROUP BY 1""",
)
def conditional_max_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return ev.pivot_max(load(spark, folder, "events"), ["user_id"], "event_type", "ts", {"failed_at": "error", "done_at": "purchase"})


@query(
    "a6_having_duplicates",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS events FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def having_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return ev.repeated(load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "a6_having_unfinished",
    """WITH o AS (SELECT l_orderkey, l_linestatus, l_returnflag, l_shipdate, CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN 'done' WHEN l_returnflag = 'N' THEN 'planned' END AS kind FROM lineitem)
    SELECT l_orderkey, CAST(max(CASE WHEN kind = 'planned' THEN 1 ELSE 0 END) AS BIGINT) AS planned, strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS planned_at
    FROM o WHERE kind IS NOT NULL GROUP BY 1 HAVING count(*) FILTER (kind = 'done') = 0""",
)
def having_unfinished(spark: SparkSession, folder: str) -> DataFrame:
    """Keys that were planned and never finished."""
    flag = F.col("l_returnflag")
    kind = first_match([((F.col("l_linestatus") == "F") & (flag == "A"), "done"), (flag == "N", "planned")])
    df = load(spark, folder, "lineitem").select("l_orderkey", "l_shipdate", kind.alias("kind"))
    return ev.unfinished(df, "l_orderkey", "kind", "done", "planned", F.col("l_shipdate"))


@query(
    "a7_mean_duration",
    f"WITH {LINES_SQL} SELECT flag, year(ship) AS year, CAST(sum(date_diff('day', CAST(ship AS DATE), CAST(reported AS DATE))) AS BIGINT) AS total, count(reported) AS n, CAST(sum(date_diff('day', CAST(ship AS DATE), CAST(reported AS DATE))) AS DOUBLE) / count(reported) AS mean FROM lines GROUP BY 1, 2",
)
def mean_duration(spark: SparkSession, folder: str) -> DataFrame:
    df = lines(spark, folder).select("flag", F.year("ship").alias("year"), F.datediff("reported", "ship").alias("days"))
    return ag.mean_duration(df, ["flag", "year"], "days")


_CLASSES = [(0, 10), (11, 20), (21, 30), (31, 40), (41, 50), (51, 60), (61, 70), (71, 80)]


@query(
    "a8_histogram",
    f"""WITH {LINES_SQL}, d AS (SELECT year(ship) AS year, flag, date_diff('day', CAST(ship AS DATE), CAST(reported AS DATE)) AS v FROM lines WHERE reported IS NOT NULL)
    SELECT year, flag, count(*) AS n, CAST(sum(v) AS BIGINT) AS sum_value, {", ".join(f"count(*) FILTER (v BETWEEN {a} AND {b}) AS count_{a}_{b}, count(*) FILTER (v BETWEEN {a} AND {b}) * 100.0::DOUBLE / count(*) AS pct_{a}_{b}" for a, b in _CLASSES)},
      count(*) FILTER (v > 80) AS count_over, count(*) FILTER (v > 80) * 100.0::DOUBLE / count(*) AS pct_over FROM d GROUP BY 1, 2""",
)
def histogram(spark: SparkSession, folder: str) -> DataFrame:
    df = lines(spark, folder).filter(F.col("reported").isNotNull())
    return ag.histogram(df.select(F.year("ship").alias("year"), "flag", F.datediff("reported", "ship").alias("v")), ["year", "flag"], "v")


@query(
    "a9_ratio_with_tolerance",
    f"""WITH {LINES_SQL}, c AS (SELECT supp_key, count(*) AS items, count(*) FILTER (pages > 30) AS late FROM lines GROUP BY 1)
    SELECT *, greatest(late / items - 0.4::DOUBLE, 0.0) AS charged_share, greatest(late / items - 0.4::DOUBLE, 0.0) * items * 0.2::DOUBLE AS fee FROM c""",
)
def ratio_with_tolerance(spark: SparkSession, folder: str) -> DataFrame:
    counts = ag.conditional_counts(lines(spark, folder), ["supp_key"], {"late": F.col("pages") > 30}, total="items")
    share, fee = money.allowance_fee(F.col("late"), F.col("items"), 0.4, 0.2)
    return counts.withColumn("charged_share", share).withColumn("fee", fee)


@query(
    "a10_total_row",
    f"WITH {LINES_SQL} SELECT flag, state, count(*) AS items, CAST(sum(cost) AS BIGINT) AS cost, CAST(grouping(flag, state) AS BIGINT) AS level FROM lines GROUP BY GROUPING SETS ((flag, state), ())",
)
def total_row(spark: SparkSession, folder: str) -> DataFrame:
    """Detail rows and one total row, told apart by the grouping id."""
    measures = {"items": ag.Measure("rows"), "cost": ag.Measure("sum", "cost")}
    return ag.level_sets(lines(spark, folder), [["flag", "state"], []], measures, "level")


@query(
    "a11_mode_and_second",
    f"""WITH {LINES_SQL}, c AS (SELECT CAST(ship AS DATE) AS day, CAST(attempt AS DATE) AS v, count(*) AS n FROM lines GROUP BY ALL),
    r AS (SELECT *, rank() OVER w AS rk, dense_rank() OVER w AS dn FROM c WINDOW w AS (PARTITION BY day ORDER BY n DESC, v NULLS LAST))
    SELECT strftime(day, '%Y-%m-%d') AS day, strftime(max(v) FILTER (rk = 1), '%Y-%m-%d') AS first_date, max(n) FILTER (rk = 1) AS first_count, strftime(max(v) FILTER (dn = 2), '%Y-%m-%d') AS second_date FROM r GROUP BY day""",
)
def mode_and_second(spark: SparkSession, folder: str) -> DataFrame:
    df = lines(spark, folder).select(F.col("ship").cast("date").alias("day"), F.col("attempt").cast("date").alias("v"))
    return capacity.mode_dates(df, "day", "v")


@query(
    "a12_json_cost_sum",
    "SELECT user_id, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS cost FROM events WHERE event_type IN ('view', 'purchase') GROUP BY 1",
)
def json_cost_sum(spark: SparkSession, folder: str) -> DataFrame:
    chosen = load(spark, folder, "events").filter(F.col("event_type").isin("view", "purchase"))
    return rates.json_cost_sum(chosen, {"user_id": F.col("user_id")}, "props", "$.k", "cost")


@query(
    "a15_granularity",
    """SELECT 'orders' AS name, count(*) AS rows, count(DISTINCT o_orderkey) AS distinct_keys FROM orders
    UNION ALL SELECT 'lineitem', count(*), count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem""",
)
def granularity(spark: SparkSession, folder: str) -> DataFrame:
    """Rows against distinct keys of a unique and of a repeated key."""
    a = ag.granularity(load(spark, folder, "orders"), ["o_orderkey"]).withColumn("name", F.lit("orders"))
    b = ag.granularity(load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]).withColumn("name", F.lit("lineitem"))
    return a.unionByName(b)


@query(
    "a16_root_rekey",
    """WITH c AS (SELECT c_nationkey AS k, count(*) AS customers, count(*) FILTER (c_acctbal < 0) AS negative FROM customer GROUP BY 1),
    n AS (SELECT n_nationkey, CASE WHEN n_regionkey < 4 THEN n_regionkey + 1000 END AS root, CASE WHEN n_regionkey < 4 THEN r_name END AS rname, n_name FROM nation LEFT JOIN region ON r_regionkey = n_regionkey)
    SELECT CAST(coalesce(root, k) AS BIGINT) AS entity, coalesce(rname, n_name) AS entity_name, CAST(sum(customers) AS BIGINT) AS customers, CAST(sum(negative) AS BIGINT) AS negative FROM c JOIN n ON n_nationkey = k GROUP BY 1, 2""",
)
def root_rekey(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of children re-keyed to their root; orphans keep their own key."""
    nation, region = load(spark, folder, "nation"), load(spark, folder, "region")
    counts = ag.conditional_counts(load(spark, folder, "customer"), [F.col("c_nationkey").alias("k")], {"negative": F.col("c_acctbal") < 0}, total="customers")
    named = joins.enrich(counts, nation, {"k": "n_nationkey"}, {"own_name": "n_name"})
    inside = F.col("n_regionkey") < 4
    parents = nation.join(region, F.col("r_regionkey") == F.col("n_regionkey"), "left").select(
        "n_nationkey", F.when(inside, F.col("n_regionkey") + 1000).alias("root"), F.when(inside, F.col("r_name")).alias("root_name")
    )
    return ag.rekey_to_root(
        named, parents, key="k", child="n_nationkey", root="root", root_name="root_name", name="own_name", measures=["customers", "negative"]
    )


@query(
    "a17_overlapping_clusters",
    """WITH o AS (SELECT *, o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' AS in_year FROM orders)
    SELECT 'Digitale' AS cluster, count(*) AS items, count(*) FILTER (in_year) AS in_year FROM o WHERE o_orderstatus = 'O' AND o_totalprice < 300000
    UNION ALL SELECT 'Analogica', count(*), count(*) FILTER (in_year) FROM o WHERE o_orderstatus = 'F' AND o_totalprice < 300000
    UNION ALL SELECT 'Rifiutate', count(*), count(*) FILTER (in_year) FROM o WHERE o_totalprice >= 300000
    UNION ALL SELECT 'Totale', count(*), count(*) FILTER (in_year) FROM o""",
)
def overlapping_clusters(spark: SparkSession, folder: str) -> DataFrame:
    refused = F.col("o_totalprice") >= 300000
    status = F.col("o_orderstatus")
    year = dates.in_period("o_orderdate", (dt.date(1998, 1, 1), dt.date(1999, 1, 1)))
    clusters = {"Digitale": (status == "O") & ~refused, "Analogica": (status == "F") & ~refused, "Rifiutate": refused, "Totale": F.lit(True)}
    return ag.overlapping_clusters(load(spark, folder, "orders"), clusters, {"items": F.lit(True), "in_year": year})


@query(
    "a18_conversion_kpi",
    """WITH u AS (SELECT user_id, CAST(ts AS DATE) AS day, max(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS courtesy, max(CASE WHEN event_type IN ('purchase', 'view') THEN 1 ELSE 0 END) AS completed,
        max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS prepared, max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS digital FROM events GROUP BY 1, 2)
    SELECT strftime(day, '%Y-%m-%d') AS day, count(*) FILTER (completed = 1) AS completed, count(*) FILTER (completed = 1 AND courtesy = 1 AND digital = 0 AND prepared = 0) AS avoided,
      count(*) FILTER (completed = 1 AND courtesy = 1 AND digital = 0 AND prepared = 0) / nullif(count(*) FILTER (completed = 1), 0) AS share FROM u GROUP BY 1""",
)
def conversion_kpi(spark: SparkSession, folder: str) -> DataFrame:
    """Share of completions that needed no paper, from four event populations."""
    events = load(spark, folder, "events").withColumn("day", F.col("ts").cast("date"))
    populations = {"courtesy": ["signup"], "completed": ["purchase", "view"], "prepared": ["error"], "digital": ["click"]}
    flags = ag.population_flags(events, ["user_id", "day"], "event_type", populations)
    done = F.col("completed") == 1
    avoided = done & (F.col("courtesy") == 1) & (F.col("digital") == 0) & (F.col("prepared") == 0)
    counted = ag.conditional_counts(flags, ["day"], {"completed": done, "avoided": avoided}, total=None)
    return ag.shares(counted, {"share": "avoided"}, "completed")


@query(
    "a19_period_report",
    f"""WITH {PIECES_SQL}, p AS (SELECT *, CASE WHEN lot IN ('Brand#1', 'Brand#2', 'Brand#7') AND ref >= TIMESTAMP '1996-01-01' AND ref < TIMESTAMP '1999-01-01' THEN '1996-1998'
      WHEN lot IN ('Brand#2', 'Brand#7') AND ref >= TIMESTAMP '1999-01-01' AND ref < TIMESTAMP '2002-01-01' THEN '1999-2001' WHEN lot = 'Brand#30' THEN 'x' END AS period FROM (SELECT *, coalesce(accepted, ship) AS ref FROM pieces))
    SELECT lot, period, count(*) AS items, CAST(sum(cost) AS BIGINT) AS cost FROM p WHERE period IS NOT NULL GROUP BY 1, 2""",
)
def period_report(spark: SparkSession, folder: str) -> DataFrame:
    """Items and cost per lot within contract periods, in lot order."""
    periods = [
        (["Brand#1", "Brand#2", "Brand#7"], "1996-01-01", "1999-01-01", "1996-1998"),
        (["Brand#2", "Brand#7"], "1999-01-01", "2002-01-01", "1999-2001"),
    ]
    out = reports.period_report(pieces(spark, folder), lot="lot", day=F.coalesce("accepted", "ship"), periods=periods, cost="cost")
    return out.orderBy(*reports.lot_order("lot"), "period")


@query(
    "a20_ageing",
    f"""WITH {LINES_SQL}, a AS (SELECT supp_key, attempt IS NOT NULL AS done, attempt IS NULL AND flag = 'N' AS late, date_diff('day', CAST(ship AS DATE), DATE '2001-09-01') AS age FROM lines),
    c AS (SELECT supp_key, count(*) AS entrusted, count(*) FILTER (done) AS completed, count(*) FILTER (NOT done) AS open_items, count(*) FILTER (NOT done AND NOT late) AS in_progress,
      count(*) FILTER (late AND age <= 30) AS overdue_1m, count(*) FILTER (late AND age > 30 AND age <= 60) AS overdue_2m, count(*) FILTER (late AND age > 60) AS overdue_more FROM a GROUP BY 1)
    SELECT *, (overdue_1m + overdue_2m + overdue_more) / nullif(open_items, 0) AS overdue_share FROM c""",
)
def ageing(spark: SparkSession, folder: str) -> DataFrame:
    done = F.col("attempt").isNotNull()
    return ag.ageing(
        lines(spark, folder), ["supp_key"], since="ship", as_of=F.lit(dt.date(2001, 9, 1)), finished=done, overdue=~done & (F.col("flag") == "N")
    )


@query(
    "a21_counts_by_levels",
    f"""WITH {LINES_SQL}, b AS (SELECT *, year(ship) AS year, month(ship) AS month FROM lines)
    SELECT year, month, supp_key, flag, count(*) AS total, count(attempt) AS completed, count(*) FILTER (attempt IS NULL) AS delivering FROM b
    GROUP BY GROUPING SETS ((year), (year, month), (year, supp_key), (year, flag))""",
)
def counts_by_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Counts by year, month, carrier and product in one pass over the items."""
    df = lines(spark, folder).withColumn("year", F.year("ship")).withColumn("month", F.month("ship"))
    measures = {"total": ag.Measure("rows"), "completed": ag.Measure("count", "attempt"), "delivering": ag.Measure("rows", F.col("attempt").isNull())}
    return ag.level_sets(df, [["year"], ["year", "month"], ["year", "supp_key"], ["year", "flag"]], measures)


@query(
    "a22_outcome_shares",
    f"""WITH {LINES_SQL}, r AS (SELECT n_name AS region, flag, count(*) AS entrusted, count(*) FILTER (state = 'F' AND pages <= 25) AS direct, count(*) FILTER (state = 'F' AND pages > 25) AS stored,
        count(*) FILTER (attempt IS NULL) AS failed FROM lines JOIN supplier ON s_suppkey = supp_key JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2)
    SELECT *, direct / entrusted AS direct_share, stored / entrusted AS stored_share, failed / entrusted AS failed_share FROM r""",
)
def outcome_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Share of each outcome per region and product."""
    supplier = load(spark, folder, "supplier").select(F.col("s_suppkey").alias("supp_key"), "s_nationkey")
    placed = joins.enrich(lines(spark, folder).join(supplier, "supp_key"), load(spark, folder, "nation"), {"s_nationkey": "n_nationkey"}, {"region": "n_name"})
    final = F.col("state") == "F"
    outcomes = {"direct": final & (F.col("pages") <= 25), "stored": final & (F.col("pages") > 25), "failed": F.col("attempt").isNull()}
    return reports.outcome_shares(placed, ["region", "flag"], outcomes)


@query(
    "o1_conditional_order",
    "SELECT n_name AS nation, count(*) AS suppliers FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY GROUPING SETS ((n_name), ())",
)
def conditional_order(spark: SparkSession, folder: str) -> DataFrame:
    """Report order: named rows first, the total last."""
    nation = load(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("nation"))
    named = load(spark, folder, "supplier").join(nation, "s_nationkey")
    out = ag.grouping_sets(named, [["nation"], []], ["nation"], [F.count(F.lit(1)).alias("suppliers")])
    return out.orderBy(F.when(F.col("nation").isNull(), 1).otherwise(0), F.asc_nulls_last("nation"))
