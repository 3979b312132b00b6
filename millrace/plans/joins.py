"""Join queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import joins, rates
from millrace.operators.reports import latest_contract
from millrace.plans.domain import INTERVALS_SQL, change_log, spans
from millrace.plans.registry import query
from millrace.plans.standin import load


@query(
    "j1_enrich_dimension",
    "SELECT n_name AS nation, r_name AS region, count(*) AS customers FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2",
)
def enrich_dimension(spark: SparkSession, folder: str) -> DataFrame:
    customers = load(spark, folder, "customer").select("c_nationkey")
    placed = joins.enrich(customers, load(spark, folder, "nation"), {"c_nationkey": "n_nationkey"}, {"nation": "n_name", "r": "n_regionkey"})
    named = joins.enrich(placed, load(spark, folder, "region"), {"r": "r_regionkey"}, {"region": "r_name"})
    return named.groupBy("nation", "region").agg(F.count(F.lit(1)).alias("customers"))


@query(
    "j2_inner_multiway",
    """SELECT n_name AS nation, p_brand AS brand, count(*) AS items FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey
    JOIN nation ON n_nationkey = s_nationkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2""",
)
def inner_multiway(spark: SparkSession, folder: str) -> DataFrame:
    li = load(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey")
    orders = load(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    supplier = load(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    part = load(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"))
    nation = load(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    joined = li.join(orders, "l_orderkey").join(supplier, "l_suppkey").join(nation, "n_nationkey").join(part, "l_partkey")
    return joined.groupBy("nation", "brand").agg(F.count(F.lit(1)).alias("items"))


@query(
    "j4_validity_join",
    f"""WITH {INTERVALS_SQL}
    SELECT e.event_id, s.event_id AS span_id FROM events e JOIN spans s ON s.user_id = e.user_id AND e.ts >= s.valid_from AND e.ts < s.valid_to WHERE e.event_type = 'purchase'""",
)
def validity_join(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases with the registry version valid at their time."""
    bought = load(spark, folder, "events").filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    out = joins.interval_join(bought, spans(spark, folder), on={"user_id": "user_id"}, at="ts", start="valid_from", end="valid_to")
    return out.select("event_id", "span_id")


@query(
    "j4_validity_join_blocked",
    f"""WITH {INTERVALS_SQL}
    SELECT e.event_id, s.event_id AS span_id FROM events e JOIN spans s ON s.user_id = e.user_id AND e.ts >= s.valid_from AND e.ts < s.valid_to WHERE e.event_type = 'purchase'""",
)
def validity_join_blocked(spark: SparkSession, folder: str) -> DataFrame:
    """The same through time blocks, the plan for large registries."""
    bought = load(spark, folder, "events").filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    out = joins.interval_join(
        bought, spans(spark, folder), on={"user_id": "user_id"}, at="ts", start="valid_from", end="valid_to", broadcast_rows=0
    )
    return out.select("event_id", "span_id")


@query(
    "j5_registry_diagnosis",
    f"""WITH {INTERVALS_SQL}, reg AS (SELECT DISTINCT user_id FROM change),
    t AS (SELECT o_orderkey, o_custkey AS user_id, TIMESTAMP '2024-01-01' + CAST(o_orderkey % 700 AS INTEGER) * INTERVAL 1 HOUR AS ts FROM orders)
    SELECT o_orderkey, CASE WHEN EXISTS (SELECT 1 FROM spans s WHERE s.user_id = t.user_id AND t.ts >= s.valid_from AND t.ts < s.valid_to) THEN 'CODICE_VALIDO_NEL_MOMENTO'
      WHEN user_id IN (SELECT user_id FROM reg) THEN 'CODICE_PRESENTE_MA_NON_VALIDO' ELSE 'CODICE_NON_PRESENTE_NEL_REGISTRY' END AS outcome FROM t""",
)
def registry_diagnosis(spark: SparkSession, folder: str) -> DataFrame:
    """Each transaction's code: valid at its time, only present, or absent."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    transactions = load(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("user_id"),
        (start + F.make_dt_interval(hours=(F.col("o_orderkey") % 700).cast("int"))).alias("ts"),
    )
    # Every row of the registry makes its code known, whatever its event.
    registered = change_log(spark, folder).select("user_id")
    out = joins.coverage(
        transactions,
        spans(spark, folder),
        on={"user_id": "user_id"},
        at="ts",
        start="valid_from",
        end="valid_to",
        registered=registered,
        out="outcome",
        labels=("CODICE_VALIDO_NEL_MOMENTO", "CODICE_PRESENTE_MA_NON_VALIDO", "CODICE_NON_PRESENTE_NEL_REGISTRY"),
    )
    return out.select("o_orderkey", "outcome")


@query(
    "j6_consecutive_retries",
    """WITH t AS (SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS n, count(*) AS c FROM lineitem GROUP BY 1, 2)
    SELECT a.k, a.n, a.c AS items, b.c AS next_items FROM t a JOIN t b ON b.k = a.k AND b.n = a.n + 1""",
)
def consecutive_retries(spark: SparkSession, folder: str) -> DataFrame:
    tries = load(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("bigint").alias("n")).agg(
        F.count(F.lit(1)).alias("items")
    )
    return joins.consecutive(tries, ["k"], "n", {"next_items": "items"})


@query(
    "j7_full_outer",
    """WITH c AS (SELECT c_nationkey AS k, count(*) AS customers FROM customer GROUP BY 1), s AS (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier GROUP BY 1)
    SELECT CAST(coalesce(c.k, s.k) AS BIGINT) AS nation, customers, suppliers FROM c FULL JOIN s ON c.k = s.k""",
)
def full_outer(spark: SparkSession, folder: str) -> DataFrame:
    customers = load(spark, folder, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("n"))
    suppliers = load(spark, folder, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("n"))
    return joins.full_outer(customers, suppliers, ["nation"], {"customers": "n"}, {"suppliers": "n"})


@query(
    "j8_left_anti",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')",
)
def left_anti(spark: SparkSession, folder: str) -> DataFrame:
    """Orders without any returned line."""
    returned = load(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return load(spark, folder, "orders").select("o_orderkey", "o_orderstatus").join(returned, "o_orderkey", "left_anti")


@query(
    "j9_not_in",
    """WITH big AS (SELECT CASE WHEN l_quantity >= 48 THEN l_orderkey END AS k FROM lineitem WHERE l_quantity >= 48),
    holes AS (SELECT CASE WHEN l_quantity < 50 THEN l_orderkey END AS k FROM lineitem)
    SELECT 'not_in' AS test, count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT k FROM big)
    UNION ALL SELECT 'not_in_with_null', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT k FROM holes)
    UNION ALL SELECT 'in', count(*) FROM orders WHERE o_orderkey IN (SELECT k FROM holes)""",
)
def not_in(spark: SparkSession, folder: str) -> DataFrame:
    """NOT IN with and without a NULL on the right, and IN."""
    orders = load(spark, folder, "orders").select("o_orderkey")
    li = load(spark, folder, "lineitem")
    big = li.filter(F.col("l_quantity") >= 48).select(F.col("l_orderkey").alias("k"))
    holes = li.select(F.when(F.col("l_quantity") < 50, F.col("l_orderkey")).alias("k"))
    tests = {
        "not_in": joins.not_in(orders, "o_orderkey", big, "k"),
        "not_in_with_null": joins.not_in(orders, "o_orderkey", holes, "k"),
        "in": joins.only_in(orders, "o_orderkey", holes, "k"),
    }
    out = None
    for name, kept in tests.items():
        row = kept.agg(F.count(F.lit(1)).alias("n")).withColumn("test", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "j10_one_row_total",
    "SELECT l_returnflag, count(*) AS n, (SELECT count(*) FROM lineitem) AS total, count(*) / (SELECT count(*) FROM lineitem) AS share FROM lineitem GROUP BY 1",
)
def one_row_total(spark: SparkSession, folder: str) -> DataFrame:
    """Share of the grand total; the total comes from the grouped rows."""
    counts = load(spark, folder, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).withColumn("share", F.col("n") / F.col("total"))


@query(
    "j11_two_source_check",
    """WITH a AS (SELECT p_brand AS b, p_size AS z, CAST(max(CAST(p_retailprice AS DECIMAL(10,2)) * 100) AS BIGINT) AS price FROM part GROUP BY 1, 2),
    t AS (SELECT p_brand AS b, p_size AS z, CAST(min(CAST(p_retailprice AS DECIMAL(10,2)) * 100) AS BIGINT) AS price FROM part WHERE p_type <> 'PROMO' GROUP BY 1, 2)
    SELECT a.b AS brand, CAST(a.z AS BIGINT) AS size, a.price, a.price = t.price AS correct FROM a LEFT JOIN t ON t.b = a.b AND t.z = a.z""",
)
def two_source_check(spark: SparkSession, folder: str) -> DataFrame:
    """Two sources of a price compared on a composite key."""
    part = load(spark, folder, "part").withColumn("c", (F.col("p_retailprice").cast("decimal(10,2)") * 100).cast("bigint"))
    card = part.groupBy(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).agg(F.max("c").alias("price"))
    test = part.filter(F.col("p_type") != "PROMO").groupBy(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).agg(F.min("c").alias("measured"))
    return rates.check_card(card, test, ["brand", "size"], {"correct": ("price", "measured")}).select("brand", "size", "price", "correct")


@query(
    "j12_latest_contract",
    """WITH l AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders WHERE o_orderstatus <> 'P')
    SELECT c_custkey, c_mktsegment, o_orderkey AS contract, o_totalprice AS price FROM customer LEFT JOIN l ON o_custkey = c_custkey AND rn = 1""",
)
def latest_contract_enrichment(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    last = latest_contract(orders, key="o_custkey", updated="o_orderdate", tie=["o_orderkey"], active=F.col("o_orderstatus") != "P")
    customers = load(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return joins.enrich(customers, last, {"c_custkey": "o_custkey"}, {"contract": "o_orderkey", "price": "o_totalprice"})


