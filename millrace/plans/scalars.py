"""Projection and predicate queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates, money, presets, rules, text
from millrace.operators.aggregates import freshness, overlapping_clusters
from millrace.plans.registry import query
from millrace.plans.standin import LINES_SQL, lines, load


@query(
    "p1_prefix_rules",
    """SELECT CASE WHEN p_brand LIKE 'Brand#1%' THEN 'one' WHEN p_brand LIKE 'Brand#20%' OR p_brand LIKE 'Brand#24%' THEN 'late twenties'
      WHEN p_brand LIKE 'Brand#2%' THEN 'two' ELSE p_type END AS label, count(*) AS items FROM part GROUP BY 1""",
)
def prefix_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Label by ordered prefixes with the recorded value as fallback."""
    table = [("one", ["Brand#1"]), ("late twenties", ["Brand#20", "Brand#24"]), ("two", ["Brand#2"])]
    label = rules.prefix_label("p_brand", table, F.col("p_type"))
    return load(spark, folder, "part").groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("items"))


@query(
    "p1_carrier_label",
    """WITH c AS (SELECT CASE l_linenumber % 7 WHEN 0 THEN 'R14' WHEN 1 THEN '777' WHEN 2 THEN 'PSTAQ777' WHEN 3 THEN '211' WHEN 4 THEN '69' WHEN 5 THEN 'RB1' ELSE 'ZZ' END || l_partkey AS code,
      CASE WHEN l_suppkey % 2 = 0 THEN 'FSU' END AS recorded FROM lineitem)
    SELECT CASE WHEN code LIKE 'R14%' THEN 'Fulmine' WHEN code LIKE '777%' OR code LIKE 'PSTAQ777%' THEN 'POST & SERVICE' WHEN code LIKE '211%' THEN 'RTI Sailpost-Snem'
      WHEN code LIKE '69%' OR code LIKE '381%' OR code LIKE 'RB1%' THEN 'Poste' ELSE recorded END AS carrier, count(*) AS items FROM c GROUP BY 1""",
)
def carrier_label(spark: SparkSession, folder: str) -> DataFrame:
    kinds = ["R14", "777", "PSTAQ777", "211", "69", "RB1", "ZZ"]
    prefix = F.element_at(F.array(*[F.lit(k) for k in kinds]), F.col("l_linenumber") % 7 + 1)
    coded = load(spark, folder, "lineitem").select(
        F.concat(prefix, F.col("l_partkey").cast("string")).alias("code"), F.when(F.col("l_suppkey") % 2 == 0, "FSU").alias("recorded")
    )
    label = rules.prefix_label("code", presets.CARRIER_PREFIXES, F.col("recorded"))
    return coded.groupBy(label.alias("carrier")).agg(F.count(F.lit(1)).alias("items"))


@query(
    "p3_reference_date",
    f"""WITH {LINES_SQL} SELECT strftime(coalesce(accepted, ship + INTERVAL 1 DAY, reported), '%Y-%m-%d') AS day, count(*) AS items FROM lines GROUP BY 1""",
)
def reference_date(spark: SparkSession, folder: str) -> DataFrame:
    day = dates.reference_date("accepted", "ship", "reported").cast("date").alias("day")
    return lines(spark, folder).groupBy(day).agg(F.count(F.lit(1)).alias("items"))


@query(
    "p4_first_last_milestone",
    f"""WITH {LINES_SQL}, m AS (SELECT *, least(accepted, attempt, reported) AS f, greatest(accepted, attempt) AS l FROM lines)
    SELECT order_key, strftime(min(f), '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(max(l), '%Y-%m-%d %H:%M:%S') AS last_seen, count(f) AS n FROM m GROUP BY 1""",
)
def first_last_milestone(spark: SparkSession, folder: str) -> DataFrame:
    """Earliest and latest milestone, skipping missing ones, NULL if all are."""
    df = lines(spark, folder).select(
        "order_key", dates.earliest("accepted", "attempt", "reported").alias("f"), dates.latest("accepted", "attempt").alias("l")
    )
    return df.groupBy("order_key").agg(F.min("f").alias("first_seen"), F.max("l").alias("last_seen"), F.count("f").alias("n"))


@query(
    "p5_completion_date",
    """WITH u AS (SELECT user_id, min(ts) FILTER (event_type = 'view') AS viewed, min(ts) FILTER (event_type = 'purchase') AS effective FROM events GROUP BY 1)
    SELECT user_id, strftime(least(viewed, effective), '%Y-%m-%d %H:%M:%S') AS completed, viewed < effective AS by_view FROM u""",
)
def completion_date(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    per_user = load(spark, folder, "events").groupBy("user_id").agg(
        F.min(F.when(kind == "view", F.col("ts"))).alias("viewed"), F.min(F.when(kind == "purchase", F.col("ts"))).alias("effective")
    )
    return per_user.select("user_id", dates.earliest("viewed", "effective").alias("completed"), (F.col("viewed") < F.col("effective")).alias("by_view"))


@query(
    "p11_nested_fields",
    """SELECT o_orderpriority AS priority, o_orderstatus AS status, count(*) AS items, CAST(sum(CAST(round(CAST(o_totalprice AS DECIMAL(18,4)) * 100, 0) AS BIGINT)) AS BIGINT) AS cents
    FROM orders GROUP BY 1, 2""",
)
def nested_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Access to fields of nested structs."""
    inner = F.struct(F.col("o_orderstatus").alias("status"), money.cents("o_totalprice").alias("cents"))
    nested = load(spark, folder, "orders").select(F.struct(F.col("o_orderpriority").alias("priority"), inner.alias("detail")).alias("o"))
    return nested.groupBy(F.col("o.priority").alias("priority"), F.col("o.detail.status").alias("status")).agg(
        F.count(F.lit(1)).alias("items"), F.sum("o.detail.cents").alias("cents")
    )


@query(
    "p12_json_path",
    """SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type, count(*) AS n FROM events GROUP BY 1, 2""",
)
def json_path(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("bigint").alias("k")
    return load(spark, folder, "events").groupBy(k, "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p13_regex_extract",
    r"""SELECT CAST(nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS BIGINT) AS number,
      CASE WHEN starts_with(url, 'https://') THEN substr(url, 9) ELSE url END AS address, count(*) AS n FROM pages GROUP BY 1, 2""",
)
def regex_extract(spark: SparkSession, folder: str) -> DataFrame:
    """Number after a tag and removal of a fixed prefix."""
    out = load(spark, folder, "pages").select(text.attempt_number("url", "/").alias("number"), text.strip_prefix("url", "https://").alias("address"))
    return out.groupBy("number", "address").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p14_text_slicing",
    """SELECT c_custkey, substr(c_name, 1, 8) AS head, CASE WHEN instr(c_name, '#') > 0 THEN substr(c_name, instr(c_name, '#') + 1) END AS tail,
      lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS padded, upper(trim('  ' || c_mktsegment || ' ')) AS segment, CAST(length(c_name) AS BIGINT) AS size FROM customer""",
)
def text_slicing(spark: SparkSession, folder: str) -> DataFrame:
    padded = F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" "))
    return load(spark, folder, "customer").select(
        "c_custkey",
        F.substring("c_name", 1, 8).alias("head"),
        text.after_mark("c_name", "#").alias("tail"),
        text.postcode(F.col("c_custkey")).alias("padded"),
        F.upper(F.trim(padded)).alias("segment"),
        F.length("c_name").alias("size"),
    )


@query(
    "p15_timestamp_repair",
    """WITH t AS (SELECT CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%MZ') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS t FROM events)
    SELECT CASE WHEN length(t) = 17 THEN substr(t, 1, 16) || ':00Z' ELSE t END AS fixed, count(*) AS n FROM t GROUP BY 1""",
)
def timestamp_repair(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm'Z'")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    fixed = load(spark, folder, "events").select(text.repair_timestamp(raw).alias("fixed"))
    return fixed.groupBy("fixed").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p16_date_parts",
    """SELECT year(o_orderdate) AS year, CAST(ceil(month(o_orderdate) / 3.0) AS BIGINT) AS quarter, strftime(o_orderdate, '%Y-%m') AS bucket,
      strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start, strftime(date_trunc('month', o_orderdate) + INTERVAL 2 MONTH, '%Y-%m-%d') AS plus_two,
      strftime(max(CAST(o_orderdate AS DATE) - 30), '%Y-%m-%d') AS latest_minus_30, count(*) AS items FROM orders GROUP BY 1, 2, 3, 4, 5""",
)
def date_parts(spark: SparkSession, folder: str) -> DataFrame:
    d = F.col("o_orderdate")
    month = F.trunc(d, "month")
    return load(spark, folder, "orders").groupBy(
        F.year(d).alias("year"),
        F.ceil(F.month(d) / 3).alias("quarter"),
        dates.month_bucket(d).alias("bucket"),
        month.alias("month_start"),
        F.add_months(month, 2).alias("plus_two"),
    ).agg(F.max(F.date_sub(d, 30)).alias("latest_minus_30"), F.count(F.lit(1)).alias("items"))


@query(
    "p17_rolling_periods",
    """SELECT 'month' AS period, count(*) AS items FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01' AND o_orderdate < TIMESTAMP '1998-07-01'
    UNION ALL SELECT 'quarter', count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '1998-04-01' AND o_orderdate < TIMESTAMP '1998-07-01'
    UNION ALL SELECT 'until', count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-07-01'""",
)
def rolling_periods(spark: SparkSession, folder: str) -> DataFrame:
    """Previous month, previous quarter and everything until the month, one scan."""
    as_of = dt.date(1998, 7, 14)
    periods = {
        "month": dates.previous_month(as_of),
        "quarter": dates.previous_quarter(as_of),
        "until": dates.until_month_start(as_of, dt.date(1996, 1, 1)),
    }
    orders = load(spark, folder, "orders").select("o_orderdate").filter(dates.in_period("o_orderdate", periods["until"]))
    tests = {name: dates.in_period("o_orderdate", p) for name, p in periods.items()}
    return overlapping_clusters(orders, tests, {"items": F.lit(True)}, out="period")


@query(
    "p18_elapsed",
    f"""WITH {LINES_SQL} SELECT supp_key, CAST(sum(epoch(reported) - epoch(ship)) AS BIGINT) AS seconds, max(CAST(epoch(reported) - epoch(ship) AS DOUBLE) / 86400) AS longest_days,
      CAST(sum(date_diff('day', CAST(ship AS DATE), CAST(reported AS DATE))) AS BIGINT) AS whole_days,
      CAST(sum(CASE WHEN CAST(reported AS DATE) >= CAST(attempt AS DATE) + 7 THEN (epoch(reported) - epoch(CAST(CAST(attempt AS DATE) + 7 AS TIMESTAMP))) // 3600 END) AS BIGINT) AS hours_late
    FROM lines GROUP BY 1""",
)
def elapsed(spark: SparkSession, folder: str) -> DataFrame:
    """Fractional days, whole days and hours after a day boundary."""
    return lines(spark, folder).groupBy("supp_key").agg(
        F.sum(F.unix_timestamp("reported") - F.unix_timestamp("ship")).alias("seconds"),
        F.max(dates.elapsed_days("ship", "reported")).alias("longest_days"),
        F.sum(F.datediff("reported", "ship")).alias("whole_days"),
        F.sum(dates.hours_after_boundary("reported", "attempt", 7)).alias("hours_late"),
    )


@query(
    "p20_safe_division",
    f"""WITH {LINES_SQL} SELECT order_key, count(*) FILTER (flag = 'A') / nullif(count(*) FILTER (flag = 'R'), 0) AS ratio FROM lines GROUP BY 1""",
)
def safe_division(spark: SparkSession, folder: str) -> DataFrame:
    ratio = money.safe_ratio(F.count_if(F.col("flag") == "A"), F.count_if(F.col("flag") == "R"))
    return lines(spark, folder).groupBy("order_key").agg(ratio.alias("ratio"))


@query(
    "p21_code_dictionary",
    """SELECT CASE ' C0' || (l_linenumber) WHEN ' C01' THEN 'Incendio' WHEN ' C02' THEN 'Strada chiusa per lavori in corso o frana'
      WHEN ' C03' THEN 'Strada chiusa dalle autorità per eventi eccezionali' WHEN ' C04' THEN 'Maltempo: Alluvione, Neve, Allagamento'
      WHEN ' C05' THEN 'Terremoto' WHEN ' C06' THEN 'Eruzione vulcanica' ELSE 'Causale non rendicontata' END AS cause, count(*) AS n FROM lineitem GROUP BY 1""",
)
def code_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    code = F.concat(F.lit(" C0"), F.col("l_linenumber").cast("string"))
    label = rules.code_text(code, presets.CAUSE_TEXTS, presets.CAUSE_DEFAULT)
    return load(spark, folder, "lineitem").groupBy(label.alias("cause")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p22_weight_bands",
    """SELECT CAST(b.code AS BIGINT) AS band, count(*) AS n FROM lineitem LEFT JOIN (VALUES (1, 1, 20), (2, 21, 50), (3, 51, 100), (4, 101, 250), (5, 251, 350), (6, 351, 1000), (7, 1001, 2000)) b(code, lo, hi)
      ON l_quantity * l_linenumber * 8 BETWEEN lo AND hi GROUP BY 1""",
)
def weight_bands(spark: SparkSession, folder: str) -> DataFrame:
    weight = F.col("l_quantity") * F.col("l_linenumber") * 8
    band = rules.band_code(weight, presets.WEIGHT_BANDS).alias("band")
    return load(spark, folder, "lineitem").groupBy(band).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p23_key_kinds",
    """WITH k AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE CAST(p_partkey AS VARCHAR) END AS k FROM part)
    SELECT CASE WHEN regexp_full_match(k, '[0-9]+') THEN 'national' WHEN regexp_full_match(k, '[^0-9]+') THEN 'foreign' END AS kind, count(*) AS n FROM k GROUP BY 1""",
)
def key_kinds(spark: SparkSession, folder: str) -> DataFrame:
    key = F.when(F.col("p_partkey") % 3 == 0, F.col("p_type")).otherwise(F.col("p_partkey").cast("string"))
    df = load(spark, folder, "part").select(key.alias("k"))
    kind = rules.first_match([(text.digits_only("k"), "national"), (text.no_digits("k"), "foreign")])
    return df.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p24_business_key",
    """SELECT p_brand AS lot, p_type AS kind, CAST(p_size AS BIGINT) AS size, count(*) AS lines FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3""",
)
def business_key(spark: SparkSession, folder: str) -> DataFrame:
    """Join on a business key of three columns, compared part by part."""
    part = load(spark, folder, "part")
    key = ["p_brand", "p_type", "p_size"]
    items = load(spark, folder, "lineitem").join(part.select("p_partkey", *key), F.col("p_partkey") == F.col("l_partkey"))
    counts = items.groupBy(*key).agg(F.count(F.lit(1)).alias("lines"))
    catalogue = part.select(*key).distinct()
    return catalogue.join(counts, key).select(
        F.col("p_brand").alias("lot"), F.col("p_type").alias("kind"), F.col("p_size").alias("size"), "lines"
    )


@query(
    "a14_freshness",
    "SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS oldest, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS newest FROM events",
)
def data_freshness(spark: SparkSession, folder: str) -> DataFrame:
    return freshness(load(spark, folder, "events"), "ts")
