"""Source and sink queries: what is written must read back as it was."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import money, text
from millrace.plans.registry import query
from millrace.plans.standin import load
from millrace.session import scratch_root
from millrace.sources import readers, writers

PART_SQL = "SELECT p_partkey, p_brand, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part"


def _part(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")


def _target(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@query(
    "s1_read_table",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS pages FROM lineitem GROUP BY 1, 2",
)
def read_table(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("pages")
    )


@query("s2_csv_schema", PART_SQL)
def csv_with_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Delimited round trip with an all-text schema and casts."""
    path = _target(spark, "csv")
    writers.export_csv(_part(spark, folder), path)
    raw = readers.csv(spark, path, readers.text_schema("p_partkey", "p_brand", "p_size", "p_retailprice"))
    return raw.select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_brand", F.col("p_size").cast("int").alias("p_size"),
        F.col("p_retailprice").cast("double").alias("p_retailprice"),
    )


@query("s3_csv_inferred", PART_SQL)
def csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = _target(spark, "csv")
    writers.export_csv(_part(spark, folder), path)
    raw = readers.csv(spark, path)
    return raw.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_brand", "p_size", "p_retailprice")


@query(
    "s4_decimal_comma",
    "SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 100 AS BIGINT) AS cents FROM part",
)
def decimal_comma(spark: SparkSession, folder: str) -> DataFrame:
    written = F.regexp_replace(F.col("p_retailprice").cast("decimal(10,2)").cast("string"), r"\.", ",")
    return load(spark, folder, "part").select("p_partkey", text.decimal_comma_cents(written).alias("cents"))


@query(
    "s5_two_format_dates",
    """SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate ELSE o_orderdate + INTERVAL 615 MINUTE END, '%Y-%m-%d %H:%M:%S') AS starts,
      strftime(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL 1439 MINUTE ELSE o_orderdate + INTERVAL 615 MINUTE END, '%Y-%m-%d %H:%M:%S') AS ends FROM orders""",
)
def two_format_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Day or minute text; a bare day starts at midnight and ends at 23:59."""
    raw = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(
        F.concat(F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(" 10:15"))
    )
    return load(spark, folder, "orders").withColumn("raw", raw).select(
        "o_orderkey", text.parse_day_or_minute("raw", "00:00").alias("starts"), text.parse_day_or_minute("raw", "23:59").alias("ends")
    )


@query("s6_overwrite", PART_SQL)
def table_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """A second write replaces the first one completely."""
    path = _target(spark, "table")
    part = _part(spark, folder)
    writers.overwrite(part.withColumn("p_size", F.lit(-1)), path)
    writers.overwrite(part, path)
    return readers.table(spark, path)


@query(
    "s7_detail_and_summary",
    "SELECT p_brand, count(*) AS items, CAST(sum(CAST(CAST(p_retailprice AS DECIMAL(18,4)) * 100 AS BIGINT)) AS BIGINT) AS cents FROM part GROUP BY 1",
)
def detail_and_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Summary written from the written detail, not from its lineage."""
    detail, summary = _target(spark, "detail"), _target(spark, "summary")
    costed = _part(spark, folder).withColumn("cents", money.cents("p_retailprice"))
    writers.write_pair(
        costed, lambda d: d.groupBy("p_brand").agg(F.count(F.lit(1)).alias("items"), F.sum("cents").alias("cents")), detail, summary
    )
    return readers.table(spark, summary)


@query(
    "s8_ingestion_by_day",
    "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
)
def ingestion_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return readers.ingestion_by_day(load(spark, folder, "events"), "ts", "event_type", ["click", "error", "purchase", "signup", "view"])


@query(
    "s8_ingestion_partition",
    "SELECT count(*) AS n FROM events WHERE strftime(ts, '%Y') = '2024' AND strftime(ts, '%m') = '01' AND strftime(ts, '%d') = '17' AND event_type <> 'error'",
)
def ingestion_partition(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of one written partition, found by partition pruning."""
    path = _target(spark, "feed")
    feed = load(spark, folder, "events").select(
        "event_id", "event_type", F.date_format("ts", "yyyy").alias("p_year"), F.date_format("ts", "MM").alias("p_month"), F.date_format("ts", "dd").alias("p_day")
    )
    writers.overwrite(feed.repartition("p_year", "p_month", "p_day"), path, ("p_year", "p_month", "p_day"))
    # The text of a partition value must stay text: 01 is not 1.
    raw = spark.read.schema(feed.schema).parquet(path)
    return readers.ingestion_count(raw, {"p_year": "2024", "p_month": "01", "p_day": "17"}, F.col("event_type") != "error")


@query(
    "s9_flatten_row",
    """SELECT concat_ws('|', coalesce(CAST(o_orderkey AS VARCHAR), '-'), coalesce(o_orderstatus, '-'), coalesce(CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END, '-'), 'a b') AS dati FROM orders""",
)
def flatten_row(spark: SparkSession, folder: str) -> DataFrame:
    df = load(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")).alias("p"), F.lit("a\r\nb").alias("note")
    )
    return df.select(text.flatten_row(df, "|").alias("dati"))


@query("s10_sheet_text", "SELECT o_orderkey, '''' || o_orderpriority AS label FROM orders")
def sheet_text(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "orders").select("o_orderkey", text.sheet_text("o_orderpriority").alias("label"))


@query("s11_csv_export", "SELECT n_name, count(*) AS suppliers FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY 1")
def csv_export(spark: SparkSession, folder: str) -> DataFrame:
    """Small report exported as one delimited file with a header."""
    path = _target(spark, "export")
    nation = load(spark, folder, "nation")
    report = (
        load(spark, folder, "supplier").join(nation, F.col("n_nationkey") == F.col("s_nationkey")).groupBy("n_name").agg(F.count(F.lit(1)).alias("suppliers"))
    )
    writers.export_csv(report, path, single_file=True)
    return readers.csv(spark, path, "n_name string, suppliers bigint")
