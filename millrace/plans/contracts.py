"""The fixed contract tables over every lot, product, zone and boundary date, against values written out in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import presets
from millrace.functions.calendar import WorkCalendar
from millrace.operators import penalty
from millrace.plans.registry import query
from millrace.plans.standin import load

ITEMS_SQL = """items AS (
  SELECT DISTINCT
    [ '1','2','3','4','5','6','7','8','9','10','11','12','13','14','15','16','17','18','19','20','21','22','23','24','25','26','27','28','29','30','97','98','99','30BIS' ][CAST(p_partkey % 34 AS INTEGER) + 1] AS lot,
    ['890','RS','AR','RIS','RIR'][CAST(o_orderkey % 5 AS INTEGER) + 1] AS product,
    ['AM','CP','EU','ZONE_1','ZONE_2','ZONE_3'][CAST((o_orderkey // 5) % 6 AS INTEGER) + 1] AS zone,
    ['2023-11-30','2023-12-01','2024-01-31','2024-02-01','2024-03-31','2024-04-01','2024-05-01','2024-05-31','2024-06-01','2024-07-31','2024-08-01','2024-10-01','2024-11-01','2024-11-02','2024-12-01','2025-01-01','2025-01-02','2025-06-01','2025-07-01','2025-07-02','2025-07-08','2025-07-09'][CAST(o_custkey % 22 AS INTEGER) + 1] AS day,
    ['Poste','Fulmine'][CAST(l_linenumber % 2 AS INTEGER) + 1] AS carrier,
    ['135100c9-d464-4abf-a9b1-a10f5d7903b7','other'][CAST((l_suppkey // 2) % 2 AS INTEGER) + 1] AS sender,
    ['Campania','Lazio'][CAST(l_suppkey % 2 AS INTEGER) + 1] AS region
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey)"""

LOTS = [*map(str, range(1, 31)), "97", "98", "99", "30BIS"]
DAYS = [
    "2023-11-30", "2023-12-01", "2024-01-31", "2024-02-01", "2024-03-31", "2024-04-01", "2024-05-01", "2024-05-31", "2024-06-01", "2024-07-31", "2024-08-01",
    "2024-10-01", "2024-11-01", "2024-11-02", "2024-12-01", "2025-01-01", "2025-01-02", "2025-06-01", "2025-07-01", "2025-07-02", "2025-07-08", "2025-07-09",
]

_RELAXED_SQL = """
  WHEN carrier = 'Poste' AND sender = '135100c9-d464-4abf-a9b1-a10f5d7903b7' AND day BETWEEN '2023-12-01' AND '2024-01-31' THEN 45
  WHEN lot IN ('22','27') AND (day BETWEEN '2024-06-01' AND '2024-11-01' OR day BETWEEN '2024-12-01' AND '2025-01-01') THEN 30
  WHEN lot IN ('22','27') AND region = 'Campania' AND day BETWEEN '2025-06-01' AND '2025-07-01' THEN 45
  WHEN lot IN ('22','27') AND region = 'Campania' AND day BETWEEN '2025-07-01' AND '2025-07-08' THEN 30
  WHEN lot = '30' AND (day BETWEEN '2024-04-01' AND '2024-05-01' OR day BETWEEN '2024-08-01' AND '2024-10-01') THEN 30
  WHEN lot = '30' AND day BETWEEN '2024-05-01' AND '2024-07-31' THEN 50"""


@query(
    "k5_contract_tables",
    f"""WITH {ITEMS_SQL},
    offered AS (
      SELECT *,
        CASE {_RELAXED_SQL}
          WHEN try_cast(lot AS INTEGER) BETWEEN 1 AND 20 AND product = '890' AND zone IN ('AM','CP','EU') THEN 7
          WHEN lot IN ('21','22','23','24','25','97') AND product = 'RS' AND zone IN ('AM','CP','EU') THEN 6
          WHEN lot IN ('26','27','28','29','30','98') AND product = 'AR' AND zone IN ('AM','CP','EU') THEN 6
          WHEN lot = '99' AND product = '890' AND zone = 'EU' THEN 7
          WHEN (lot, product) IN (('21','RIS'), ('26','RIR')) AND zone = 'ZONE_1' THEN 10
          WHEN (lot, product) IN (('21','RIS'), ('26','RIR')) AND zone IN ('ZONE_2','ZONE_3') THEN 20 END AS standard,
        CASE {_RELAXED_SQL}
          WHEN product = '890' AND zone = 'AM' THEN CASE
            WHEN lot IN ('10','13','14','16','19') THEN 2 WHEN lot IN ('1','2','3','4','5','6','7','8','9','12','15','17','18','20') THEN 4 WHEN lot IN ('11','99') THEN 999 END
          WHEN product = '890' AND zone = 'CP' THEN CASE
            WHEN lot IN ('13','14') THEN 2 WHEN lot IN ('1','2','3','4','5','6','7','8','9','10','12','15','16','17','18','19','20') THEN 4 WHEN lot IN ('11','99') THEN 999 END
          WHEN product = '890' AND zone = 'EU' THEN CASE
            WHEN lot IN ('1','2','5','7','9','10','13','14','15','16','17','19') THEN 4 WHEN lot IN ('3','4','6','8','11','12','18','20','99') THEN 999 END
          WHEN product = 'RS' AND zone = 'AM' THEN CASE lot WHEN '21' THEN 4 WHEN '22' THEN 3 WHEN '23' THEN 4 WHEN '24' THEN 4 WHEN '25' THEN 5 WHEN '97' THEN 999 END
          WHEN product = 'RS' AND zone IN ('CP','EU') THEN CASE lot WHEN '21' THEN 4 WHEN '22' THEN 999 WHEN '23' THEN 4 WHEN '24' THEN 4 WHEN '25' THEN 999 WHEN '97' THEN 999 END
          WHEN product = 'AR' AND zone = 'AM' THEN CASE lot WHEN '26' THEN 4 WHEN '27' THEN 3 WHEN '28' THEN 4 WHEN '29' THEN 4 WHEN '30' THEN 3 WHEN '98' THEN 999 END
          WHEN product = 'AR' AND zone IN ('CP','EU') THEN CASE lot WHEN '26' THEN 4 WHEN '27' THEN 999 WHEN '28' THEN 4 WHEN '29' THEN 4 WHEN '30' THEN 3 WHEN '98' THEN 999 END
          WHEN (lot, product) IN (('21','RIS'), ('26','RIR')) AND zone LIKE 'ZONE%' THEN 999 END AS improved,
        CASE
          WHEN lot IN ('1','3','4','6','8','12','13','14','15','17','18','19','20','27','30') THEN 5
          WHEN lot IN ('2','5','7','9','10','11','16','28','29','30BIS','98','99') THEN 7
          WHEN lot = '26' AND product = 'AR' THEN 7
          WHEN lot = '21' AND product = 'RS' THEN 10
          WHEN lot IN ('22','23','24') THEN 10
          WHEN lot IN ('25','97') THEN 15
          WHEN lot = '26' AND product = 'RIR' THEN 15
          WHEN lot = '21' AND product = 'RIS' THEN 15 END AS allowance
      FROM items)
    SELECT lot, product, zone, day, carrier, sender, region, CAST(standard AS BIGINT) AS standard, CAST(nullif(improved, 999) AS BIGINT) AS improved,
      coalesce(5 <= standard, false) AS standard_met, coalesce(5 <= improved, false) AS improved_met, CAST(allowance AS BIGINT) AS allowance,
      CAST(CASE WHEN coalesce(nullif(improved, 999), standard) IS NOT NULL THEN greatest(5 - coalesce(nullif(improved, 999), standard), 0) END AS BIGINT) AS late
    FROM offered""",
)
def contract_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Offers, verdicts of five days and reporting days for what the tables spread over lots, products, zones and dates."""

    def pick(values, key):
        return F.get(F.array(*map(F.lit, values)), (key % len(values)).cast("int"))

    joined = load(spark, folder, "lineitem").join(load(spark, folder, "orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(load(spark, folder, "part"), F.col("p_partkey") == F.col("l_partkey"))
    items = joined.select(
        pick(LOTS, F.col("p_partkey")).alias("lot"),
        pick(["890", "RS", "AR", "RIS", "RIR"], F.col("o_orderkey")).alias("product"),
        pick(["AM", "CP", "EU", "ZONE_1", "ZONE_2", "ZONE_3"], F.floor(F.col("o_orderkey") / 5)).alias("zone"),
        pick(DAYS, F.col("o_custkey")).alias("day"),
        pick(["Poste", "Fulmine"], F.col("l_linenumber")).alias("carrier"),
        pick(["135100c9-d464-4abf-a9b1-a10f5d7903b7", "other"], F.floor(F.col("l_suppkey") / 2)).alias("sender"),
        pick(["Campania", "Lazio"], F.col("l_suppkey")).alias("region"),
    ).distinct()
    where = dict(lot="lot", product="product", zone="zone", relaxed=presets.RELAXED_OFFER, region="region", conditioned=presets.CONDITIONED_OFFER)
    where["date_cols"] = dict.fromkeys(["accepted", "handed_over", "entrusted"], "at")
    unlimited = penalty.no_offer(presets.NO_IMPROVED_OFFER, lot="lot", product="product", zone="zone")
    offered = items.withColumn("at", F.to_timestamp("day")).withColumns(
        {"standard": penalty.offer_days(presets.STANDARD_OFFER, **where), "improved": penalty.offer_days(presets.IMPROVED_OFFER, **where), "spent": F.lit(5)}
    )
    return offered.select(
        *items.columns, "standard", "improved",
        penalty.within("spent", "standard").alias("standard_met"),
        penalty.within("spent", "improved", unlimited).alias("improved_met"),
        penalty.reporting_allowance("lot", "product").alias("allowance"),
        penalty.lateness("spent", "standard", "improved").alias("late"),
    )


_NATIONAL_SQL = ", ".join(
    f"(DATE '{d}')"
    for d in """2023-01-01 2023-01-06 2023-04-09 2023-04-10 2023-04-25 2023-05-01 2023-06-02 2023-08-15 2023-11-01 2023-12-08 2023-12-25 2023-12-26
    2024-01-01 2024-01-06 2024-03-31 2024-04-01 2024-04-25 2024-05-01 2024-06-02 2024-08-15 2024-11-01 2024-12-08 2024-12-25 2024-12-26
    2025-01-01 2025-01-06 2025-04-20 2025-04-21 2025-04-25 2025-05-01 2025-06-02 2025-08-15 2025-11-01 2025-12-08 2025-12-25 2025-12-26
    2026-01-01 2026-01-06 2026-04-05 2026-04-06 2026-04-25 2026-05-01 2026-06-02 2026-08-15 2026-10-04 2026-11-01 2026-12-08 2026-12-25 2026-12-26
    2027-01-01 2027-01-06 2027-03-28 2027-03-29 2027-04-25 2027-05-01 2027-06-02 2027-08-15 2027-10-04 2027-11-01 2027-12-08 2027-12-25 2027-12-26""".split()
)


@query(
    "k3_national_calendar",
    f"""WITH hol(h) AS (VALUES {_NATIONAL_SQL}),
    days AS (SELECT CAST(d AS DATE) AS d, CAST(sum(CASE WHEN isodow(d) < 6 AND CAST(d AS DATE) NOT IN (SELECT h FROM hol) THEN 1 ELSE 0 END) OVER (ORDER BY d) AS BIGINT) AS idx
      FROM generate_series(TIMESTAMP '2022-12-25', TIMESTAMP '2028-02-28', INTERVAL 1 DAY) g(d)),
    s AS (SELECT CAST(o_orderdate AS DATE) + CAST(31 * 365 AS INTEGER) AS day, count(*) AS items FROM orders GROUP BY 1)
    SELECT strftime(day, '%Y-%m-%d') AS day, items, b.idx - a.idx AS next_30, a.idx > (SELECT idx FROM days z WHERE z.d = day - 1) AS works
    FROM s JOIN days a ON a.d = day JOIN days b ON b.d = day + 30 WHERE day BETWEEN DATE '2023-01-01' AND DATE '2027-12-31'""",
)
def national_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Working days after each order day, moved on to the years of the holiday list."""
    calendar = WorkCalendar.national(2023, 2027)
    moved = load(spark, folder, "orders").select(F.date_add(F.col("o_orderdate").cast("date"), 31 * 365).alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("items"))
    inside = moved.filter(F.col("day").between(F.lit("2023-01-01").cast("date"), F.lit("2027-12-31").cast("date")))
    return inside.select("day", "items", calendar.days_between("day", F.date_add("day", 30)).alias("next_30"), calendar.is_workday("day").alias("works"))
