"""Reporting fines of the older tender over every mail piece, against grace periods and rates written out in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import presets
from millrace.functions.calendar import WorkCalendar
from millrace.operators import older_tender as tender
from millrace.plans.contracts import _NATIONAL_SQL
from millrace.plans.registry import query
from millrace.plans.standin import load

CARRIERS = ["Poste", "FSU - AR", "Fulmine", "RTI Sailpost-Snem"]
#: Lots with their product, and some that no rule knows.
PAIRS = [
    *[f"890|{n}" for n in range(1, 21)], "890|99", "RS|21", "RS|22", "RS|23", "RS|24", "RS|25", "RS|97", "AR|26", "AR|27", "AR|28", "AR|29", "AR|30", "AR|30BIS", "AR|98",
    "RIR|26", "RIS|21", "890|27", "RIR|30", "RS|27", "AR|27", "RS|22", "RIS|26",
]
ATTEMPTS = ["RECRN010", "RECRS010", "RECAG010", "RECRSI001", "RECRI001", "RECRN001A", None]
FINALS = ["RECRS001C", "RECAG001C", "RECAG003C", "RECRN002C", None, "RECRS003C", "RECAG008C", "RECRN003C"]
REGIONS, PROVINCES = ["Campania", "Lazio", "Sicilia"], ["Napoli", "Siracusa"]
#: Whole days from the years of the orders to those of the tender.
SHIFT = 31 * 365 + 8


def _sql_list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


ITEMS_SQL = f"""keyed AS (SELECT *, l_orderkey * 7 + l_linenumber AS k, CAST(l_quantity AS INTEGER) AS q FROM lineitem),
dated AS (SELECT *, {_sql_list(CARRIERS)}[CAST(l_suppkey % 4 AS INTEGER) + 1] AS carrier, {_sql_list(PAIRS)}[CAST(l_partkey % {len(PAIRS)} AS INTEGER) + 1] AS pair,
  {_sql_list(ATTEMPTS)}[CAST(k % 7 AS INTEGER) + 1] AS attempt_state, {_sql_list(FINALS)}[CAST((l_orderkey // 3) % 8 AS INTEGER) + 1] AS final,
  {_sql_list(REGIONS)}[CAST(l_orderkey % 3 AS INTEGER) + 1] AS region, {_sql_list(PROVINCES)}[CAST(l_orderkey % 2 AS INTEGER) + 1] AS province,
  l_shipdate + {SHIFT} * INTERVAL 1 DAY AS entrusted, l_shipdate + CAST({SHIFT} + k % 3 AS INTEGER) * INTERVAL 1 DAY AS accepted FROM keyed),
tried AS (SELECT *, accepted + (q % 9) * INTERVAL 1 DAY + CAST(k % 24 AS INTEGER) * INTERVAL 1 HOUR AS attempt FROM dated),
items AS (SELECT carrier, split_part(pair, '|', 1) AS product, split_part(pair, '|', 2) AS lot, region, province, entrusted, accepted, attempt_state, final,
  CASE WHEN k % 3 = 0 THEN attempt_state ELSE 'RECRN001A' END AS certified_state, CASE WHEN k % 5 < 2 THEN 'RECAG011A' END AS storage_state,
  attempt, attempt + CAST(round(l_tax * 300) AS INTEGER) * INTERVAL 1 DAY + q * INTERVAL 1 HOUR AS attempt_reported,
  attempt + INTERVAL 2 DAY AS storage, attempt + CAST(2 + round(l_discount * 200) AS INTEGER) * INTERVAL 1 DAY + INTERVAL 5 HOUR AS storage_reported,
  CASE WHEN k % 4 > 0 THEN attempt + INTERVAL 3 DAY END AS notice, CASE WHEN k % 4 > 0 THEN attempt + CAST(3 + k % 26 AS INTEGER) * INTERVAL 1 DAY + INTERVAL 3 HOUR END AS notice_reported,
  attempt + INTERVAL 1 DAY AS certified, attempt + CAST(1 + l_partkey % 40 AS INTEGER) * INTERVAL 1 DAY + INTERVAL 7 HOUR AS final_reported,
  CASE WHEN l_partkey % 2 = 0 THEN attempt + CAST(2 + l_partkey % 40 AS INTEGER) * INTERVAL 1 DAY + INTERVAL 7 HOUR END AS receipt_scanned,
  CASE WHEN l_suppkey % 3 > 0 THEN attempt + CAST(1 + l_partkey % 45 AS INTEGER) * INTERVAL 1 DAY + INTERVAL 2 HOUR END AS packet_scanned FROM tried)"""


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item as an item of the older tender, moved to its years."""

    def pick(values, key):
        return F.get(F.array(*map(F.lit, values)), (key % len(values)).cast("int"))

    def later(col, days, hours=0):
        return col + F.make_dt_interval(days=(days if not isinstance(days, int) else F.lit(days)).cast("int"), hours=hours if not isinstance(hours, int) else F.lit(hours))

    k, q, order, part = F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.col("l_quantity").cast("int"), F.col("l_orderkey"), F.col("l_partkey")
    based = load(spark, folder, "lineitem").select(
        "l_tax", "l_discount", "l_suppkey", part, order, k.alias("k"), q.alias("q"),
        later(F.col("l_shipdate"), SHIFT).alias("entrusted"), later(F.col("l_shipdate"), F.lit(SHIFT) + k % 3).alias("accepted"),
    )
    k, q, at = F.col("k"), F.col("q"), F.col("attempt")
    tried = based.withColumn("attempt", later(F.col("accepted"), q % 9, (k % 24).cast("int")))
    pair = F.split(pick(PAIRS, part), r"\|")
    noticed = k % 4 > 0
    return tried.select(
        pick(CARRIERS, F.col("l_suppkey")).alias("carrier"), pair[0].alias("product"), pair[1].alias("lot"), pick(REGIONS, order).alias("region"), pick(PROVINCES, order).alias("province"),
        "entrusted", "accepted", pick(ATTEMPTS, k).alias("attempt_state"), pick(FINALS, F.floor(order / 3)).alias("final"),
        F.when(k % 3 == 0, pick(ATTEMPTS, k)).otherwise("RECRN001A").alias("certified_state"), F.when(k % 5 < 2, "RECAG011A").alias("storage_state"),
        "attempt", later(at, F.round(F.col("l_tax") * 300), q).alias("attempt_reported"),
        later(at, 2).alias("storage"), later(at, F.round(F.col("l_discount") * 200) + 2, 5).alias("storage_reported"),
        F.when(noticed, later(at, 3)).alias("notice"), F.when(noticed, later(at, k % 26 + 3, 3)).alias("notice_reported"),
        later(at, 1).alias("certified"), later(at, part % 40 + 1, 7).alias("final_reported"),
        F.when(part % 2 == 0, later(at, part % 40 + 2, 7)).alias("receipt_scanned"), F.when(F.col("l_suppkey") % 3 > 0, later(at, part % 45 + 1, 2)).alias("packet_scanned"),
    )


COLUMNS = {k: k for k in tender.TENDER_COLUMNS}
PERIOD = ["year", "quarter"]

# Days to the first late day by product and lot, written out; 0 where no rule fits.
_GRID_SQL = """CASE
    WHEN product = '890' AND lot IN ('1','3','4','6','8','12','13','14','15','17','18','19','20') THEN 6
    WHEN product = '890' AND lot IN ('2','5','7','9','10','11','16','99') THEN 8
    WHEN product = 'RS' AND lot IN ('21','22','23','24') THEN 11
    WHEN product = 'RS' AND lot IN ('25','97') THEN 16
    WHEN product = 'AR' AND lot IN ('26','28','29','30BIS','98') THEN 8
    WHEN product = 'AR' AND lot IN ('27','30') THEN 6
    WHEN product = 'RIR' AND lot = '26' THEN 16
    WHEN product = 'RIS' AND lot = '21' THEN 16 ELSE 0 END"""
_START_UP_SQL = "carrier IN ('Poste','FSU','FSU - AR','FSU - RS','FSU - 890') AND entrusted >= TIMESTAMP '2023-07-15' AND entrusted < TIMESTAMP '2024-05-01'"


def _accepted_sql(first: str, until: str) -> str:
    return f"(accepted >= TIMESTAMP '{first}' AND accepted < TIMESTAMP '{until}')"


_SUMMER, _SEPTEMBER, _HALF_YEAR = _accepted_sql("2024-06-01", "2024-08-01"), _accepted_sql("2024-09-01", "2024-10-01"), _accepted_sql("2024-06-01", "2024-11-01")
_DAYS_SQL = f"""ruled AS (SELECT *, {_GRID_SQL} AS grid,
    coalesce(attempt_state IN ('RECRN010','RECRS010','RECAG010'), false) AS tried, coalesce(attempt_state IN ('RECRSI001','RECRI001'), false) AS registered,
    coalesce(final IN ('RECAG003C','RECAG003F','RECAG007C','RECAG008C','RECRN002C','RECRN002F','RECRN004C','RECRN005C','RECRS002C','RECRS002F','RECRS004C','RECRS005C','RECRSI004C','RECRI004C'), false) AS packed,
    greatest(receipt_scanned, packet_scanned) AS scanned FROM items),
  days AS (SELECT *, coalesce(NOT packed AND attempt_state = certified_state, false) AS direct,
    CASE WHEN {_START_UP_SQL} THEN 16 WHEN lot = '27' AND ({_SUMMER} OR {_SEPTEMBER}) THEN 31 WHEN grid = 0 AND product IN ('890','RS','AR') THEN -1 ELSE grid END AS attempt_days,
    CASE WHEN {_START_UP_SQL} THEN 16 WHEN (lot = '27' AND {_SUMMER}) OR {_SEPTEMBER} THEN 31 ELSE grid END AS storage_days,
    CASE WHEN {_START_UP_SQL} THEN 16 WHEN (lot IN ('27','22') AND {_SUMMER}) OR {_SEPTEMBER} THEN 31 ELSE grid END AS notice_days,
    CASE WHEN {_START_UP_SQL} THEN 16 WHEN lot IN ('27','22') AND {_HALF_YEAR} THEN 31 WHEN grid = 0 THEN -1 ELSE grid END AS closing_days,
    CASE WHEN lot IN ('27','22') AND {_HALF_YEAR} THEN 31 ELSE 22 END AS packet_days FROM ruled)"""


def _hours_sql(event: str, reported: str, days: str) -> str:
    boundary = f"(CAST({event} AS DATE) + {days})"
    return f"CASE WHEN {days} = 0 THEN 0 WHEN {days} > 0 AND CAST({reported} AS DATE) >= {boundary} THEN CAST(floor((epoch({reported}) - epoch(CAST({boundary} AS TIMESTAMP))) / 3600) AS BIGINT) END"


_CLOCKS_SQL = f"""timed AS (SELECT *,
    CASE WHEN tried THEN {_hours_sql("attempt", "attempt_reported", "attempt_days")} END AS h_attempt,
    {_hours_sql("storage", "storage_reported", "storage_days")} AS h_storage, {_hours_sql("notice", "notice_reported", "notice_days")} AS h_notice,
    CASE WHEN final IS NOT NULL AND NOT packed THEN CASE WHEN final IN ('RECRS001C','RECRS003C','RECRSI003C') THEN {_hours_sql("certified", "final_reported", "closing_days")}
      ELSE {_hours_sql("certified", "scanned", "closing_days")} END END AS h_closing,
    CASE WHEN packed THEN {_hours_sql("certified", "scanned", "packet_days")} END AS h_packet FROM days)"""

_KINDS_SQL = """counted AS (SELECT carrier, CASE WHEN carrier <> 'RTI Sailpost-Snem' THEN product END AS product, CASE WHEN carrier <> 'RTI Sailpost-Snem' THEN lot END AS lot,
    year(accepted) AS year, quarter(accepted) AS quarter, packed,
    CASE WHEN tried OR registered THEN 1 + (storage_state IS NOT NULL)::INT + (notice IS NOT NULL)::INT ELSE 0 END + (final IS NOT NULL AND NOT packed)::INT AS n_open,
    CASE WHEN direct THEN 0 ELSE (tried AND coalesce(h_attempt, 0) > 0)::INT + (coalesce(h_storage, 0) > 0)::INT + (NOT registered AND coalesce(h_notice, 0) > 0)::INT END AS v_open,
    h_attempt, h_storage, h_notice, h_closing, h_packet FROM timed),
  kinds AS (
    SELECT carrier, product, lot, year, quarter, 'no_packet' AS kind, sum(n_open) AS outcomes,
      sum(v_open + (coalesce(h_closing, 0) > 0)::INT) AS violations,
      sum(coalesce(h_attempt, 0) + coalesce(h_storage, 0) + coalesce(h_notice, 0) + coalesce(h_closing, 0)) AS delay_hours,
      count(h_attempt) + count(h_storage) + count(h_notice) + count(h_closing) AS delays FROM counted GROUP BY ALL
    UNION ALL
    SELECT carrier, product, lot, year, quarter, 'packet', sum(packed::INT), sum(coalesce((h_packet > 0)::INT, 0)), sum(coalesce(h_packet, 0)), count(h_packet) FROM counted GROUP BY ALL)"""
# Rates written out, as whole ten-thousandths; the fine in whole cents, rounded half up.
_FINES_SQL = """rated AS (SELECT *, violations * 1000 - outcomes * 21 AS above, CASE
      WHEN product IS NULL THEN CASE kind WHEN 'packet' THEN 3000000 ELSE 5000000 END
      WHEN product = '890' AND try_cast(lot AS INTEGER) BETWEEN 1 AND 20 THEN CASE kind WHEN 'packet' THEN 3000000 ELSE 5000000 END
      WHEN product = 'RS' AND lot IN ('21','22','23','24','25') THEN 3000000
      WHEN product = 'AR' AND lot IN ('26','27','28','29','30','30BIS') THEN CASE kind WHEN 'packet' THEN 3000000 ELSE 5000000 END
      WHEN product IN ('RIR','RIS') AND lot IN ('21','26') THEN 3000000 END AS by_share,
    CASE WHEN product = 'RS' AND lot = '97' THEN 678 WHEN product = 'AR' AND lot = '98' THEN 225 WHEN product = '890' AND lot = '99' THEN 1900 END AS by_day FROM kinds),
  fined AS (SELECT carrier, product, lot, year, quarter, kind, CAST(outcomes AS BIGINT) AS outcomes, CAST(violations AS BIGINT) AS violations, CAST(delay_hours AS BIGINT) AS delay_hours, delays,
    round(coalesce(violations / nullif(outcomes, 0), 0.0), 4) AS violation_share,
    CASE WHEN (product IS NULL OR (product = '890' AND try_cast(lot AS INTEGER) BETWEEN 1 AND 20) OR (product = 'AR' AND lot IN ('26','27','28','29','30','30BIS')))
      AND delays > 0 AND delay_hours > 0 THEN round(delay_hours / delays, 2) ELSE 0.0 END AS mean_delay_hours,
    CASE WHEN by_share IS NOT NULL THEN 'share' WHEN by_day IS NOT NULL THEN 'per_day' ELSE 'none' END AS basis,
    CAST(CASE WHEN outcomes = 0 THEN 0 WHEN above > 0 AND by_share IS NOT NULL THEN (2 * above * by_share + outcomes * 100) // nullif(outcomes * 200, 0)
      WHEN above > 0 AND by_day IS NOT NULL THEN (2 * (CASE kind WHEN 'packet' THEN delay_hours // 24 * 24 ELSE delay_hours END) * by_day + 2400000) // 4800000 ELSE 0 END AS BIGINT) AS fine_cents FROM rated)"""

_SQL = f"WITH {ITEMS_SQL}, {_DAYS_SQL}, {_CLOCKS_SQL}, {_KINDS_SQL}, {_FINES_SQL}"


def national(spark: SparkSession, folder: str) -> DataFrame:
    rows = items(spark, folder).withColumns({"year": F.year("accepted"), "quarter": F.quarter("accepted")})
    timed = tender.milestones(rows, tender.national_grace(), keep=PERIOD, cols=COLUMNS)
    rates = tender.rate_table(spark, [*presets.TENDER_RATES, *presets.TENDER_POOLED_RATES])
    return tender.fines(timed, rates, period=PERIOD, pooled=presets.TENDER_POOLED)


@query("k11_tender_no_packet", f"{_SQL} SELECT * FROM fined WHERE kind = 'no_packet' AND basis <> 'per_day'")
def tender_no_packet(spark: SparkSession, folder: str) -> DataFrame:
    """Fines for outcomes without a packet, by carrier, product, lot and quarter, in cents."""
    return national(spark, folder).where("kind = 'no_packet' and basis <> 'per_day'")


@query("k11_tender_packet", f"{_SQL} SELECT * FROM fined WHERE kind = 'packet' AND basis <> 'per_day'")
def tender_packet(spark: SparkSession, folder: str) -> DataFrame:
    """Fines for outcomes closed by the scanned packet, in cents."""
    return national(spark, folder).where("kind = 'packet' and basis <> 'per_day'")


@query("k11_tender_per_day", f"{_SQL} SELECT * FROM fined WHERE basis = 'per_day'")
def tender_per_day(spark: SparkSession, folder: str) -> DataFrame:
    """Lots 97 to 99, charged by the day of delay, in cents."""
    return national(spark, folder).where("basis = 'per_day'")


@query(
    "k11_tender_summary",
    f"""{_SQL} SELECT carrier, product, lot, year, quarter,
      CAST(sum(outcomes) FILTER (kind = 'no_packet') AS BIGINT) AS outcomes_no_packet, CAST(sum(outcomes) FILTER (kind = 'packet') AS BIGINT) AS outcomes_packet,
      CAST(sum(violations) FILTER (kind = 'no_packet') AS BIGINT) AS violations_no_packet, CAST(sum(violations) FILTER (kind = 'packet') AS BIGINT) AS violations_packet,
      CAST(sum(fine_cents) FILTER (kind = 'no_packet') AS BIGINT) AS fine_cents_no_packet, CAST(sum(fine_cents) FILTER (kind = 'packet') AS BIGINT) AS fine_cents_packet,
      max(mean_delay_hours) AS mean_delay_hours, CAST(sum(fine_cents) AS BIGINT) AS fine_cents FROM fined GROUP BY ALL""",
)
def tender_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Both kinds side by side with the total fine."""
    return tender.fine_summary(national(spark, folder), PERIOD)


def _working_sql(event: str, reported: str, days: str) -> str:
    whole = f"greatest(CAST(floor((epoch(date_trunc('day', {reported})) - epoch({event})) / 86400) AS INTEGER), 0)"
    count = f"(SELECT idx FROM days2 WHERE d = CAST({event} AS DATE) + {whole}) - (SELECT idx FROM days2 WHERE d = CAST({event} AS DATE))"
    return f"CASE WHEN {reported} >= {event} AND ({count}) * 24 + hour({reported}) > {days} * 24 THEN ({count}) * 24 + hour({reported}) - {days} * 24 END"


_RELAXED_SQL = """CASE WHEN lot IN ('27','22') AND ((accepted >= TIMESTAMP '2024-06-01' AND accepted < TIMESTAMP '2024-11-01') OR (accepted >= TIMESTAMP '2024-12-01' AND accepted <= TIMESTAMP '2025-01-01')) THEN 30
    WHEN lot IN ('27','22') AND region = 'Campania' AND accepted >= TIMESTAMP '2025-06-01' AND accepted < TIMESTAMP '2025-08-08' THEN 10
    WHEN lot IN ('27','22') AND province = 'Siracusa' AND accepted >= TIMESTAMP '2025-06-30' AND accepted < TIMESTAMP '2025-07-21' THEN 10 END"""


@query(
    "k11_tender_working_hours",
    f"""WITH {ITEMS_SQL}, hol(h) AS (VALUES {_NATIONAL_SQL}),
    days2 AS MATERIALIZED (SELECT CAST(d AS DATE) AS d, CAST(sum(CASE WHEN isodow(d) < 6 AND CAST(d AS DATE) NOT IN (SELECT h FROM hol) THEN 1 ELSE 0 END) OVER (ORDER BY d) AS BIGINT) AS idx
      FROM generate_series(TIMESTAMP '2022-12-01', TIMESTAMP '2031-12-31', INTERVAL 1 DAY) g(d)),
    relaxed AS (SELECT *, {_GRID_SQL} AS grid, {_RELAXED_SQL} AS working FROM items WHERE attempt_state IN ('RECRN010','RECRS010','RECAG010')),
    h AS (SELECT product, lot, CASE WHEN working IS NOT NULL THEN {_working_sql("attempt", "attempt_reported", "working")}
      WHEN grid > 0 THEN {_hours_sql("attempt", "attempt_reported", "grid")} WHEN product IN ('890','RS','AR') THEN NULL ELSE 0 END AS hours FROM relaxed)
    SELECT product, lot, count(*) AS items, count(hours) AS delays, CAST(coalesce(sum(hours), 0) AS BIGINT) AS delay_hours, CAST(max(hours) AS BIGINT) AS longest FROM h GROUP BY ALL""",
)
def tender_working_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Attempts timed by the other carriers' rules, whose relaxations count working days."""
    cols = {**COLUMNS, "regione": "region", "provincia": "province"}
    timed = tender.milestones(items(spark, folder), tender.other_grace(), keep=["attempt_state"], calendar=WorkCalendar.national(2023, 2027), cols=cols)
    attempts = timed.where("milestone = 'attempt'").where(F.col("attempt_state").isin(presets.TENDER_ATTEMPTS))
    return attempts.groupBy("product", "lot").agg(
        F.count(F.lit(1)).alias("items"), F.count("hours").alias("delays"), F.coalesce(F.sum("hours"), F.lit(0)).alias("delay_hours"), F.max("hours").alias("longest")
    )
