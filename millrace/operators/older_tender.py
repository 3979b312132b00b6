"""Reporting penalties of the older tender: milestone clocks in hours, grace by rule, rates by outcome kind, product and lot.

An item has up to five milestones. They are unpivoted, one row each, so that
one set of rules gives every clock and all counts are plain sums: a milestone
row says whether it is an outcome, of which kind (with or without the scanned
packet), how many hours it was late and whether that is a violation. Grace
periods and rates are data; the rate table is checked before it is used and
meets the summed groups only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates, presets
from millrace.functions.calendar import WorkCalendar
from millrace.functions.rules import first_match
from millrace.operators.joins import all_of

NO_PACKET, PACKET = "no_packet", "packet"
SHARE, PER_DAY = "share", "per_day"
#: Grace rules whose fits share one number.
RULES_PER_WORD = 60
#: Days of a grace rule under which a report is never late.
NEVER = -1

# Column names of the delivery data model.
TENDER_COLUMNS = {
    "carrier": "recapitista",
    "product": "prodotto",
    "lot": "lotto",
    "entrusted": "affido_recapitista_con016_data",
    "accepted": "accettazione_recapitista_con018_data",
    "attempt_state": "tentativo_recapito_stato",
    "attempt": "tentativo_recapito_data",
    "attempt_reported": "tentativo_recapito_data_rendicontazione",
    "storage_state": "messaingiacenza_recapito_stato",
    "storage": "messaingiacenza_recapito_data",
    "storage_reported": "messaingiacenza_recapito_data_rendicontazione",
    "notice": "accettazione_23l_recag012_data",
    "notice_reported": "rend_23l_data_rendicontazione",
    "certified_state": "certificazione_recapito_stato",
    "certified": "certificazione_recapito_data",
    "final": "fine_recapito_stato",
    "final_reported": "fine_recapito_data_rendicontazione",
    "receipt_scanned": "demat_23l_ar_data_rendicontazione",
    "packet_scanned": "demat_plico_data_rendicontazione",
}


@dataclass(frozen=True)
class Grace:
    """Days of grace for the milestones and items it names; what is left open holds for all.

    ``window`` is (date column, first, until, until included); ``equals`` tests
    further columns. With ``working`` the clock counts working days only.
    """

    days: int
    milestones: tuple[str, ...]
    lots: tuple[str, ...] = ()
    products: tuple[str, ...] = ()
    carriers: tuple[str, ...] = ()
    window: tuple[str, str, str, bool] | None = None
    equals: tuple[tuple[str, tuple[str, ...]], ...] = ()
    working: bool = False

    def test(self, c: Mapping[str, Column]) -> Column:
        """The rule's test of an item, whatever the milestone."""
        tests = []
        for name, values in (("lot", self.lots), ("product", self.products), ("carrier", self.carriers)):
            if values:
                tests.append(c[name].isin(list(values)))
        if self.window:
            column, first, until, closed = self.window
            at, end = c[column].cast("timestamp"), F.lit(until).cast("timestamp")
            tests.append((at >= F.lit(first).cast("timestamp")) & ((at <= end) if closed else (at < end)))
        tests += [c.get(name, F.col(name)).isin(list(values)) for name, values in self.equals]
        return all_of(tests)


ALL = ("attempt", "storage", "notice", "closing", "packet")


def _grid() -> list[Grace]:
    timed = ("attempt", "storage", "notice", "closing")
    out = [Grace(presets.TENDER_PACKET_DAYS, ("packet",))]
    out += [Grace(days, timed, tuple(lots), (product,)) for product, lots, days in presets.TENDER_GRID]
    # An attempt of these products in an unknown lot is not measured at all.
    return [*out, Grace(NEVER, ("attempt",), products=tuple(presets.TENDER_ATTEMPT_PRODUCTS))]


def national_grace() -> list[Grace]:
    """Rules of the national carrier: its start-up, dated relaxations, then the grid."""
    carriers, first, until, days = presets.TENDER_START_UP
    out = [Grace(days, ALL[:4], carriers=tuple(carriers), window=("entrusted", first, until, False))]
    out += [Grace(d, tuple(m), tuple(lots), window=("accepted", a, b, False)) for m, lots, a, b, d in presets.TENDER_RELAXED_NATIONAL]
    return out + _grid()


def other_grace() -> list[Grace]:
    """Rules of the other carriers: relaxations in working days (regional ones not for packets), then the grid."""
    out = [
        Grace(days, ALL[:4] if test else ALL, tuple(lots), window=("accepted", first, until, closed), equals=((test[0], tuple(test[1])),) if test else (), working=True)
        for lots, test, first, until, closed, days in presets.TENDER_RELAXED_OTHERS
    ]
    return out + _grid()


def working_hours(event: Column, reported: Column, calendar: WorkCalendar) -> Column:
    """Hours of the working days after the event up to the report, plus the report's hour of the day.

    Whole days are counted from the event's clock time, so the day of the report
    counts only if the event was at midnight; 0 if the report precedes the event.
    """
    midnight = F.unix_seconds(F.date_trunc("day", reported))
    whole = F.floor((midnight - F.unix_seconds(event)) / F.lit(86400)).cast("int")
    days = calendar.days_between(event, F.date_add(event.cast("date"), F.greatest(whole, F.lit(0))))
    return F.when(reported < event, F.lit(0)).otherwise(days * 24 + F.hour(reported)).cast("int")


def milestones(
    df: DataFrame,
    grace: Sequence[Grace],
    *,
    keep: Sequence[str] = (),
    calendar: WorkCalendar | None = None,
    cols: Mapping[str, str] | None = None,
    packet_states: Sequence[str] = presets.PACKET_SCAN_REQUIRED,
) -> DataFrame:
    """(keep..., carrier, product, lot, milestone, kind, outcome, hours, violation), five rows per item.

    ``hours`` is the time after the first instant that is late, by the first
    grace rule that fits; NULL in time. A milestone other than the last ones that
    no rule knows has 0 hours: it is measured, but not late.
    """
    names = {**TENDER_COLUMNS, **(cols or {})}
    c = {k: F.col(v) for k, v in names.items()}
    tried = F.coalesce(c["attempt_state"].isin(presets.TENDER_ATTEMPTS), F.lit(False))
    registered = F.coalesce(c["attempt_state"].isin(presets.TENDER_REGISTERED_ATTEMPTS), F.lit(False))
    closed = c["final"].isNotNull()
    packet = F.coalesce(c["final"].isin(list(packet_states)), F.lit(False))
    # Certified at the attempt: only the closing report counts.
    direct = F.coalesce(~packet & (c["attempt_state"] == c["certified_state"]), F.lit(False))
    scanned = dates.latest(c["receipt_scanned"], c["packet_scanned"])
    unscanned = c["final"].isin(presets.TENDER_UNSCANNED)
    rows = [
        # milestone, event, reported, measured, outcome, counts as a violation
        ("attempt", c["attempt"], c["attempt_reported"], tried, (tried | registered) & c["attempt_state"].isNotNull(), tried & ~direct),
        ("storage", c["storage"], c["storage_reported"], F.lit(True), (tried | registered) & c["storage_state"].isNotNull(), ~direct),
        ("notice", c["notice"], c["notice_reported"], F.lit(True), (tried | registered) & c["notice"].isNotNull(), ~direct & ~registered),
        ("closing", c["certified"], F.when(unscanned, c["final_reported"]).otherwise(scanned), closed & ~packet, closed & ~packet, ~packet),
        ("packet", c["certified"], scanned, packet, packet, packet),
    ]
    # A bit per rule that fits the item, found once per item. A milestone takes the lowest
    # bit among its rules; days and clock then come from short arrays.
    words = range(0, len(grace), RULES_PER_WORD)
    fits = {f"__fits{w}": reduce(lambda a, b: a + b, [F.when(g.test(c), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, g in enumerate(grace[w : w + RULES_PER_WORD])]) for w in words}

    def masks(name: str) -> list[Column]:
        return [F.lit(sum(1 << i for i, g in enumerate(grace[w : w + RULES_PER_WORD]) if name in g.milestones)).cast("bigint").alias(f"__mask{w}") for w in words]

    long = F.array(
        *[
            F.struct(
                F.lit(name).alias("milestone"), *masks(name), event.cast("timestamp").alias("event"), reported.cast("timestamp").alias("reported"),
                measured.alias("measured"), F.coalesce(outcome, F.lit(False)).alias("outcome"), counts.alias("counts"),
            )
            for name, event, reported, measured, outcome, counts in rows
        ]
    )
    used = dict.fromkeys([names[k] for k in ("carrier", "product", "lot")])
    each = df.withColumns(fits).select(*dict.fromkeys([*keep, *used, *fits]), F.inline(long))

    def first_bit(w: int) -> Column:
        met = F.col(f"__fits{w}").bitwiseAND(F.col(f"__mask{w}"))
        return F.when(met != 0, F.bit_count(met.bitwiseAND(-met) - F.lit(1)) + F.lit(w))

    rule = F.coalesce(*[first_bit(w) for w in words], F.lit(None).cast("int"))
    ruled = each.withColumn("rule", rule).withColumns(
        {"days": F.get(F.lit([g.days for g in grace]).cast("array<int>"), F.col("rule")), "working": F.get(F.lit([g.working for g in grace]).cast("array<boolean>"), F.col("rule"))}
    )
    boundary = F.date_add(F.col("event").cast("date"), F.col("days"))
    late = F.unix_seconds("reported") - F.unix_seconds(boundary.cast("timestamp"))
    hours = F.when(F.col("reported").cast("date") >= boundary, F.floor(late / F.lit(3600)).cast("int"))
    if calendar is not None:
        beyond = working_hours(F.col("event"), F.col("reported"), calendar) - F.col("days") * 24
        hours = F.when(F.col("working"), F.when(beyond > 0, beyond)).otherwise(hours)
    unknown = F.col("days").isNull() & F.col("milestone").isin("attempt", "storage", "notice")
    timed = ruled.withColumn("hours", F.when(F.col("measured"), F.when(unknown, F.lit(0)).when(F.col("days") != NEVER, hours)))
    return timed.select(
        *keep, *[c[k].alias(k) for k in ("carrier", "product", "lot")], "milestone",
        F.when(F.col("milestone") == "packet", PACKET).otherwise(NO_PACKET).alias("kind"),
        F.col("outcome").cast("int").alias("outcome"), "hours", (F.col("counts") & (F.coalesce("hours", F.lit(0)) > 0)).cast("int").alias("violation"),
    )


def rate_table(spark: SparkSession, rates: Sequence[tuple[str, str | None, Sequence[str | None], str, str]]) -> DataFrame:
    """(kind, product, lot, basis, rate_e4) from rows of (kind, product, lots, basis, rate), checked.

    Rates are kept in ten-thousandths. Two rates for one kind, product and lot,
    an unknown kind or basis, and a rate that is negative or finer than a
    ten-thousandth are errors.
    """
    known: dict[tuple, tuple] = {}
    for kind, product, lots, basis, rate in rates:
        scaled = Decimal(rate) * 10_000
        if kind not in (NO_PACKET, PACKET) or basis not in (SHARE, PER_DAY):
            raise ValueError(f"unknown kind or basis: {kind}, {basis}")
        if scaled < 0 or scaled != int(scaled):
            raise ValueError(f"rate {rate} of {kind}, {product}")
        for lot in lots:
            if (kind, product, lot) in known:
                raise ValueError(f"two rates for {kind}, {product}, {lot}")
            known[kind, product, lot] = (basis, int(scaled))
    return spark.createDataFrame([(*k, *v) for k, v in known.items()], "kind string, product string, lot string, basis string, rate_e4 bigint")


def _half_up(numerator: Column, denominator: Column) -> Column:
    """Whole-number division rounded half up, for numerators >= 0, in decimals that do not overflow."""
    n, d = numerator.cast("decimal(38,0)"), denominator.cast("decimal(38,0)")
    return F.call_function("div", n * 2 + d, d * 2).cast("bigint")


def fines(
    rows: DataFrame,
    rates: DataFrame,
    *,
    period: Sequence[str] = (),
    pooled: Sequence[str] = (),
    quota_e3: int = 21,
    mean_for: Sequence[tuple[str, Sequence[str]]] = presets.TENDER_MEAN_DELAY,
) -> DataFrame:
    """Outcomes, violations and the fine in cents per carrier, product, lot, ``period`` columns and kind.

    ``rows`` comes from :func:`milestones`. Carriers in ``pooled`` are one group
    over all products and lots. Beyond a violation share of ``quota_e3``
    thousandths a share rate charges ``(share - quota) * 1000 * rate`` and a
    per-day rate the days of delay (whole days for packets) times a thousandth
    of the rate; without a rate the fine is 0. Groups meet in one aggregate,
    combined before it is dealt; the rates meet its result.
    """
    together = F.col("carrier").isin(list(pooled)) if pooled else F.lit(False)
    keyed = rows.withColumns({k: F.when(~F.coalesce(together, F.lit(False)), F.col(k)) for k in ("product", "lot")})
    sums = keyed.groupBy("carrier", "product", "lot", *period, "kind").agg(
        F.sum("outcome").alias("outcomes"),
        F.sum("violation").alias("violations"),
        F.coalesce(F.sum("hours"), F.lit(0)).alias("delay_hours"),
        F.count("hours").alias("delays"),
    )
    r = rates.select(*[F.col(n).alias(f"__{n}") for n in rates.columns])
    on = (F.col("kind") == F.col("__kind")) & F.col("product").eqNullSafe(F.col("__product")) & F.col("lot").eqNullSafe(F.col("__lot"))
    joined = sums.join(r, on, "left")
    n, v = F.col("outcomes"), F.col("violations")
    above = v * 1000 - n * quota_e3
    days = F.when(F.col("kind") == PACKET, F.floor(F.col("delay_hours") / 24) * 24).otherwise(F.col("delay_hours"))
    rate = F.col("__rate_e4").cast("decimal(20,0)")
    fine = F.when(
        (n > 0) & (above > 0),
        first_match(
            [
                (F.col("__basis") == SHARE, _half_up(above * rate, n * 100)),
                (F.col("__basis") == PER_DAY, _half_up(days * rate, F.lit(2_400_000))),
            ],
            F.lit(0).cast("bigint"),
        ),
    ).otherwise(F.lit(0).cast("bigint"))
    meant = [(F.col("product") == p) & F.col("lot").isin(list(lots)) for p, lots in mean_for]
    if pooled:
        meant.append(together)
    mean = F.when((F.col("delays") > 0) & (F.col("delay_hours") > 0), F.round(F.col("delay_hours") / F.col("delays"), 2)).otherwise(0.0)
    return joined.select(
        "carrier", "product", "lot", *period, "kind", "outcomes", "violations", "delay_hours", "delays",
        F.round(F.coalesce(v / F.nullif(n, F.lit(0)), F.lit(0.0)), 4).alias("violation_share"),
        first_match([(F.coalesce(m, F.lit(False)), mean) for m in meant], F.lit(0.0)).alias("mean_delay_hours"),
        F.coalesce("__basis", F.lit("none")).alias("basis"), fine.alias("fine_cents"),
    )


def fine_summary(charged: DataFrame, period: Sequence[str] = ()) -> DataFrame:
    """One row per carrier, product, lot and period with both kinds side by side and the total fine."""
    def of(kind: str, column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col(column))), F.lit(0))

    out = {f"{column}_{kind}": of(kind, column) for column in ("outcomes", "violations", "fine_cents") for kind in (NO_PACKET, PACKET)}
    wide = charged.groupBy("carrier", "product", "lot", *period).agg(*[v.alias(k) for k, v in out.items()], F.max("mean_delay_hours").alias("mean_delay_hours"))
    return wide.withColumn("fine_cents", F.col("fine_cents_no_packet") + F.col("fine_cents_packet"))
