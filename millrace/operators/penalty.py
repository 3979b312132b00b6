"""Service levels, lateness and penalties.

Amounts are whole cents. A fee is rounded half up once per item, and its
weighted share is rounded once more, as the contracts prescribe.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import dates, money, presets
from millrace.functions.calendar import WorkCalendar
from millrace.functions.rules import first_match
from millrace.operators.aggregates import Measure, level_sets
from millrace.operators.ordered import quota_flags, ranked_share


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# -- days and verdicts --------------------------------------------------------


def delivery_start(accepted: str, handed_over: str, discard_state: str | None = None, keep: str = "CON995") -> Column:
    """Start of the delivery time.

    The earlier of acceptance and the day after hand-over, whichever exists;
    acceptance when the supplier discarded the item with the ``keep`` code.
    """
    soonest = dates.earliest(accepted, dates.plus_days(handed_over, 1))
    if discard_state is None:
        return soonest
    both = F.col(accepted).isNotNull() & F.col(handed_over).isNotNull()
    return F.when(both & (F.col(discard_state) == keep), F.col(accepted)).otherwise(soonest)


def with_delivery_days(
    df: DataFrame,
    calendar: WorkCalendar,
    *,
    accepted: str,
    handed_over: str,
    attempt: str,
    discard_state: str | None = None,
    start: str = "start",
    days: str = "days",
) -> DataFrame:
    """Add the start and the working days of the delivery."""
    started = df.withColumn(start, delivery_start(accepted, handed_over, discard_state))
    return started.withColumn(days, calendar.days_between(start, attempt))


def within(days: Column | str, allowed: Column | str, unlimited: Column | None = None) -> Column:
    """Service level met; NULL without a measure, false without a limit.

    ``unlimited`` marks items whose offer sets no limit: any measure meets it.
    """
    d, limit = _c(days), _c(allowed)
    met = F.coalesce(d <= limit, F.lit(False))
    if unlimited is not None:
        met = met | (limit.isNull() & F.coalesce(unlimited, F.lit(False)))
    return F.when(d.isNotNull(), met)


def no_offer(table: Sequence[tuple[Sequence[str], str, Sequence[str]]], *, lot: str, product: str, zone: str) -> Column:
    """Whether lot, product and zone are listed as without an offer."""
    tests = [F.col(lot).isin(list(lots)) & (F.col(product) == only) & F.col(zone).isin(list(zones)) for lots, only, zones in table]
    return F.coalesce(reduce(lambda a, b: a | b, tests, F.lit(False)), F.lit(False))


def lateness(days: Column | str, standard: Column | str, improved: Column | str | None = None) -> Column:
    """Days beyond the offer in force (improved if there is one), never negative."""
    offer = _c(standard) if improved is None else F.coalesce(_c(improved), _c(standard))
    late = _c(days) - offer
    return F.when(late.isNotNull(), F.greatest(late, F.lit(0)))


def offer_days(
    offers: Sequence[tuple[Sequence[str], str, Sequence[str], int]],
    *,
    lot: str,
    product: str,
    zone: str,
    relaxed: Sequence[tuple] = (),
    region: str | None = None,
    date_cols: Mapping[str, str] | None = None,
    conditioned: Sequence[tuple[Mapping[str, Sequence[str]], str, str, str, int]] = (),
    columns: Mapping[str, str] | None = None,
) -> Column:
    """Offered days by lot, product and zone, with dated relaxations first.

    ``conditioned`` relaxations come before all others and may test any column;
    ``columns`` and ``date_cols`` give the names of the columns they mean.
    """
    rules = []
    for tests, date_col, first, last, days in conditioned:
        when = F.col((date_cols or {}).get(date_col, date_col))
        test = when.between(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp"))
        for name, values in tests.items():
            test = test & F.col((columns or {}).get(name, name)).isin(list(values))
        rules.append((test, days))
    for lots, only_region, date_col, first, last, days in relaxed:
        test = F.col(lot).isin(list(lots))
        if only_region is not None:
            test = test & (F.col(region) == only_region)
        when = F.col((date_cols or {}).get(date_col, date_col))
        test = test & when.between(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp"))
        rules.append((test, days))
    for lots, only_product, zones, days in offers:
        test = F.col(lot).isin(list(lots)) & (F.col(product) == only_product) & F.col(zone).isin(list(zones))
        rules.append((test, days))
    return first_match(rules)


def reporting_allowance(lot: str, product: str, table=presets.REPORTING_DAYS) -> Column:
    """Days allowed for reporting an outcome, by lot and product."""
    rules = []
    for lots, only_product, days in table:
        test = F.col(lot).isin(list(lots))
        rules.append((test if only_product is None else test & (F.col(product) == only_product), days))
    return first_match(rules)


# -- delivery penalty ---------------------------------------------------------


def delivery_penalty(
    df: DataFrame,
    *,
    group: Sequence[str],
    tie: Sequence[str],
    late: str,
    in_standard: str,
    in_improved: str,
    cost: str,
    span: int = 20,
    cap_at: int | None = None,
    cap_times: int = 1,
    quota_standard: float = 0.9,
    quota_other: float = 0.98,
    weight_divisor: int = 2,
    counted: Column | None = None,
    ranks: bool = True,
    **ranking,
) -> DataFrame:
    """Rank items by lateness within ``group`` and charge those inside the quota.

    The least late items come first; an item pays while its share of the group
    (rank / group size) is below the quota. Items without a measured lateness
    are counted in the size but not ranked. ``group`` may be one pool per
    carrier or one per lot, as the contract says. Without ``ranks`` the columns
    rank, total and share are left out and the quotas are found by counting.
    """
    if ranks:
        order = [F.col(late).asc(), *[F.col(t).asc_nulls_first() for t in tie]]
        ranked = ranked_share(df, group, order, measured=F.col(late).isNotNull(), counted=counted, **ranking)
        below_standard, below_other = F.col("share") < quota_standard, F.col("share") < quota_other
    else:
        # An item that is not late pays nothing, whatever its share.
        ranked = quota_flags(df, group, late, tie, {"__standard": quota_standard, "__other": quota_other}, counted=counted, idle=0, **ranking)
        below_standard, below_other = F.col("__standard"), F.col("__other")
    fee = F.coalesce(money.proportional_fee(F.col(cost), F.col(late), span, cap_at, cap_times), F.lit(0))
    charged = first_match(
        [
            (F.col(in_standard) & ~F.col(in_improved) & below_standard, fee),
            (~F.col(in_standard) & below_other, fee),
        ],
        F.lit(0).cast("bigint"),
    )
    return ranked.withColumn("fee_cents", charged).drop("__standard", "__other").withColumn(
        "weighted_cents", money.half_up_div(F.col("fee_cents"), weight_divisor)
    )


def reporting_penalty(
    df: DataFrame,
    *,
    group: Sequence[str],
    tie: Sequence[str],
    late: str,
    cost: str,
    span: int = 60,
    quota: float = 0.979,
    weight_divisor: int = 2,
    counted: Column | None = None,
    ranks: bool = True,
    **ranking,
) -> DataFrame:
    """Same ranking on reporting lateness; only late items inside the quota pay.

    Without ``ranks`` the rank columns are left out and the quota is found by counting.
    """
    if ranks:
        order = [F.col(late).asc(), *[F.col(t).asc_nulls_first() for t in tie]]
        ranked = ranked_share(
            df,
            group,
            order,
            measured=F.col(late).isNotNull(),
            counted=counted,
            rank="report_rank",
            total="report_total",
            share="report_share",
            **ranking,
        )
        below = F.col("report_share") < quota
    else:
        ranked = quota_flags(df, group, late, tie, {"__below": quota}, counted=counted, idle=0, **ranking)
        below = F.col("__below")
    fee = money.proportional_fee(F.col(cost), F.col(late), span)
    charged = F.when((F.col(late) > 0) & below, fee).otherwise(F.lit(0).cast("bigint"))
    return ranked.withColumn("report_fee_cents", charged).drop("__below").withColumn(
        "report_weighted_cents", money.half_up_div(F.col("report_fee_cents"), weight_divisor)
    )


def penalty_summary(df: DataFrame, keys: Sequence[str], *, period: str, weighted: Mapping[str, str]) -> DataFrame:
    """Items, charged items and amounts per key, quarter and year.

    ``weighted`` maps an output prefix to a weighted amount column. ``period``
    is the date that decides the quarter (acceptance or final report).
    """
    d = F.col(period)
    aggs = [F.count(F.lit(1)).alias("items")]
    for name, col in weighted.items():
        aggs.append(F.count_if(F.col(col) > 0).alias(f"{name}_charged"))
        aggs.append(F.sum(col).alias(f"{name}_cents"))
    out = df.groupBy(*keys, F.quarter(d).alias("quarter"), F.year(d).alias("year")).agg(*aggs)
    total = None
    for name in weighted:
        total = F.col(f"{name}_cents") if total is None else total + F.col(f"{name}_cents")
    return out.withColumn("total_cents", total)


# -- reporting delay ----------------------------------------------------------

# Default column names of the reporting rules.
REPORTING_COLUMNS = {
    "final": "fine_recapito_stato",
    "final_day": "fine_recapito_data",
    "final_reported": "fine_recapito_data_rendicontazione",
    "attempt": "tentativo_recapito_data",
    "certified": "certificazione_recapito_data",
    "notice_reported": "accettazione_23l_recag012_data_rendicontazione",
    "allowance": "sla_finale",
    "in_workdays": "flag_giorni_lav",
}


def packet_kind(final: str = "fine_recapito_stato") -> Column:
    """``plico`` for outcomes closed by the scanned packet, else ``no_plico``."""
    return F.when(F.col(final).isin(presets.PACKET_CLOSED), "plico").otherwise("no_plico")


# Use case name of each reporting case.
USE_CASES = {
    1: "consegna_mancata_consegna_irreperibilita",
    2: "giacenza_890_chiusura_post_rend_RECAG012",
    3: "giacenza_890_chiusura_pre_rend_RECAG012",
    4: "giacenza_890_chiusura_senza_RECAG012",
    5: "giacenza_AR_RS",
    6: "giacenza_AR_RS",
    7: "giacenza_890_chiusura_post_rend_RECAG012",
    8: "compiuta_giacenza_890_pre_rend_RECAG012",
    9: "anomalia_compiuta_giacenza_890_senza_RECAG012",
}


def with_reporting_delay(
    df: DataFrame, calendar: WorkCalendar, cols: Mapping[str, str] | None = None, spent: str = "spent"
) -> DataFrame:
    """Add the days between attempt and report, in one of three spans.

    Stored items certified after the storage notice was reported: attempt to
    notice plus certification to report. Completed storage certified before
    the notice: attempt to the later of report and notice. All others: attempt
    to report. Working days count only where a relaxation says so and the
    outcome needs no packet.
    """
    names = {**REPORTING_COLUMNS, **(cols or {})}
    c = {k: F.col(v) for k, v in names.items()}
    # Working-day indexes and tests once per row; all spans are differences.
    dated = ("attempt", "notice_reported", "certified", "final_reported")
    prepared = df.withColumns(
        {
            **{f"__w_{d}": calendar.index(names[d]) for d in dated},
            "__packet": packet_kind(names["final"]) == "plico",
            "__split": c["final"].isin(presets.STORAGE_890_CLOSED) & (c["certified"] > c["notice_reported"]),
            "__to_later": (c["final"] == "RECAG008C") & (c["certified"] <= c["notice_reported"]),
        }
    )
    w = {d: F.col(f"__w_{d}") for d in dated}
    split, to_later = F.col("__split"), F.col("__to_later")
    until = F.when(to_later, F.greatest(c["final_reported"], c["notice_reported"])).otherwise(c["final_reported"])
    w_until = F.when(to_later, F.greatest(w["final_reported"], w["notice_reported"])).otherwise(w["final_reported"])
    calendar_days = F.when(
        split, F.datediff(c["notice_reported"], c["attempt"]) + F.datediff(c["final_reported"], c["certified"])
    ).otherwise(F.datediff(until, c["attempt"]))
    working_days = F.when(
        split, calendar.span(w["attempt"], w["notice_reported"]) + calendar.span(w["certified"], w["final_reported"])
    ).otherwise(calendar.span(w["attempt"], w_until))
    in_working = ~F.col("__packet") & (c["in_workdays"] == 1)
    out = prepared.withColumn(spent, F.when(in_working, working_days).otherwise(calendar_days))
    return out.drop(*[f"__w_{d}" for d in dated], "__packet", "__split", "__to_later")


def with_reporting_lateness(
    df: DataFrame,
    calendar: WorkCalendar,
    cols: Mapping[str, str] | None = None,
    *,
    spent: str = "spent",
    late: str = "report_late",
    use_case: str = "use_case",
) -> DataFrame:
    """Add days beyond the allowance of the first matching case, and its name.

    The nine cases look at the outcome code, whether a packet is needed and
    how certification and storage notice follow each other. An unmeasured or
    negative delay counts as none.
    """
    names = {**REPORTING_COLUMNS, **(cols or {})}
    c = {k: F.col(v) for k, v in names.items()}
    packet, kase = F.col("__packet"), F.col("__case")
    prepared = df.withColumns(
        {
            "__packet": packet_kind(names["final"]) == "plico",
            "__stored": c["final"].isin(presets.STORAGE_890_CLOSED),
            "__held": c["final"].isin(presets.STORAGE_AR_RS_CLOSED),
            "__full": c["final"] == "RECAG008C",
            "__after": c["certified"] > c["notice_reported"],
            "__calendar": F.datediff(c["final_day"], c["attempt"]),
            "__working": calendar.days_between(c["attempt"], c["final_day"]),
        }
    )
    stored, full, after = F.col("__stored"), F.col("__full"), F.col("__after")
    before, no_notice = ~after, c["notice_reported"].isNull()
    numbered = prepared.withColumn(
        "__case",
        first_match(
            [
                (c["final"].isin(presets.DIRECT_CLOSED) & ~packet, 1),
                (stored & after & packet, 2),
                (stored & ~full & before & ~packet, 3),
                (stored & no_notice & ~packet, 4),
                (F.col("__held") & packet, 5),
                (F.col("__held") & ~packet, 6),
                (stored & after & ~packet, 7),
                (full & before & packet, 8),
                (full & no_notice & packet, 9),
            ]
        ),
    )
    span = F.when(c["in_workdays"].cast("boolean"), F.col("__working")).otherwise(F.col("__calendar"))
    allowed = first_match(
        [
            (kase == 1, c["allowance"]),
            (kase == 2, F.lit(presets.PACKET_DAYS + presets.STORAGE_NOTICE_DAYS)),
            (kase.isin(3, 4, 6), span + c["allowance"]),
            (kase.isin(5, 8, 9), F.col("__calendar") + presets.PACKET_DAYS),
            (kase == 7, c["allowance"] + presets.STORAGE_NOTICE_DAYS),
        ]
    )
    result = numbered.withColumns(
        {
            # greatest skips NULL.
            late: F.greatest((F.col(spent) - allowed).cast("int"), F.lit(0)),
            use_case: first_match([(kase == number, name) for number, name in USE_CASES.items()]),
        }
    )
    return result.drop("__packet", "__stored", "__held", "__full", "__after", "__calendar", "__working", "__case")


# -- older tender: lateness in hours, shares with a quota ----------------------


def milestone_hours(
    event: str, reported: str, rules: Sequence[tuple[Column, int]], default_days: int, only: Column | None = None
) -> Column:
    """Hours the report of a milestone came after its day boundary.

    ``rules`` gives the days of grace by condition (carrier, lot, period), in
    order; ``only`` restricts to the states for which the milestone counts.
    """
    chain = None
    for condition, days in rules:
        value = dates.hours_after_boundary(reported, event, days)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    default = dates.hours_after_boundary(reported, event, default_days)
    hours = default if chain is None else chain.otherwise(default)
    return hours if only is None else F.when(only, hours)


def share_penalty(
    df: DataFrame,
    keys: Sequence[str],
    *,
    outcomes: str,
    violations: str,
    hours: Sequence[str],
    quota: float = 0.021,
    rate: int = 500,
) -> DataFrame:
    """Violation share per key, penalty beyond the quota and mean delay.

    The penalty is ``(share - quota) * 1000 * rate``, floored at zero.
    """
    delay = sum((F.coalesce(F.col(h), F.lit(0)) for h in hours), F.lit(0))
    measured = sum((F.count(h) for h in hours), F.lit(0))
    sums = df.groupBy(*keys).agg(
        F.sum(F.coalesce(F.col(outcomes), F.lit(0))).alias("outcomes"),
        F.sum(F.coalesce(F.col(violations), F.lit(0))).alias("violations"),
        F.sum(delay).alias("delay_hours"),
        measured.alias("delays"),
    )
    share = F.coalesce(money.safe_ratio(F.col("violations"), F.col("outcomes")), F.lit(0.0))
    return (
        sums.withColumn("violation_share", share)
        .withColumn("penalty", F.greatest((share - quota) * 1000 * rate, F.lit(0.0)))
        .withColumn(
            "mean_delay_hours",
            F.when(F.col("delay_hours") > 0, F.col("delay_hours") / F.nullif(F.col("delays"), F.lit(0))).otherwise(0.0),
        )
    )


def fixed_penalty(product: str, cost: str) -> Column:
    """Cents charged for theft and unreportable items, by product."""
    return (
        F.when(F.col(product) == "890", F.col(cost) * 5)
        .when(F.col(product).isin("RIR", "RIS"), F.col(cost))
        .otherwise(F.lit(200))
        .cast("bigint")
    )


# -- penalties towards senders -------------------------------------------------


def sender_analogue(
    df: DataFrame,
    calendar: WorkCalendar,
    *,
    start: str,
    end: str,
    tie: Sequence[str],
    allowed: int = 70,
    quota: float = 0.97,
    ranks: bool = True,
    **ranking,
) -> DataFrame:
    """Global rank of completion lateness; late items inside the quota pay.

    Without ``ranks`` the rank columns are left out and the quota is found by counting.
    """
    days = calendar.days_between(start, end)
    timed = df.withColumn("completion_days", days).withColumn("late_days", lateness("completion_days", F.lit(allowed)))
    if ranks:
        order = [F.col("late_days").asc(), F.col(end).asc_nulls_first(), *[F.col(t).asc_nulls_first() for t in tie]]
        ranked = ranked_share(timed, [], order, measured=F.col("late_days").isNotNull(), **ranking)
        below = F.col("share") < quota
    else:
        ranked = quota_flags(timed, [], "late_days", [end, *tie], {"__below": quota}, idle=0, **ranking)
        below = F.col("__below")
    return ranked.withColumn("charged", F.when(below & (F.col("late_days") > 0), 1).otherwise(0)).drop("__below")


def sender_analogue_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts and shares per key, plus one total row with NULL keys."""
    late = F.col("late_days") > 0
    measures = {
        "items": Measure("rows"),
        "in_time": Measure("rows", F.col("late_days") == 0),
        "late": Measure("rows", late),
        "late_in_allowance": Measure("rows", late & (F.col("charged") == 0)),
        "late_charged": Measure("rows", F.col("charged") == 1),
    }
    counts = level_sets(df, [list(keys), []], measures)
    return counts.withColumns(
        {
            "in_time_share": F.col("in_time") / F.col("items"),
            "late_share": F.col("late") / F.col("items"),
            "charged_share": F.col("late_charged") / F.col("items"),
        }
    )


def sender_digital_summary(
    df: DataFrame,
    calendar: WorkCalendar,
    *,
    start: str,
    end: str,
    allowed: int = 23,
    allowance: float = 0.01,
    fee: float = 0.2,
) -> DataFrame:
    """Late share beyond the allowance and the resulting amount."""
    late_days = lateness(calendar.days_between(start, end), F.lit(allowed))
    counts = df.select(late_days.alias("late_days")).agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(F.col("late_days") == 0).alias("in_time"),
        F.count_if(F.col("late_days") > 0).alias("late"),
    )
    share, amount = money.allowance_fee(F.col("late"), F.col("items"), allowance, fee)
    return counts.withColumn("charged_share", share).withColumn("penalty", amount)
