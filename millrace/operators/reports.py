"""Billing, backlog and trend reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import dates, presets
from millrace.functions.money import safe_ratio
from millrace.functions.rules import first_match
from millrace.operators.joins import any_of, consecutive, enrich, full_outer
from millrace.operators.ordered import top_row


def latest_contract(contracts: DataFrame, *, key: str, updated: str, tie: Sequence[str], active: Column) -> DataFrame:
    """Latest active contract per party."""
    return top_row(contracts.filter(active & F.col(key).isNotNull()), [key], [updated, *tie])


# Page limits by physical communication type.
PAGE_LIMITS = {"REGISTERED_LETTER_890": 18, "AR_REGISTERED_LETTER": 100}


def limit_breaches(df: DataFrame, limits: Mapping[str, int] = PAGE_LIMITS, *, kind: str, pages: str) -> DataFrame:
    """Items with more pages than their kind allows."""
    return df.filter(any_of([(F.col(kind) == k) & (F.col(pages) > n) for k, n in limits.items()]))


def mismatch_count(
    facts: DataFrame, contracts: DataFrame, *, fact_key: str, contract_key: str, actual: str, expected: str,
    by: Sequence[str], period: tuple[dt.date, dt.date], time: str,
) -> DataFrame:
    """Facts whose recorded id differs from the contract's, per group."""
    in_time = facts.filter(dates.in_period(time, period))
    c = contracts.select(F.col(contract_key).alias("__k"), F.col(expected).alias("expected"))
    joined = in_time.join(c, F.col(fact_key) == F.col("__k"), "inner")
    wrong = joined.filter(F.col(actual) != F.col("expected"))
    return wrong.groupBy(*by, "expected").agg(F.count(F.lit(1)).alias("n"))


def missing_attachment(df: DataFrame, *, completed: str, state: str, states: Sequence[str], missing: str, present: Sequence[str]) -> DataFrame:
    """Completed items in the given states that lack one scan but have the others."""
    out = df.filter(F.col(completed).isNotNull() & F.col(state).isin(list(states)) & F.col(missing).isNull())
    for col in present:
        out = out.filter(F.col(col).isNotNull())
    return out


def billable(
    df: DataFrame, *, year: int, quarter: int, completed: str, cancelled: str, deceased: Column, final_reported: str, final: str,
    stolen: Sequence[str] = presets.STOLEN_OR_UNREPORTABLE,
) -> DataFrame:
    """Items completed, cancelled or returned in a quarter, thefts excluded."""

    def falls(col: str) -> Column:
        return (F.year(col) == year) & (F.quarter(col) == quarter)

    kept = df.filter(F.col(final).isNull() | ~F.col(final).isin(list(stolen)))
    return kept.filter(any_of([falls(completed), falls(cancelled), deceased & F.col(final).isNotNull() & falls(final_reported)]))


def complete_without_events(
    df: DataFrame, *, year: int, quarter: int, accepted: str, handed_over: str, final: str, missing: str,
    excluded: Sequence[str] = (*presets.STOLEN_OR_UNREPORTABLE, "RECRSI005", "RECRI005", "PN998"),
) -> DataFrame:
    """Finished items of a quarter with intermediate events missing."""
    day = dates.reference_date(accepted, handed_over)
    return df.filter(
        F.col(final).isNotNull()
        & ~F.col(final).isin(list(excluded))
        & (F.year(day) == year)
        & (F.quarter(day) == quarter)
        & (F.col(missing) == 1)
    )


def cost_gaps(df: DataFrame, *, key: Sequence[str], number: str, costs: Mapping[str, str]) -> DataFrame:
    """Consecutive retries whose costs differ, with the differences."""
    carry = {f"{out}_next": col for out, col in costs.items()}
    pairs = consecutive(df, key, number, carry)
    changes = {
        f"delta_{out}": F.coalesce(F.col(f"{out}_next"), F.lit(0)) - F.coalesce(F.col(col), F.lit(0))
        for out, col in costs.items()
    }
    out = pairs.withColumns(changes)
    return out.filter(any_of([F.col(c) != 0 for c in changes]))


def revenue_gaps(left: DataFrame, right: DataFrame, keys: Sequence[str], left_amount: str, right_amount: str) -> DataFrame:
    """Amounts of two ledgers side by side with coalesced keys."""
    out = full_outer(left, right, keys, {"left_amount": left_amount}, {"right_amount": right_amount})
    zero = F.lit(0)
    return out.withColumn("difference", F.coalesce("left_amount", zero) - F.coalesce("right_amount", zero))


def blocked_items(df: DataFrame, decisions: DataFrame, *, key: str, states: Sequence[str], decision: str, blocked: Sequence[str] = presets.BLOCKED) -> DataFrame:
    """Items blocked in any state column that nobody has decided on yet."""
    hit = any_of([F.col(s).isin(list(blocked)) for s in states])
    decided = decisions.select(F.col(key).alias("__k"), F.col(decision).alias(decision))
    joined = df.filter(hit).join(decided, F.col(key) == F.col("__k"), "left").drop("__k")
    return joined.filter(F.col(decision).isNull() | (F.upper(F.trim(decision)) == "TBD"))


def stale(df: DataFrame, *, sent: str, before: dt.date, completed: Sequence[str]) -> DataFrame:
    """Items sent before a day and still not completed."""
    out = df.filter(F.col(sent) < F.lit(dt.datetime(before.year, before.month, before.day)))
    for col in completed:
        out = out.filter(F.col(col).isNull())
    return out


def event_facts(events: DataFrame, key: str, facts: Mapping[str, Column]) -> DataFrame:
    """Per key, the maximum of each conditional value, in one scan."""
    return events.groupBy(key).agg(*[F.max(c).alias(name) for name, c in facts.items()])


def period_report(df: DataFrame, *, lot: str, day: Column, periods: Sequence[tuple[Sequence[str], str, str, str]], cost: str) -> DataFrame:
    """Items and cost per lot and contract period ``(lots, from, to, label)``."""
    rules = [
        (
            F.col(lot).isin(list(lots))
            & (day >= F.lit(start).cast("timestamp"))
            & (day < F.lit(end).cast("timestamp")),
            label,
        )
        for lots, start, end, label in periods
    ]
    labelled = df.withColumn("period", first_match(rules)).filter(F.col("period").isNotNull())
    return labelled.groupBy(lot, "period").agg(F.count(F.lit(1)).alias("items"), F.sum(cost).alias("cost"))


def lot_order(lot: str) -> list[Column]:
    """Sort key for lot numbers with text suffixes: 30BIS next to 30."""
    return [F.regexp_extract(lot, "([0-9]+)", 1).try_cast("int").asc_nulls_last(), F.col(lot).asc_nulls_last()]


def outcome_shares(df: DataFrame, keys: Sequence[str], outcomes: Mapping[str, Column]) -> DataFrame:
    """Count and share of each outcome per key."""
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("entrusted"), *[F.count_if(c).alias(name) for name, c in outcomes.items()]
    )
    return counts.withColumns({f"{name}_share": safe_ratio(F.col(name), F.col("entrusted")) for name in outcomes})


def trend(df: DataFrame, dim: DataFrame, *, on: dict[str, str], area: dict[str, str], day: str) -> DataFrame:
    """Items per area, year and month."""
    placed = enrich(df, dim, on, area)
    return placed.groupBy(*area, F.year(day).alias("year"), F.month(day).alias("month")).agg(
        F.count(F.lit(1)).alias("items")
    )


def active_purposes(
    purposes: DataFrame, agreements: DataFrame, tenants: DataFrame, services: DataFrame, *, producers: Sequence[str]
) -> DataFrame:
    """Active purpose versions with their agreement, service descriptor and consumer, each once.

    The result holds every column of the four sides, so it repeats a row only
    where a side does: the sides are made distinct, not the far longer result.
    """
    versions = (
        purposes.select(
            F.col("id").alias("purpose_id"), "eserviceid", "consumerid", F.explode("versions").alias("v")
        )
        .filter(F.upper("v.state").isin("ACTIVE", "WAITINGFORAPPROVAL"))
        .select(
            "purpose_id", "eserviceid", "consumerid",
            F.col("v.id").alias("version_id"), F.col("v.state").alias("state"), F.col("v.dailycalls").alias("daily_calls"),
        )
    )
    agreed = agreements.filter(
        F.col("producerid").isin(list(producers)) & F.upper("state").isin("ACTIVE", "SUSPENDED")
    ).select(F.col("id").alias("agreement_id"), "producerid", "eserviceid", "consumerid", "descriptorid")
    described = services.select(
        F.col("id").alias("eserviceid"), F.col("name").alias("eservice_name"), "producerid", F.explode("descriptors").alias("d")
    ).select(
        "eserviceid", "eservice_name", "producerid",
        F.col("d.id").alias("descriptorid"), F.col("d.version").alias("descriptor_version"),
        F.col("d.dailycallsperconsumer").alias("daily_calls_per_consumer"), F.col("d.dailycallstotal").alias("daily_calls_total"),
    )
    named = tenants.select(F.col("id").alias("consumerid"), F.col("name").alias("consumer_name"))
    return (
        versions.distinct()
        .join(agreed.distinct(), ["eserviceid", "consumerid"])
        .join(described.distinct(), ["eserviceid", "producerid", "descriptorid"])
        .join(named.distinct(), "consumerid")
    )


def coverage_by_area(df: DataFrame, dim: DataFrame, *, on: dict[str, str], area: dict[str, str], item: str, kinds: Mapping[str, Column], missing: str) -> DataFrame:
    """Distinct items per area and kind; unknown areas get a fill label."""
    placed = enrich(df, dim, on, area)
    placed = placed.withColumns({a: F.coalesce(a, F.lit(missing)) for a in area})
    return placed.groupBy(*area).agg(
        *[F.countDistinct(F.when(cond, F.col(item))).alias(name) for name, cond in kinds.items()]
    )
