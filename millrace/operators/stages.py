"""Print-supplier stages, pick-up and carrier backlog reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import money, presets
from millrace.functions.calendar import WorkCalendar
from millrace.functions.rules import first_match
from millrace.operators.capacity import mode_dates, over_grace
from millrace.operators.joins import not_in


def print_lateness(assigned: DataFrame, calendar: WorkCalendar, *, day: str, printed: str, pages: str, grace: int = 2) -> DataFrame:
    """Penalty per assigned day from the day's most common print date.

    Pages and dates are aggregated per (day, print date) first; the mode and
    the total both come from those few rows.
    """
    counts = assigned.groupBy(day, printed).agg(
        F.count(F.lit(1)).alias("n"), F.sum(pages).cast("bigint").alias("__pages")
    )
    # Most frequent date; among equals the earlier one.
    best = F.struct(F.col("n"), -F.unix_date(F.col(printed)))
    per_day = counts.groupBy(day).agg(F.max_by(printed, best).alias("print_day"), F.sum("__pages").alias("pages"))
    late = over_grace(calendar.days_between(day, "print_day"), grace)
    return (
        per_day.withColumn("late_days", late)
        .withColumn("penalty", money.stepped_fee(F.col("late_days"), 3, 300, 500))
        .withColumns({"month": F.month(day), "year": F.year(day), "quarter": F.quarter(day)})
    )


def pickup_lateness(
    df: DataFrame, calendar: WorkCalendar, *, printed: str, ready: str, grace: int = 2, rate: int = 150
) -> DataFrame:
    """Penalty per print day from the most common ready date.

    If the most common value is "not ready yet" the second one is used.
    """
    shifted = df.select(calendar.next_workday(printed).alias("print_day"), F.col(ready).cast("date").alias("__ready"))
    modes = mode_dates(shifted, "print_day", "__ready")
    picked = modes.select("print_day", F.coalesce("first_date", "second_date").alias("pickup_day"))
    late = over_grace(calendar.days_between("print_day", "pickup_day"), grace)
    return (
        picked.withColumn("late_days", late)
        .withColumn("penalty", F.col("late_days") * rate)
        .withColumns({"month": F.month("print_day"), "year": F.year("print_day"), "quarter": F.quarter("print_day")})
    )


def stuck_stage(
    df: DataFrame,
    calendar: WorkCalendar,
    as_of: Column,
    cols: Mapping[str, str],
    stages: Sequence[tuple[str, str, str, int, int]] = presets.SUPPLIER_STAGES,
) -> DataFrame:
    """First stage an item is stuck in: label, priority, working days and excess.

    ``cols`` maps the milestone names of ``stages`` to columns. Items inside
    their allowance are dropped.
    """
    waiting = {
        start: calendar.days_between(cols[start], as_of) for start in dict.fromkeys(s for _, _, s, _, _ in stages)
    }
    timed = df.withColumns({f"__d_{start}": days for start, days in waiting.items()})
    rules = []
    for label, missing, start, allowed, priority in stages:
        days = F.col(f"__d_{start}")
        found = F.struct(
            F.lit(label).alias("stage"),
            F.lit(priority).alias("priority"),
            days.alias("waiting_days"),
            (days - allowed).alias("excess_days"),
        )
        rules.append((F.col(cols[missing]).isNull() & (days >= allowed), F.when(days > allowed, F.array(found))))
    # Exploding at most one stage per item drops the others without a filter
    # that would repeat the day counts below the projection.
    return (
        timed.withColumn("__s", F.explode(first_match(rules)))
        .select(*df.columns, "__s.*")
    )


def stuck_candidates(
    df: DataFrame, *, open_until: Sequence[str], item: str, incidents: DataFrame, incident_key: str, state: str, states: Sequence[str]
) -> DataFrame:
    """Items with none of the later milestones, outside incidents and error states."""
    still_open = df
    for col in open_until:
        still_open = still_open.filter(F.col(col).isNull())
    still_open = still_open.filter(~F.col(state).isin(list(states)))
    return not_in(still_open, item, incidents, incident_key)


def criticality(
    df: DataFrame,
    *,
    sender: str,
    item: str,
    completed: str,
    listed: DataFrame,
    always: DataFrame,
    excluded: DataFrame,
) -> DataFrame:
    """``Critico`` flag and watched-sender flag from two sender lists.

    A listed sender is critical while the item is not completed, an
    always-critical sender in any case, and excluded items never are. Each list
    is a one-column table named like its key.
    """

    def mark(frame: DataFrame, table: DataFrame, key: str, name: str) -> DataFrame:
        keys = table.select(F.col(key).alias("__k")).filter(F.col("__k").isNotNull()).distinct()
        keys = keys.withColumn(name, F.lit(True))
        return frame.join(keys, F.col(key) == F.col("__k"), "left").drop("__k")

    out = mark(df, listed, sender, "__listed")
    out = mark(out, always, sender, "__always")
    out = mark(out, excluded, item, "__excluded")
    free = F.col("__excluded").isNull()
    critical = first_match(
        [
            (F.col("__listed") & F.col(completed).isNull() & free, "Critico"),
            (F.col("__always") & free, "Critico"),
        ]
    )
    return (
        out.withColumn("criticita", critical)
        .withColumn("ente_attenzionato", F.when(F.col("__always"), "SI").otherwise("NO"))
        .drop("__listed", "__always", "__excluded")
    )
