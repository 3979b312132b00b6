"""Event logs: collapse, first and last events, validity intervals, duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import presets
from millrace.functions.text import repair_timestamp, strip_prefix
from millrace.operators.ordered import HOT_ROWS, lag_lead


def explode_events(df: DataFrame, key: str, events: str, prefix: str = "") -> DataFrame:
    """One row per logged event with repaired timestamps.

    ``events`` is an array of structs that hold the event under
    ``paperprogrstatus``.
    """
    e = F.col("__e.paperprogrstatus")
    return df.select(strip_prefix(key, prefix).alias(key), F.explode(events).alias("__e")).select(
        key,
        e["statuscode"].alias("statuscode"),
        repair_timestamp(e["statusdatetime"]).alias("statusdatetime"),
        repair_timestamp(e["clientrequesttimestamp"]).alias("clientrequesttimestamp"),
        e["deliveryfailurecause"].alias("deliveryfailurecause"),
        e["attachments"].alias("attachments"),
    )


def last_attachment(events: DataFrame, key: str, types: Sequence[str]) -> DataFrame:
    """Type of the most recently reported attachment per item."""
    docs = events.select(key, "clientrequesttimestamp", F.explode("attachments.documenttype").alias("documenttype"))
    wanted = docs.filter(F.col("documenttype").isin(list(types)))
    by = F.struct("clientrequesttimestamp", "documenttype")
    return wanted.groupBy(key).agg(F.max(by)["documenttype"].alias("documenttype"))


def collapse_nested(
    df: DataFrame,
    key: str,
    events: str,
    kinds: Sequence[str],
    *,
    keep: Mapping[str, str],
    attachments: Sequence[str] = (),
    prefix: str = "",
) -> DataFrame:
    """Per key: number of events, and per kind their number and the last one's ``keep`` fields; last attachment type.

    ``events`` is an array of structs as in :func:`explode_events`. Each stored
    array is reduced where it stands, by functions on arrays, so no event
    becomes a row; what meets per key is one narrow row per stored array,
    combined before it is dealt. The last event of a kind is the one with the
    greatest repaired ``statusdatetime``, then by the kept fields. Null or empty
    arrays count no events; columns are ``events``, ``<kind>_events``,
    ``<kind>_<output>`` and ``documenttype``.
    """
    log = F.coalesce(F.transform(events, lambda e: e["paperprogrstatus"]), F.array().cast(df.schema[events].dataType).getField("paperprogrstatus"))

    def of_kind(kind: str) -> Column:
        return F.filter(log, lambda e: e["statuscode"] == kind)

    def stamped(e: Column) -> Column:
        return F.struct(repair_timestamp(e["statusdatetime"]).alias("at"), *[e[c].alias(o) for o, c in keep.items()])

    def reported(e: Column) -> Column:
        listed = F.filter(F.coalesce(e["attachments"]["documenttype"], F.array().cast("array<string>")), lambda d: d.isin(list(attachments)))
        return F.transform(listed, lambda d: F.struct(repair_timestamp(e["clientrequesttimestamp"]).alias("at"), d.alias("type")))

    own = {"__n": F.size(log)}
    for i, kind in enumerate(kinds):
        own |= {f"__n{i}": F.size(of_kind(kind)), f"__last{i}": F.array_max(F.transform(of_kind(kind), stamped))}
    if attachments:
        own["__doc"] = F.array_max(F.flatten(F.transform(log, reported)))
    reduced = df.select(strip_prefix(key, prefix).alias(key), *[c.alias(n) for n, c in own.items()])
    aggs = [F.sum("__n").alias("events")]
    for i, kind in enumerate(kinds):
        aggs += [F.sum(f"__n{i}").alias(f"{kind.lower()}_events"), F.max(f"__last{i}").alias(f"__last{i}")]
    if attachments:
        aggs.append(F.max("__doc").alias("__doc"))
    wide = reduced.groupBy(key).agg(*aggs)
    lasts = [F.col(f"__last{i}")[o].alias(f"{kind.lower()}_{o}") for i, kind in enumerate(kinds) for o in ("at", *keep)]
    return wide.select(key, "events", *[f"{kind.lower()}_events" for kind in kinds], *lasts, *([F.col("__doc.type").alias("documenttype")] if attachments else []))


def collapse(
    events: DataFrame, keys: Sequence[str], kind: Column, kinds: Sequence[str], *, order: Sequence[str], keep: Mapping[str, str]
) -> DataFrame:
    """Last event of each kind per key, one wide row.

    Columns are ``<kind>_<output>``. One aggregate does it: the latest event of
    a kind is a struct maximum, so nothing is sorted per key and a key with
    very many events costs one partial row per map task.
    """
    wanted = [o for o in order]
    value = F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(wanted)], *[F.col(c).alias(o) for o, c in keep.items()])
    tagged = events.select(*keys, kind.alias("__kind"), value.alias("__v")).filter(F.col("__kind").isin(list(kinds)))
    aggs = [F.max(F.when(F.col("__kind") == k, F.col("__v"))).alias(f"__{k}") for k in kinds]
    wide = tagged.groupBy(*keys).agg(*aggs)
    return wide.select(
        *keys, *[F.col(f"__{k}")[o].alias(f"{k.lower()}_{o}") for k in kinds for o in keep]
    )


def pivot_max(df: DataFrame, keys: Sequence[str], kind: str, value: str, names: Mapping[str, str]) -> DataFrame:
    """Latest value per listed kind, ``{output: kind}``, as columns."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(kind) == k, F.col(value))).alias(out) for out, k in names.items()]
    )


def first_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Mapping[str, str]) -> DataFrame:
    """First and last row per key: ``first_<output>`` and ``last_<output>``."""
    by = F.struct(*order)
    payload = F.struct(*[F.col(c).alias(o) for o, c in keep.items()])
    agg = df.groupBy(*keys).agg(F.min_by(payload, by).alias("__f"), F.max_by(payload, by).alias("__l"))
    return agg.select(
        *keys,
        *[F.col("__f")[o].alias(f"first_{o}") for o in keep],
        *[F.col("__l")[o].alias(f"last_{o}") for o in keep],
    )


def repeated(df: DataFrame, keys: Sequence[str], at_least: int = 2, out: str = "events") -> DataFrame:
    """Keys with several rows, and how many."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) >= at_least)


def unfinished(df: DataFrame, key: str, kind: str, done: str, planned: str, planned_at: Column) -> DataFrame:
    """Keys without a ``done`` event: planned flag and latest planned time."""
    return (
        df.filter(F.col(kind).isin(done, planned))
        .groupBy(key)
        .agg(
            F.count_if(F.col(kind) == done).alias("done"),
            F.max(F.when(F.col(kind) == planned, 1).otherwise(0)).alias("planned"),
            F.max(planned_at).alias("planned_at"),
        )
        .filter(F.col("done") == 0)
        .drop("done")
    )


def retransmissions(
    df: DataFrame, keys: Sequence[str], *, reported: str, happened: str
) -> DataFrame:
    """Outcomes reported more than once: first and last report and the delays.

    ``first_delay`` is first report minus first business time, ``resend_delay``
    is last report minus first report, both in whole days.
    """
    by = F.col(reported)
    agg = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("reports"),
        F.min_by(happened, by).alias("first_happened"),
        F.min(by).alias("first_reported"),
        F.max(by).alias("last_reported"),
    )
    return agg.filter(F.col("reports") > 1).withColumns(
        {
            "first_delay": F.datediff("first_reported", "first_happened"),
            "resend_delay": F.datediff("last_reported", "first_reported"),
        }
    )


def activity(kind: Column, deleted: Column) -> Column:
    """1 for a live version, 0 for a removal, NULL for anything else.

    Inserts and changes count while they are not flagged as deleted, removals
    only when they are.
    """
    name = F.upper(F.trim(kind))
    live = name.isin("INSERT", "MODIFY") & ~F.coalesce(deleted, F.lit(False))
    return F.when(live, 1).when((name == "REMOVE") & deleted, 0)


def validity_intervals(
    log: DataFrame,
    keys: Sequence[str],
    *,
    time: str,
    tie: Sequence[str],
    active: str,
    start: str | None = None,
    end: str | None = None,
    open_end: str = presets.OPEN_END,
    hot_rows: int | None = HOT_ROWS,
    piece_rows: int | None = None,
) -> DataFrame:
    """Turn a change log into validity intervals ``valid_from``/``valid_to``.

    ``active`` is 1 for a live version, 0 for a removal and NULL for events to
    ignore. A live version starts at its own ``start`` unless it follows a
    removal, and ends at the earlier of its own ``end`` and the next event.
    """
    events = log.filter(F.col(active).isNotNull())
    linked = lag_lead(
        events,
        keys,
        [time, *tie],
        lag={"__prev": active},
        lead={"__next": time},
        hot_rows=hot_rows,
        piece_rows=piece_rows,
    )
    own_start = F.col(start) if start else F.lit(None).cast("timestamp")
    own_end = F.col(end) if end else F.lit(None).cast("timestamp")
    begins = F.when(F.col("__prev") == 0, F.col(time)).otherwise(F.coalesce(own_start, F.col(time)))
    ends = F.coalesce(F.least(own_end, F.col("__next")), F.lit(open_end).cast("timestamp"))
    return (
        linked.filter(F.col(active) == 1)
        .withColumn("valid_from", begins)
        .withColumn("valid_to", ends)
        .drop("__prev", "__next")
    )
