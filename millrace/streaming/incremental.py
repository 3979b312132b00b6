"""Snapshot comparison, new-event detection and restart windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import filled
from millrace.operators.joins import all_of
from millrace.operators.ordered import top_row


def snapshot_diff(previous: DataFrame, current: DataFrame, keys: Sequence[str], out: str = "status") -> DataFrame:
    """Every key of either snapshot as ``new``, ``kept`` or ``left``.

    Duplicate keys are reduced before the join, so a key that is repeated very
    often costs one row per map task.
    """
    p = previous.select(*[F.col(k).alias(f"__p_{k}") for k in keys]).distinct().withColumn("__in_p", F.lit(True))
    c = current.select(*keys).distinct().withColumn("__in_c", F.lit(True))
    joined = c.join(p, all_of([F.col(k) == F.col(f"__p_{k}") for k in keys]), "full")
    status = F.when(F.col("__in_p").isNull(), "new").when(F.col("__in_c").isNull(), "left").otherwise("kept")
    return joined.select(*[F.coalesce(k, f"__p_{k}").alias(k) for k in keys], status.alias(out))


def write_snapshot(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> None:
    """Keep a snapshot as a catalog table dealt into ``buckets`` by its keys and sorted by them.

    Later runs join it on the keys without shuffling it again, however large
    the stock has grown. One file per bucket; ``path`` names a folder outside
    the warehouse.
    """
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def _dealt_alike(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Distinct keys, dealt like a snapshot of so many buckets: the only exchange that meeting it needs."""
    return df.select(*keys).repartition(buckets, *keys).distinct()


def diff_to_snapshot(current: DataFrame, table: str, keys: Sequence[str], buckets: int, out: str = "status") -> DataFrame:
    """:func:`snapshot_diff` against a table of :func:`write_snapshot`: the older side is read where it lies.

    ``buckets`` is that of the table. NULL keys match nothing, as there.
    """
    previous = current.sparkSession.table(table).select(*[F.col(k).alias(f"__p_{k}") for k in keys]).distinct().withColumn("__in_p", F.lit(True))
    c = _dealt_alike(current, keys, buckets).withColumn("__in_c", F.lit(True))
    joined = c.join(previous, all_of([F.col(k) == F.col(f"__p_{k}") for k in keys]), "full")
    status = F.when(F.col("__in_p").isNull(), "new").when(F.col("__in_c").isNull(), "left").otherwise("kept")
    return joined.select(*[F.coalesce(k, f"__p_{k}").alias(k) for k in keys], status.alias(out))


def not_in_snapshot(current: DataFrame, table: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Rows of ``current`` whose keys the snapshot does not have; rows with NULL keys stay."""
    previous = current.sparkSession.table(table).select(*[F.col(k).alias(f"__p_{k}") for k in keys])
    on = all_of([F.col(k) == F.col(f"__p_{k}") for k in keys])
    return current.repartition(buckets, *keys).join(previous, on, "left_anti")


def refresh_stock(
    stock: DataFrame, extract: DataFrame, *, key: str, order: Sequence[str], run_time: Column, first_seen: str, is_new: str
) -> DataFrame:
    """Current stock: the extract with its first-seen time kept from the old stock."""
    rows = top_row(extract, [key], order, keep="first")
    old = stock.groupBy(F.col(key).alias("__k")).agg(F.min(first_seen).alias("__seen"), F.lit(1).alias("__was"))
    return (
        rows.join(old, F.col(key) == F.col("__k"), "left")
        .withColumn(first_seen, F.coalesce("__seen", run_time))
        .withColumn(is_new, F.when(F.col("__was").isNull(), 1).otherwise(0))
        .drop("__k", "__seen", "__was")
    )


def append_departed(
    stock: DataFrame,
    current: DataFrame,
    history: DataFrame,
    *,
    key: str,
    order: Sequence[str],
    run_time: Column,
    left_at: str,
    is_new: str,
) -> DataFrame:
    """History of departed items, each appended once.

    Items of the old stock that are gone and not in the history yet are
    appended; earlier rows lose their "new" mark.
    """
    gone = stock.join(current.select(F.col(key).alias("__k")).distinct(), F.col(key) == F.col("__k"), "left_anti")
    known = history.select(F.col(key).alias("__k")).distinct()
    gone = top_row(gone, [key], order, keep="first").join(known, F.col(key) == F.col("__k"), "left_anti")
    fresh = gone.withColumn(left_at, run_time).withColumn(is_new, F.lit(1))
    return history.withColumn(is_new, F.lit(0)).unionByName(fresh, allowMissingColumns=True).select(*history.columns)


def history_report(current: DataFrame, departed: DataFrame, *, key: str, by: Sequence[str]) -> DataFrame:
    """Items ever present, resolved and still open per group."""
    rows = current.select(*by, key, F.lit(False).alias("__gone")).unionByName(
        departed.select(*by, key, F.lit(True).alias("__gone"))
    )
    per_key = rows.groupBy(*by, key).agg(F.max("__gone").alias("__gone"))
    return per_key.groupBy(*by).agg(
        F.count(key).alias("presented"),
        F.count_if(F.col("__gone")).alias("resolved"),
        F.count_if(~F.col("__gone")).alias("still_open"),
    )


def event_key(texts: Mapping[str, bool], time: str) -> dict[str, Column]:
    """Normalised key parts: trimmed text (upper case where true), full timestamp."""
    parts = {}
    for name, upper in texts.items():
        value = F.trim(F.coalesce(F.col(name).cast("string"), F.lit("")))
        parts[f"__k_{name}"] = F.upper(value) if upper else value
    stamp = F.date_format(F.col(time).cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    parts["__k_time"] = F.coalesce(stamp, F.lit(""))
    return parts


def new_events(current: DataFrame, previous: DataFrame, *, texts: Mapping[str, bool], time: str, order: Sequence[str]) -> DataFrame:
    """Events whose normalised key was not in the previous extraction.

    Repeats inside the extraction are reduced to the first row by ``order``.
    """
    parts = event_key(texts, time)
    keys = list(parts)
    now = top_row(current.withColumns(parts), keys, [*order], keep="first")
    before = previous.select(*[c.alias(n) for n, c in parts.items()]).distinct()
    return now.join(before, keys, "left_anti").drop(*keys)


def delta(current: DataFrame, previous: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the extraction whose key was not in the previous one."""
    return current.join(previous.select(*keys).distinct(), list(keys), "left_anti")


def overlay_authorisations(
    df: DataFrame, authorised: DataFrame, *, key: str, order: Sequence[str], cols: Sequence[str], flag: str = "authorised"
) -> DataFrame:
    """Flag and describe authorised items; the last authorisation per key wins."""
    trimmed = authorised.select(F.trim(F.col(key).cast("string")).alias("__k"), *order, *[c for c in cols if c not in order])
    last = top_row(trimmed.filter(F.col("__k") != ""), ["__k"], order)
    last = last.select("__k", *[F.col(c).alias(f"__a_{c}") for c in cols], F.lit(1).alias("__f"))
    joined = df.join(last, F.trim(F.col(key).cast("string")) == F.col("__k"), "left")
    return joined.withColumns(
        {flag: F.coalesce("__f", F.lit(0)), **{c: F.col(f"__a_{c}") for c in cols}}
    ).drop("__k", "__f", *[f"__a_{c}" for c in cols])


def restart_from(log: DataFrame, *, ended: str, state: str, done: str, default: Column, out: str = "restart_from") -> DataFrame:
    """Day to restart from: the last successful run, else ``default`` (one row)."""
    last = F.max(F.when(F.col(state) == done, F.col(ended)))
    return log.agg(F.coalesce(last.cast("date"), default).alias(out))


def since_restart(df: DataFrame, time: str, window: DataFrame, start: str = "restart_from") -> DataFrame:
    """Rows on or after the restart day, with the day as a one-row parameter."""
    return df.crossJoin(F.broadcast(window.select(F.col(start).alias("__from")))).filter(
        F.col(time) >= F.col("__from").cast("timestamp")
    ).drop("__from")


def event_summary(df: DataFrame, *, time: str, by: Sequence[str], missing: str = "NON DISPONIBILE") -> DataFrame:
    """Events per day and descriptive columns, blanks filled."""
    return df.groupBy(
        F.col(time).cast("date").alias("day"), *[filled(c, missing).alias(c) for c in by]
    ).agg(F.count(F.lit(1)).alias("n"))
