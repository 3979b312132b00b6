"""Report aggregates: conditional counts, pivots, histograms, totals, KPIs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import presets
from millrace.functions.money import safe_ratio


class GranularityError(ValueError):
    """A table does not have one row per key."""


def conditional_counts(df: DataFrame, keys: Sequence[str | Column], conditions: Mapping[str, Column], total: str | None = "total") -> DataFrame:
    """Row count per key and per condition, in one pass."""
    aggs = [F.count_if(cond).alias(name) for name, cond in conditions.items()]
    if total:
        aggs.append(F.count(F.lit(1)).alias(total))
    return df.groupBy(*keys).agg(*aggs)


def shares(df: DataFrame, counts: Mapping[str, str], total: str, digits: int | None = None) -> DataFrame:
    """Add ``{output: count column}`` shares of the total (NULL for total 0)."""
    return df.withColumns({out: rounded(safe_ratio(F.col(c), F.col(total)), digits) for out, c in counts.items()})


def pivot_with_total(
    df: DataFrame, key: str, by: str, values: Mapping[str, str], measure: Column, label: str = "TOTALE"
) -> DataFrame:
    """Sum of ``measure`` per key and listed value, plus one total row.

    The listed values are fixed columns (no extra pass to discover them) and
    the total row adds up the rows of the keys.
    """
    cols = {out: Measure("sum", F.when(F.col(by) == v, measure).otherwise(0)) for out, v in values.items()}
    out = level_sets(df, [[key], []], {**cols, "totale": Measure("sum", measure)}, "__g")
    return out.withColumn(key, F.when(F.col("__g") == 1, F.lit(label)).otherwise(F.col(key))).drop("__g")


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], cols: Sequence[str], aggs: Sequence[Column], level: str | None = None) -> DataFrame:
    """Several groupings in one pass; ``level`` adds Spark's grouping id."""
    if level:
        aggs = [*aggs, F.grouping_id().cast("bigint").alias(level)]
    return df.groupingSets([list(s) for s in sets], *cols).agg(*aggs)


@dataclass(frozen=True)
class Measure:
    """A value that can be added up from parts: ``rows``, ``count``, ``sum``, ``min`` or ``max`` of a column.

    ``rows`` counts the rows for which the column holds, or all without one.
    """

    kind: str
    value: Column | str | None = None

    def first(self) -> Column:
        value = F.col(self.value) if isinstance(self.value, str) else self.value
        if self.kind == "rows":
            return F.count(F.lit(1)) if value is None else F.count_if(value)
        return {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}[self.kind](value)

    def again(self, part: str) -> Column:
        return {"min": F.min, "max": F.max}.get(self.kind, F.sum)(part)


def level_sets(df: DataFrame, sets: Sequence[Sequence[str]], measures: Mapping[str, Measure], level: str | None = None) -> DataFrame:
    """Several groupings of the same rows, from the finest groups.

    The rows are aggregated once by all columns of all sets; only these groups
    are expanded to the sets, never the rows. ``level`` adds Spark's grouping id
    (bits of the columns, in order of first mention, that a row leaves out),
    which tells a total from a group whose key is NULL. The grand total of no
    rows is a row of its own, as with grouping sets.
    """
    cols = list(dict.fromkeys(c for s in sets for c in s))
    finest = df.groupBy(*cols).agg(*[m.first().alias(name) for name, m in measures.items()])
    # Counts of no rows are 0, as if counted directly.
    merged = [(F.coalesce(m.again(name), F.lit(0)) if m.kind in ("rows", "count") else m.again(name)).alias(name) for name, m in measures.items()]
    return grouping_sets(finest, sets, cols, merged, level)


def rounded(col: Column, digits: int | None) -> Column:
    return col if digits is None else F.round(col, digits)


def histogram(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    classes: Sequence[tuple[int, int]] = presets.TEN_DAY_CLASSES,
    digits: int | None = None,
) -> DataFrame:
    """Counts and percentages per closed class, open above the last one."""
    v = F.col(value)
    tests = {f"{lo}_{hi}": v.between(lo, hi) for lo, hi in classes}
    tests["over"] = v > classes[-1][1]
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(v).alias("sum_value"),
        *[F.count_if(t).alias(f"count_{name}") for name, t in tests.items()],
    )
    return counts.withColumns(
        {f"pct_{name}": rounded(F.col(f"count_{name}") * 100.0 / F.col("n"), digits) for name in tests}
    )


def mean_duration(df: DataFrame, keys: Sequence[str], value: str, digits: int | None = None) -> DataFrame:
    """Sum, count and sum / count of a duration per key."""
    sums = df.groupBy(*keys).agg(F.sum(value).alias("total"), F.count(value).alias("n"))
    return sums.withColumn("mean", rounded(safe_ratio(F.col("total"), F.col("n")), digits))


def freshness(df: DataFrame, time: str) -> DataFrame:
    return df.agg(F.min(time).alias("oldest"), F.max(time).alias("newest"))


def granularity(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and distinct keys, counted without gathering the keys in one task."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_keys"))


def require_granularity(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise :class:`GranularityError` unless there is one row per key."""
    row = granularity(df, keys).first()
    if (row["rows"] or 0) != row["distinct_keys"]:
        raise GranularityError(f"{row['rows']} rows for {row['distinct_keys']} keys {list(keys)}")
    return df


def rekey_to_root(df: DataFrame, parents: DataFrame, *, key: str, child: str, root: str, root_name: str, name: str, measures: Sequence[str]) -> DataFrame:
    """Aggregate children under their root; entities without one keep their key."""
    p = parents.select(F.col(child).alias("__c"), F.col(root).alias("__root"), F.col(root_name).alias("__name"))
    joined = df.join(p, F.col(key) == F.col("__c"), "left")
    return joined.groupBy(
        F.coalesce("__root", key).alias("entity"), F.coalesce("__name", name).alias("entity_name")
    ).agg(*[F.sum(m).alias(m) for m in measures])


def overlapping_clusters(
    df: DataFrame, clusters: Mapping[str, Column], measures: Mapping[str, Column], out: str = "cluster"
) -> DataFrame:
    """Counts per cluster where a row may belong to several clusters.

    Every (cluster, measure) pair is one conditional count of a single ungrouped
    aggregate, so the input is read once, no row is multiplied and each map
    task sends one row. The wide result is then turned into one row per cluster.
    """
    counts = [F.count_if(c & m).alias(f"{i}_{name}") for i, c in enumerate(clusters.values()) for name, m in measures.items()]
    wide = df.agg(*counts)
    rows = [
        F.struct(F.lit(label).alias(out), *[F.col(f"{i}_{name}").alias(name) for name in measures])
        for i, label in enumerate(clusters)
    ]
    return wide.select(F.inline(F.array(*rows)))


def population_flags(events: DataFrame, key: Sequence[str], kind: str, populations: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per key, whether any event of each population exists (one scan)."""
    return events.groupBy(*key).agg(
        *[F.max(F.when(F.col(kind).isin(list(kinds)), 1).otherwise(0)).alias(name) for name, kinds in populations.items()]
    )


def ageing(df: DataFrame, keys: Sequence[str], *, since: str, as_of: Column, finished: Column, overdue: Column) -> DataFrame:
    """Open and overdue items by age (up to 30, 31-60, more than 60 days)."""
    age = F.datediff(as_of, since)
    late = overdue
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("entrusted"),
        F.count_if(finished).alias("completed"),
        F.count_if(~finished).alias("open_items"),
        F.count_if(~finished & ~overdue).alias("in_progress"),
        F.count_if(late & (age <= 30)).alias("overdue_1m"),
        F.count_if(late & (age > 30) & (age <= 60)).alias("overdue_2m"),
        F.count_if(late & (age > 60)).alias("overdue_more"),
    )
    overdue_all = F.col("overdue_1m") + F.col("overdue_2m") + F.col("overdue_more")
    return out.withColumn("overdue_share", safe_ratio(overdue_all, F.col("open_items")))
