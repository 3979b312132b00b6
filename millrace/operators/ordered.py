"""Ordered computations that survive hot groups.

A plain Spark window sends each group to one task. That is the right plan
while every group is modest, and the wrong one when a single key owns a third
of the table. The helpers here count the rows of each group first (a map-side
combined aggregate), keep the plain window for ordinary groups, and send the
rows of hot groups through a range partitioning on (group, order) instead:

1. range partition on the full ordering, which cuts a hot group into many
   contiguous pieces, remember the piece number, and write the result once;
2. aggregate each (group, piece) to one row and scan those few rows to get
   what precedes every piece;
3. run the window inside (group, piece) and add the carried value.

The number of summary rows is at most pieces + hot groups, never the data.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from millrace.session import materialise

# Rows one task may sort for a single group before the group counts as hot.
HOT_ROWS = 5_000_000
# Rows of a table of groups that may be broadcast.
BROADCAST_GROUPS = 100_000
_PIECE = "__piece"
_POS = "__pos"
_CARRY = "__carry_"


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` is sum, max, min, count or last.

    ``exclusive`` leaves the current row out of the frame. ``last`` keeps the
    most recent row even if its value is NULL, which makes an exclusive
    ``last`` a ``lag``.
    """

    kind: str
    value: Column | None = None
    exclusive: bool = False

    def _input(self) -> Column:
        if self.kind == "count":
            return F.lit(1)
        if self.kind == "last":
            return F.struct(self.value.alias("v"))
        return self.value

    def _aggregate(self, col: Column) -> Column:
        return {
            "count": F.count,
            "sum": F.sum,
            "max": F.max,
            "min": F.min,
            "last": F.last,
        }[self.kind](col)

    def _combine(self, earlier: Column, local: Column) -> Column:
        if self.kind in ("count", "sum"):
            both = F.coalesce(earlier, F.lit(0)) + F.coalesce(local, F.lit(0))
            return F.when(earlier.isNotNull() | local.isNotNull(), both)
        if self.kind == "max":
            return F.greatest(earlier, local)
        if self.kind == "min":
            return F.least(earlier, local)
        return F.coalesce(local, earlier)

    def _finish(self, col: Column) -> Column:
        if self.kind == "count":
            return F.coalesce(col, F.lit(0)).cast("bigint")
        return col["v"] if self.kind == "last" else col


def _frame(spec: WindowSpec, exclusive: bool) -> WindowSpec:
    return spec.rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow)


def hot_groups(df: DataFrame, group: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys of the groups with more than ``hot_rows`` rows, with their counts."""
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows)


def split_hot(df: DataFrame, group: Sequence[str], hot_rows: int) -> tuple[DataFrame, DataFrame | None, int]:
    """(ordinary rows, hot rows or None, number of hot rows).

    With hot groups the frame is written out first: the ordinary part, the
    sample that finds the piece boundaries and the pieces all read it, and what
    leads up to it should not run again for each. The hot keys stay a table;
    only their number comes to the driver, and the optimiser picks the join.
    """
    # The count reads the group columns only.
    total = hot_groups(df.select(*group), group, hot_rows).agg(F.sum("__n")).first()[0]
    if not total:
        return df, None, 0
    df = materialise(df, "grouped")
    if not group:
        return df.filter(F.lit(False)), df, total
    keys = materialise(hot_groups(df, group, hot_rows).select([F.col(g).alias(f"__k_{g}") for g in group]), "hot-keys")
    on = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__k_{g}")) for g in group])
    return df.join(keys, on, "left_anti"), df.join(keys, on, "left_semi"), total


def range_pieces(df: DataFrame, group: Sequence[str], order: Sequence[Column], rows: int, piece_rows: int) -> DataFrame:
    """Cut ``df`` into contiguous pieces of its (group, order) ordering.

    Adds ``__piece``; pieces never overlap in the ordering. The frame is
    written out because the piece boundaries come from a sample and must be
    the same for every later use.
    """
    pieces = max(2, math.ceil(rows / piece_rows) * 2)
    ranged = df.repartitionByRange(pieces, *[F.col(g).asc_nulls_first() for g in group], *order)
    return materialise(ranged.withColumn(_PIECE, F.spark_partition_id()), "pieces")


def _plain(df: DataFrame, group: Sequence[str], order: Sequence[Column], outs: dict[str, Running]) -> DataFrame:
    spec = Window.partitionBy(*group).orderBy(*order)
    cols = {
        name: run._finish(run._aggregate(run._input()).over(_frame(spec, run.exclusive))) for name, run in outs.items()
    }
    return df.withColumns(cols)


def _summary_rows(rows: int, hot_rows: int, piece_rows: int) -> int:
    """Most (group, piece) pairs of so many hot rows: a group more than fills its pieces but for the two at its ends."""
    return 2 * math.ceil(rows / piece_rows) + 2 + rows // max(hot_rows, 1)


def _pieced(pieces: DataFrame, group: Sequence[str], order: Sequence[Column], outs: dict[str, Running], most: int) -> DataFrame:
    """``most`` bounds the rows of the summary; it is broadcast where that is few."""
    names = list(outs)
    # "last" needs the ordering inside the aggregate, everything else is free
    # of order and combines map-side.
    position = F.struct(*[F.lit(0).alias("z")])
    if any(run.kind == "last" for run in outs.values()):
        spec = Window.partitionBy(_PIECE, *group).orderBy(*order)
        pieces = pieces.withColumn(_POS, F.row_number().over(spec))
        position = F.col(_POS)
    aggs = []
    for name in names:
        run = outs[name]
        if run.kind == "last":
            aggs.append(F.max_by(run._input(), position).alias(_CARRY + name))
        else:
            aggs.append(run._aggregate(run._input()).alias(_CARRY + name))
    totals = pieces.groupBy(_PIECE, *group).agg(*aggs)
    before = Window.partitionBy(*group).orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carried = {}
    for name in names:
        run = outs[name]
        col = F.col(_CARRY + name)
        merged = F.sum(col) if run.kind == "count" else run._aggregate(col)
        carried[_CARRY + name] = merged.over(before)
    summary = totals.withColumns(carried).select(
        F.col(_PIECE).alias("__p"),
        *[F.col(g).alias(f"__g_{g}") for g in group],
        *[_CARRY + n for n in names],
    )
    on = F.col(_PIECE) == F.col("__p")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    joined = pieces.join(_sized(summary, most), on, "left")
    local_spec = Window.partitionBy(_PIECE, *group).orderBy(*order)
    results = {}
    for name in names:
        run = outs[name]
        local = run._aggregate(run._input()).over(_frame(local_spec, run.exclusive))
        results[name] = run._finish(run._combine(F.col(_CARRY + name), local))
    drop = [_PIECE, _POS, "__p", *[f"__g_{g}" for g in group], *[_CARRY + n for n in names]]
    return joined.withColumns(results).drop(*drop)


def running(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    outs: dict[str, Running],
    *,
    hot_rows: int | None = HOT_ROWS,
    piece_rows: int | None = None,
) -> DataFrame:
    """Add running values per ``group`` in ``order``.

    ``order`` must be total within a group (end it with a unique key) so that
    both plans give the same rows the same values. ``hot_rows=None`` skips the
    check for callers that know their groups are small.
    """
    group, order = list(group), list(order)
    if hot_rows is None:
        return _plain(df, group, order, outs)
    ordinary, hot, rows = split_hot(df, group, hot_rows)
    if hot is None:
        return _plain(df, group, order, outs)
    pieces = range_pieces(hot, group, order, rows, piece_rows or hot_rows)
    dealt = _pieced(pieces, group, order, outs, _summary_rows(rows, hot_rows, piece_rows or hot_rows))
    if not group:
        return dealt
    return _plain(ordinary, group, order, outs).unionByName(dealt)


def row_number(df: DataFrame, group: Sequence[str], order: Sequence[Column], out: str = "rank", **kw) -> DataFrame:
    """``row_number`` per group; ``group=[]`` gives the global rank."""
    return running(df, group, order, {out: Running("count")}, **kw)


def running_sum(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], value: str, out: str = "running_sum", **kw
) -> DataFrame:
    return running(df, group, order, {out: Running("sum", F.col(value))}, **kw)


def lag_lead(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
    *,
    hot_rows: int | None = HOT_ROWS,
    piece_rows: int | None = None,
) -> DataFrame:
    """Previous (``lag``) and next (``lead``) values, as ``{output: column}``."""
    group = list(group)
    forward = [F.col(c).asc_nulls_first() for c in order]
    backward = [F.col(c).desc_nulls_last() for c in order]

    def plain(part: DataFrame) -> DataFrame:
        spec = Window.partitionBy(*group).orderBy(*forward)
        cols = {o: F.lag(c).over(spec) for o, c in (lag or {}).items()}
        cols |= {o: F.lead(c).over(spec) for o, c in (lead or {}).items()}
        return part.withColumns(cols)

    if hot_rows is None:
        return plain(df)
    ordinary, hot, rows = split_hot(df, group, hot_rows)
    if hot is None:
        return plain(df)
    for names, ordering in ((lag, forward), (lead, backward)):
        if names:
            outs = {o: Running("last", F.col(c), exclusive=True) for o, c in names.items()}
            hot = _pieced(range_pieces(hot, group, ordering, rows, piece_rows or hot_rows), group, ordering, outs, _summary_rows(rows, hot_rows, piece_rows or hot_rows))
    return plain(ordinary).unionByName(hot) if group else hot


def ranked_share(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    *,
    measured: Column,
    counted: Column | None = None,
    rank: str = "rank",
    total: str = "total",
    share: str = "share",
    hot_rows: int | None = HOT_ROWS,
    piece_rows: int | None = None,
) -> DataFrame:
    """Rank the measured rows of each group and divide by the group total.

    Rows that are not ``measured`` keep a NULL rank and share but still count
    in the total; ``counted`` narrows the total to the rows it holds for.
    Ordinary groups take rank and total from one sorted pass; hot
    groups are ranked in pieces and read their total from the count that
    found them.
    """
    group = list(group)
    # Measured rows sort first, so their ranks are 1..k.
    flagged = df.withColumn("__m", F.coalesce(measured, F.lit(False)))
    full = [F.col("__m").desc(), *order]
    outs = {rank: Running("count")}
    size = F.count_if(F.lit(True) if counted is None else counted)

    def finish(ranked: DataFrame) -> DataFrame:
        ranked = ranked.withColumn(rank, F.when(F.col("__m"), F.col(rank)))
        return ranked.withColumn(share, F.col(rank) / F.col(total)).drop("__m")

    def plain(part: DataFrame) -> DataFrame:
        whole = size.over(Window.partitionBy(*group))
        return finish(_plain(part, group, full, outs).withColumn(total, whole))

    if hot_rows is None:
        return plain(flagged)
    ordinary, hot, rows = split_hot(flagged, group, hot_rows)
    if hot is None:
        return plain(flagged)
    pieces = range_pieces(hot, group, full, rows, piece_rows or hot_rows)
    totals = pieces.groupBy(*group).agg(size.alias(total))
    most = _summary_rows(rows, hot_rows, piece_rows or hot_rows)
    totals = totals.select(*[F.col(g).alias(f"__t_{g}") for g in group], total)
    totals = _sized(totals, most) if group else F.broadcast(totals)
    on = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__t_{g}")) for g in group], F.lit(True))
    dealt = _pieced(pieces, group, full, outs, most).join(totals, on, "left").drop(*[f"__t_{g}" for g in group])
    dealt = finish(dealt)
    return plain(ordinary).unionByName(dealt) if group else dealt


def quota_flags(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    tie: Sequence[str],
    quotas: Mapping[str, float],
    *,
    counted: Column | None = None,
    idle: int | None = None,
    hot_rows: int | None = HOT_ROWS,
    written: bool = False,
) -> DataFrame:
    """Whether a row's rank by (value, tie) over the group total lies below each quota, found by counting.

    Adds a boolean per quota: what ``ranked_share(...).share < quota`` gives,
    false where ``value`` is NULL, without ranking the rows. The rows are written
    once, unless the caller says that ``df`` is ``written``. Counts per group and value (combined before they are dealt) give the
    last value whose rows all lie below the quota and the one value that the
    quota cuts through. Only rows tied on that value are ordered, to find the
    last of them that still fits; every other row is compared with its group's
    values. Values up to ``idle`` are not cut: their rows are all flagged, for
    callers to whom they make no difference. ``tie`` must tell rows of a group
    and value apart, else tied rows stand or fall together. ``counted`` narrows
    the total as in :func:`ranked_share`.
    """
    group, names = list(group), list(df.columns)
    base = df.withColumn("__c", F.lit(True) if counted is None else F.coalesce(counted, F.lit(False)))
    base = base if written else materialise(base, "quota-rows")
    counts = base.groupBy(*group, value).agg(F.count(F.lit(1)).alias("__n"), F.count_if("__c").alias("__t"))
    whole = Window.partitionBy(*group)
    upto = whole.orderBy(F.col(value).asc_nulls_first())
    real = F.when(F.col(value).isNotNull(), F.col("__n")).otherwise(F.lit(0))
    summed = counts.withColumns({"__all": F.sum("__t").over(whole), "__end": F.sum(real).over(upto), "__own": real})
    cuts, n = [], F.col("__all")
    for i, quota in enumerate(quotas.values()):
        # The largest rank whose share, as a double, lies below the quota.
        near = F.floor(n * F.lit(float(quota)))
        last = F.when((near + 1) / n < quota, near + 1).when(near / n < quota, near).otherwise(near - 1)
        inside = F.col(value).isNotNull() & (F.col("__end") <= last)
        cut = (F.col("__own") > 0) & (F.col("__end") > last) & (F.col("__end") - F.col("__own") < last)
        if idle is not None:
            inside, cut = inside | (F.col(value) <= idle), cut & (F.col(value) > idle)
        cuts += [
            F.max(F.when(inside, F.col(value))).alias(f"__full{i}"),
            F.max(F.when(cut, F.col(value))).alias(f"__edge{i}"),
            F.max(F.when(cut, last - (F.col("__end") - F.col("__own")))).alias(f"__need{i}"),
            F.max(F.when(cut, F.col("__own"))).alias(f"__ties{i}"),
        ]
    limits = summed.groupBy(*group).agg(*cuts).select(*[F.col(g).alias(f"__g_{g}") for g in group], *[f"__{x}{i}" for i in range(len(quotas)) for x in ("full", "edge", "need", "ties")])
    limits = materialise(limits, "quota-limits")
    number = range(len(quotas))
    groups, *most = limits.agg(F.count(F.lit(1)), *[F.coalesce(F.max(f"__ties{i}"), F.lit(0)) for i in number]).first()
    on = all_equal(group, "__g_")
    if any(most):
        # The ties of all quotas in one pass; a row can be tied for several.
        fits = F.array_compact(F.array(*[F.when(F.col(value) == F.col(f"__edge{i}"), F.struct(F.lit(i).alias("i"), F.col(f"__need{i}").alias("need"))) for i in number]))
        tied = base.join(_sized(limits, groups), on).select(*dict.fromkeys([*group, *tie]), F.explode(fits).alias("__q"))
        order = [F.col(t).asc_nulls_first() for t in tie]
        tied = tied.select("*", F.col("__q.i").alias("__i"), F.col("__q.need").alias("__need")).drop("__q")
        ranked = row_number(tied, [*group, "__i"], order, "__r", hot_rows=None if hot_rows is None or max(most) <= hot_rows else hot_rows)
        last = ranked.where("__r = __need").groupBy(*[F.col(g).alias(f"__h_{g}") for g in group]).agg(*[F.max(F.when(F.col("__i") == i, F.struct(*tie))).alias(f"__last{i}") for i in number])
        same = reduce(lambda a, b: a & b, [F.col(f"__g_{g}").eqNullSafe(F.col(f"__h_{g}")) for g in group], F.lit(True))
        limits = limits.join(_sized(last, groups), same, "left")
    joined = base.join(_sized(limits, groups), on, "left")
    flags = {}
    for i, name in enumerate(quotas):
        flag = F.coalesce(F.col(value) <= F.col(f"__full{i}"), F.lit(False))
        if most[i]:
            flag = flag | F.coalesce((F.col(value) == F.col(f"__edge{i}")) & (F.struct(*tie) <= F.col(f"__last{i}")), F.lit(False))
        flags[name] = flag
    return joined.withColumns(flags).select(*names, *flags)


def all_equal(columns: Sequence[str], prefix: str) -> Column:
    """Columns equal to their prefixed namesakes, nulls together; true without columns."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(prefix + c)) for c in columns], F.lit(True))


def _sized(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a frame known to have at most ``rows`` rows where those are few; else the optimiser decides."""
    return F.broadcast(df) if rows <= BROADCAST_GROUPS else df


def top_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], keep: str = "last", columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the greatest (or smallest) by ``order``.

    ``columns`` names what is wanted besides the keys (all by default); other
    columns are dropped before anything is shuffled, except inside ``order``. A
    struct maximum combines map-side, so a hot key sends one row per map task;
    structs with texts have no fixed width, so both sides of the exchange sort
    by key. NULL order values count as the smallest.
    """
    wanted = [c for c in df.columns if c not in keys] if columns is None else [c for c in columns if c not in keys]
    parts = [F.col(o) if isinstance(o, str) else o for o in order]
    by = F.struct(*[p.alias(f"o{i}") for i, p in enumerate(parts)])
    payload = F.struct(*wanted) if wanted else F.struct(F.lit(0).alias("none"))
    pick = F.max_by if keep == "last" else F.min_by
    best = df.groupBy(*keys).agg(pick(payload, by).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.`{c}`").alias(c) for c in wanted]).select(*[c for c in df.columns if c in keys or c in wanted])
