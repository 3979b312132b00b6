"""Assignment of items to working days with a daily capacity.

Items are taken in order of (eligible day, order columns). An item goes to the
current day if it still fits; otherwise the day closes and the item opens the
next working day. If the queue has drained, the day jumps to the item's own
eligible day. An item larger than the capacity gets a day to itself.

The chain is sequential, but it need not run in one task:

* A lane that fits one task is folded there. For the few longer ones the totals
  per (lane, eligible day) give an upper bound on the day by which
  the queue has drained: a day closed by an overflow holds at least capacity
  minus the largest item, plus one. Where the bound lies before the next
  eligible day, the queue provably starts afresh, so the lane is cut there.
  Neighbouring segments are packed up to a bounded number of items, and each
  pack is folded in one task.
* A segment that stays overloaded for more than that bound is cut into chunks
  of one eligible day each, large days into several. Inside a chunk the
  eligible day is constant, so the only thing the past contributes is how full
  the current day is on entry. One task per chunk computes the *transfer*: for
  every entry fill, how many days are opened and how full the last one ends.
  The fill is a whole number of pages, so this step function has at most
  capacity + 1 steps, and chains that start at different items soon meet, so
  it is usually a handful of rows. Transfers compose to transfers: where the
  queue drains inside a stretch, what comes out does not depend on what went in
  (a fuller entry never leads to an earlier exit, so all entries that drain
  leave alike), else days and fills add up. They are composed in a tree of
  bounded fan-in and entry states are handed down the same tree, so no task
  reads all chunks of a segment; a last parallel pass deals out the days.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.functions.calendar import WorkCalendar
from millrace.operators.joins import all_of
from millrace.operators.ordered import split_hot
from millrace.session import materialise

# Items one task folds; a pack or chunk holds at most about twice as many, chunks more where MAX_PIECES binds.
CHUNK_ITEMS = 1_000_000
# Range pieces of the overloaded segments beyond which pieces grow, up to CHUNK_ITEMS each.
MAX_PIECES = 500
# Transfers that one task composes.
FAN_IN = 256
_CHUNK = "__chunk"
_SEGMENT = "__segment"
_PACK = "__pack"
_ELIGIBLE = "__w"
_PAGES = "__pages"
_AT = "__at"
_RANK = "__rank"


def _openers(pages: np.ndarray, capacity: int) -> np.ndarray:
    """For each item as the first of a day: the first item of the next day."""
    total = np.concatenate([[0], np.cumsum(pages)])
    nxt = np.searchsorted(total, total[:-1] + capacity, side="right") - 1
    # A day keeps its first item with pages even if that alone is too large.
    places = np.arange(len(pages))
    first_real = np.where(pages > 0, places, len(pages))
    first_real = np.minimum.accumulate(first_real[::-1])[::-1]
    return np.minimum(np.maximum(nxt, first_real + 1), len(pages))


def _exits(pages: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(days opened, fill at the end) when a day starts at each item."""
    n = len(pages)
    nxt = _openers(pages, capacity)
    tail = np.cumsum(pages[::-1])[::-1]
    # Pointer doubling: follow the chain of day openers to the end of the chunk.
    hop = np.append(nxt, n)
    days = np.append(np.where(nxt < n, 1, 0), 0)
    last = np.append(np.where(nxt < n, nxt, np.arange(n)), n)
    while True:
        moved = hop < n
        if not moved.any():
            break
        days = days + np.where(moved, days[np.minimum(hop, n)], 0)
        last = np.where(moved, last[np.minimum(hop, n)], last)
        hop = np.where(moved, hop[np.minimum(hop, n)], n)
    return days[:n], tail[last[:n]]


def _transfer(pages: np.ndarray, capacity: int) -> list[tuple[int, int, int, int]]:
    """Step function of one chunk: rows ``(from fill, opened, end fill, slope)``.

    A row applies to entry fills from ``from fill`` up to the next row. With
    slope 1 everything still fits and the end fill is entry fill + ``end fill``.
    Fill 0 means that no day is open yet.
    """
    days, fill = _exits(pages, capacity)
    # Entering with nothing: the first item opens the day.
    rows = [(0, int(days[0]), int(fill[0]), 0)]
    total = np.cumsum(pages)
    # Entry fill u first overflows at the first item i with u + total[i] > capacity.
    first_fit = capacity - total  # item i still fits for u <= first_fit[i]
    low = 1
    n = len(pages)
    if first_fit[-1] >= low:
        rows.append((low, 0, int(total[-1]), 1))
        low = int(first_fit[-1]) + 1
    # Items in reverse give rising thresholds; keep only real changes. Only items
    # that an open day can still reach matter.
    reach = int(np.searchsorted(total, capacity, side="left"))
    for i in range(min(reach, n - 1), -1, -1):
        upper = capacity if i == 0 else int(min(first_fit[i - 1], capacity))
        if upper < low:
            continue
        row = (low, int(days[i]) + 1, int(fill[i]), 0)
        if rows[-1][1:] != row[1:]:
            rows.append(row)
        low = upper + 1
        if low > capacity:
            break
    # A day filled beyond its capacity (an oversize item) takes nothing more.
    row = (capacity + 1, int(days[0]) + 1, int(fill[0]), 0)
    if rows[-1][1:] != row[1:]:
        rows.append(row)
    return rows


# A transfer of a stretch of chunks: rows (from fill, least day, opened, end fill, slope)
# and the (day, fill) that comes out if the queue drains inside. A row applies to entry
# fills from its first number on if the entry day is not below its least day; below it
# the queue drains.
Transfer = tuple[list[tuple[int, int, int, int, int]], tuple[int, int]]


def _stretch(steps: Sequence[tuple[int, int, int, int]], eligible: int) -> Transfer:
    """Transfer of one chunk, whose items are eligible from one day on."""
    _, opened, fill, _ = steps[0]
    return [(low, eligible, o, f, s) for low, o, f, s in steps], (eligible + opened, fill)


def _through(transfer: Transfer, at: int, used: int) -> tuple[int, int]:
    """(day, fill) behind a stretch for an entry day and fill."""
    rows, drained = transfer
    _, least, opened, fill, slope = rows[bisect.bisect_right(rows, (used, math.inf)) - 1]
    return (at + opened, fill + slope * used) if at >= least else drained


def _then(first: Transfer, second: Transfer) -> Transfer:
    """Transfer of two stretches, one after the other."""
    out: list[tuple[int, int, int, int, int]] = []

    def add(low, least, opened, fill, slope):
        if not out or out[-1][1:] != (least, opened, fill, slope):
            out.append((low, least, opened, fill, slope))

    rows, later = first[0], second[0]
    for i, (low, least, opened, fill, slope) in enumerate(rows):
        if not slope:
            _, t, o, f, s = later[bisect.bisect_right(later, (fill, math.inf)) - 1]
            add(low, max(least, t - opened), opened + o, f + s * fill, 0)
            continue
        end = rows[i + 1][0] + fill if i + 1 < len(rows) else math.inf
        for j, (start, t, o, f, s) in enumerate(later):
            stop = later[j + 1][0] if j + 1 < len(later) else math.inf
            if start < end and stop > low + fill:
                add(max(low, start - fill), max(least, t - opened), opened + o, f + s * fill, s)
    return out, _through(second, *first[1])


def _step(rows: Sequence[tuple[int, int, int, int]], used: int) -> tuple[int, int]:
    """(days opened, fill at the end) for an entry fill."""
    _, opened, fill, slope = [row for row in rows if row[0] <= used][-1]
    return opened, fill + (used if slope else 0)


def _deal(pages: np.ndarray, capacity: int, used: int) -> np.ndarray:
    """Day offset of each item for an entry fill (0 = the entry day)."""
    n = len(pages)
    nxt = _openers(pages, capacity)
    if used == 0:
        start = int(nxt[0])
    else:
        start = int(np.searchsorted(np.cumsum(pages), capacity - used, side="right"))
    marks = np.zeros(n, dtype=np.int64)
    while start < n:
        marks[start] = 1
        start = int(nxt[start])
    return np.cumsum(marks)


def _fold(eligible: np.ndarray, pages: np.ndarray, capacity: int, at: int | None, used: int) -> np.ndarray:
    """Working-day number of each item; one step per opened day, not per item."""
    n = len(pages)
    total = np.concatenate([[0], np.cumsum(pages)])
    real = np.minimum.accumulate(np.where(pages > 0, np.arange(n), n)[::-1])[::-1]
    out = np.empty(n, dtype=np.int64)
    starts = np.flatnonzero(np.diff(eligible, prepend=eligible[0] - 1))
    for first, end in zip(starts, np.append(starts[1:], n)):
        if at is None or eligible[first] > at:
            at, used = int(eligible[first]), 0
        i = int(first)
        while i < end:
            stop = int(np.searchsorted(total, total[i] + capacity - used, side="right")) - 1
            stop = max(stop, i) if used > 0 else max(stop, int(real[i]) + 1)
            stop = min(stop, int(end))
            out[i:stop] = at
            used += int(total[stop] - total[i])
            i = stop
            if i < end:
                at, used = at + 1, 0
    return out


def _sorted(table: pa.Table, cols: Sequence[str]) -> pa.Table:
    keys = [(c, "ascending") for c in cols]
    return table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_start"))


def _numbers(table: pa.Table, col: str) -> np.ndarray:
    return table.column(col).to_numpy().astype(np.int64)


def _with_result(table: pa.Table, at: np.ndarray, rank: np.ndarray, names: Sequence[str]) -> pa.Table:
    kept = table.select(list(names))
    return kept.append_column(_AT, pa.array(at, pa.int32())).append_column(_RANK, pa.array(rank, pa.int64()))


def assign_days(
    df: DataFrame,
    calendar: WorkCalendar,
    *,
    eligible: str,
    order: Sequence[str],
    pages: str,
    capacity: int,
    lane: Sequence[str] = (),
    state: DataFrame | None = None,
    day: str = "assigned_day",
    rank: str = "rank",
    chunk_items: int = CHUNK_ITEMS,
    null_pages: int | None = 0,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """Add the assigned working day and the rank of every item.

    With ``key``, columns that identify an item in its lane, only lane, key, order,
    eligible day and pages go through the Python workers, and the results are
    joined back by lane and key; without it every column of ``df`` goes through.

    ``order`` must identify an item within its eligible day. ``state`` is the
    result of :func:`last_state` of an earlier run (lane columns, ``last_day``,
    ``used_pages``, ``last_rank``); new items then continue that day and rank.
    A lane without a state row starts afresh, so an empty state is like none;
    two rows for one lane fail the job.

    Items without an eligible day stay, without day and rank. Items without
    pages are taken as ``null_pages`` (0 by default) where that is a number and
    fail the job where it is None.
    """
    if key is not None:
        keys = [*lane, *[k for k in key if k not in lane]]
        slim = df.select(*dict.fromkeys([*keys, *order, eligible, pages]))
        dealt = assign_days(slim, calendar, eligible=eligible, order=order, pages=pages, capacity=capacity, lane=lane, state=state, day=day, rank=rank, chunk_items=chunk_items, null_pages=null_pages)
        found = dealt.select(*[F.col(k).alias(f"__k_{k}") for k in keys], day, rank)
        return df.join(found, all_of([F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])).select(*df.columns, day, rank)
    lane, names = list(lane), list(df.columns)
    p = F.col(pages).cast("bigint")
    counted = F.coalesce(p, F.lit(null_pages).cast("bigint")) if null_pages is not None else F.coalesce(p, F.raise_error(F.lit(f"an item has no {pages}")).cast("bigint"))
    # Every date has a number. The filter tests the date, as the optimiser would repeat the
    # whole calendar expression in a filter on the number: one method too long to be compiled.
    dated = F.col(eligible).cast("date").isNotNull()
    undated = df.filter(~dated).select(*names, F.lit(None).cast("date").alias(day), F.lit(None).cast("bigint").alias(rank))
    numbered = {_ELIGIBLE: calendar.index(calendar.next_workday(eligible)).cast("int"), _PAGES: counted}
    base = df.filter(dated).withColumns(numbered)
    pages = _PAGES
    entry = None
    if state is not None:
        state = _one_per_lane(state, lane)
        entry = state.select(
            *[F.col(c).alias(f"__l_{c}") for c in lane],
            calendar.index("last_day").cast("int").alias("__day0"),
            F.col("used_pages").cast("bigint").alias("__used0"),
            F.col("last_rank").cast("bigint").alias("__rank0"),
        )
        # An item that became eligible before the last used day joins that day.
        clamped = _lane_join(base, entry, lane)
        base = clamped.withColumn(_ELIGIBLE, F.greatest(_ELIGIBLE, "__day0")).drop("__day0", "__used0", "__rank0")
    # Lanes that fit one task need no plan; the long ones are few.
    short, long, _ = split_hot(base, lane, chunk_items)
    done = _fold_lanes(short, entry, lane, order, names, pages, capacity)
    if long is not None:
        done = done.unionByName(_assign_long(long, entry, lane, order, names, pages, capacity, chunk_items))
    # Working-day numbers back to dates by arithmetic: no calendar table, no last year.
    return done.select(*names, calendar.nth_workday(_AT).alias(day), F.col(_RANK).alias(rank)).unionByName(undated)


def _one_per_lane(state: DataFrame, lane: Sequence[str]) -> DataFrame:
    """The state rows; a lane with several fails when they are read."""
    wanted = ["last_day", "used_pages", "last_rank"]
    grouped = state.groupBy(*lane).agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in wanted]).filter("__n > 0")
    several = F.raise_error(F.lit("several state rows for one lane"))
    return grouped.select(*lane, *[F.when(F.col("__n") == 1, F.col(c)).otherwise(several.cast(state.schema[c].dataType)).alias(c) for c in wanted])


def _assign_long(
    base: DataFrame, entry: DataFrame | None, lane: list[str], order: Sequence[str], names: list[str], pages: str, capacity: int, chunk_items: int
) -> DataFrame:
    packs = _packs(base, entry, lane, pages, capacity, chunk_items)
    known = packs.select(
        *[F.col(c).alias(f"__p_{c}") for c in [*lane, _ELIGIBLE]], _SEGMENT, _PACK, "__heavy", "__base", "__day0", "__used0"
    )
    on = all_of([F.col(c).eqNullSafe(F.col(f"__p_{c}")) for c in [*lane, _ELIGIBLE]])
    items = base.join(known, on, "inner").drop(*[f"__p_{c}" for c in [*lane, _ELIGIBLE]])
    done = _fold_packs(items.filter(~F.col("__heavy")), [*lane, _PACK], order, names, pages, capacity)
    if packs.filter("__heavy").limit(1).count():
        heavy = items.filter("__heavy")
        done = done.unionByName(_deal_chunks(heavy, lane, order, names, pages, capacity, chunk_items))
    return done


def _fold_lanes(
    base: DataFrame, entry: DataFrame | None, lane: list[str], order: Sequence[str], names: list[str], pages: str, capacity: int
) -> DataFrame:
    """Lanes of bounded size, one task each, from the saved state if any."""
    if entry is None:
        null = F.lit(None)
        ready = base.withColumns({"__day0": null.cast("int"), "__used0": F.lit(0).cast("bigint"), "__base": F.lit(0).cast("bigint")})
    else:
        ready = _lane_join(base, entry, lane).withColumn("__base", F.coalesce("__rank0", F.lit(0)))
        ready = ready.withColumn("__used0", F.coalesce("__used0", F.lit(0)))
    return _fold_packs(ready, lane, order, names, pages, capacity)


def _lane_join(df: DataFrame, known: DataFrame, lane: Sequence[str]) -> DataFrame:
    if not lane:
        # One row at most; none leaves the items as they are.
        return df.join(F.broadcast(known), F.lit(True), "left")
    cond = all_of([F.col(c).eqNullSafe(F.col(f"__l_{c}")) for c in lane])
    return df.join(known, cond, "left").drop(*[f"__l_{c}" for c in lane])


def _packs(base: DataFrame, entry: DataFrame | None, lane: list[str], pages: str, capacity: int, chunk_items: int) -> DataFrame:
    """One row per (lane, eligible day): its segment, pack and first rank.

    Works on daily totals, so the windows see at most one row per calendar day
    of a lane.
    """
    p = F.col(pages)
    totals = base.groupBy(*lane, _ELIGIBLE).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(p).cast("bigint").alias("pages"),
        F.max(F.when(p <= capacity, p)).alias("largest"),
        F.count_if(p > capacity).alias("oversize"),
    )
    if entry is None:
        null = F.lit(None)
        totals = totals.withColumns({"__day0": null.cast("int"), "__used0": null.cast("bigint"), "__rank0": null.cast("bigint")})
    else:
        totals = _lane_join(totals, entry, lane)
    whole = Window.partitionBy(*lane)
    by_day = whole.orderBy(_ELIGIBLE)
    upto = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    least = F.greatest(F.lit(capacity + 1) - F.coalesce(F.max("largest").over(whole), F.lit(0)), F.lit(1)).cast("bigint")
    first = F.row_number().over(by_day) == 1
    carried = F.when(first, F.coalesce("__used0", F.lit(0))).otherwise(F.lit(0))
    load = F.col("pages") + F.col("oversize") * 2 * F.col("__least") + carried
    work = (
        totals.withColumn("__least", least)
        .withColumn("__load", load)
        .withColumn("__sum", F.sum("__load").over(upto))
        .withColumn("__peak", F.max(F.col(_ELIGIBLE) * F.col("__least") - (F.col("__sum") - F.col("__load"))).over(upto))
        .withColumn("__until", F.call_function("div", F.col("__peak") + F.col("__sum"), F.col("__least")))
    )
    fresh = F.coalesce(F.col(_ELIGIBLE) > F.lag("__until").over(by_day), F.lit(True))
    marked = work.withColumn(_SEGMENT, F.sum(fresh.cast("int")).over(upto)).withColumn("__before", F.sum("n").over(upto) - F.col("n"))
    in_segment = Window.partitionBy(*lane, _SEGMENT)
    sized = marked.withColumn("__size", F.sum("n").over(in_segment)).withColumn("__start", F.min("__before").over(in_segment))
    heavy = F.col("__size") > chunk_items
    packed = sized.withColumn("__heavy", heavy).withColumn(
        _PACK, F.when(heavy, F.lit(-1).cast("bigint")).otherwise(F.call_function("div", F.col("__start"), F.lit(chunk_items).cast("bigint")))
    )
    group = Window.partitionBy(*lane, "__heavy", F.when(heavy, F.col(_SEGMENT)).otherwise(F.col(_PACK)))
    # Only the first group of a lane continues the saved day.
    leads = F.min("__before").over(group) == 0
    return packed.withColumns(
        {
            "__base": F.min("__before").over(group) + F.coalesce("__rank0", F.lit(0)),
            "__day0": F.when(leads, F.col("__day0")),
            "__used0": F.when(leads, F.coalesce("__used0", F.lit(0))).otherwise(F.lit(0)),
        }
    )


def _result_schema(df: DataFrame, names: Sequence[str]) -> T.StructType:
    fields = [df.schema[n] for n in names]
    return T.StructType([*fields, T.StructField(_AT, T.IntegerType()), T.StructField(_RANK, T.LongType())])


def _fold_packs(items: DataFrame, group: list[str], order: Sequence[str], names: list[str], pages: str, capacity: int) -> DataFrame:
    by = [_ELIGIBLE, *order]

    def fold(table: pa.Table) -> pa.Table:
        table = _sorted(table, by)
        day0 = table.column("__day0")[0].as_py()
        used0 = table.column("__used0")[0].as_py()
        at = _fold(_numbers(table, _ELIGIBLE), _numbers(table, pages), capacity, day0, used0)
        rank = np.arange(1, table.num_rows + 1) + table.column("__base")[0].as_py()
        return _with_result(table, at, rank, names)

    return items.groupBy(*group).applyInArrow(fold, _result_schema(items, names))


def _deal_chunks(
    items: DataFrame, lane: list[str], order: Sequence[str], names: list[str], pages: str, capacity: int, chunk_items: int
) -> DataFrame:
    """Overloaded segments: transfers per chunk, entry states, final pass."""
    keys = [*lane, _SEGMENT, _ELIGIBLE]
    chunks = _chunks(items, keys, order, chunk_items)
    by_chunk = [*keys, _CHUNK]

    def summarise(table: pa.Table) -> pa.Table:
        table = _sorted(table, order)
        eligible = int(table.column(_ELIGIBLE)[0].as_py())
        stretch = _stretch(_transfer(_numbers(table, pages), capacity), eligible)
        return _packed(table.select([*by_chunk, *_CARRIED]).slice(0, 1), [stretch], [table.num_rows], [eligible])

    slim = chunks.select(*dict.fromkeys([*by_chunk, *_CARRIED, *order, pages]))
    transfers = materialise(slim.groupBy(*by_chunk).applyInArrow(summarise, _packed_schema([chunks.schema[c] for c in [*by_chunk, *_CARRIED]])), "transfers")
    entries = _entry_states(transfers, lane, by_chunk).select(*[F.col(c).alias(f"__e_{c}") for c in by_chunk], "__day", "__used", "__before")
    on = all_of([F.col(c).eqNullSafe(F.col(f"__e_{c}")) for c in by_chunk])
    ready = chunks.join(entries, on, "inner")

    def deal(table: pa.Table) -> pa.Table:
        table = _sorted(table, order)
        day, used, before = (table.column(c)[0].as_py() for c in ("__day", "__used", "__before"))
        at = _deal(_numbers(table, pages), capacity, used) + day
        return _with_result(table, at, np.arange(1, table.num_rows + 1) + before, names)

    return ready.groupBy(*by_chunk).applyInArrow(deal, _result_schema(items, names))


# Start of the segment, the same in all its chunks.
_CARRIED = ["__base", "__day0", "__used0"]
_STEPS = ("low", "least", "opened", "fill", "slope")


def _packed_schema(fields: Sequence[T.StructField]) -> T.StructType:
    lists = [T.StructField(n, T.ArrayType(T.LongType())) for n in _STEPS]
    return T.StructType([*fields, *lists, *[T.StructField(n, T.LongType()) for n in ("drained_at", "drained_fill", "items", "first")]])


def _packed(keys: pa.Table, transfers: Sequence[Transfer], items: Sequence[int], first: Sequence[int]) -> pa.Table:
    """Transfers as rows beside their keys."""
    for i, name in enumerate(_STEPS):
        keys = keys.append_column(name, pa.array([[row[i] for row in rows] for rows, _ in transfers], pa.list_(pa.int64())))
    for name, values in (("drained_at", [d[0] for _, d in transfers]), ("drained_fill", [d[1] for _, d in transfers]), ("items", items), ("first", first)):
        keys = keys.append_column(name, pa.array(values, pa.int64()))
    return keys


def _unpacked(table: pa.Table) -> list[Transfer]:
    steps = zip(*[table.column(n).to_pylist() for n in _STEPS])
    return [(list(zip(*lists)), (at, fill)) for lists, at, fill in zip(steps, table.column("drained_at").to_pylist(), table.column("drained_fill").to_pylist())]


def _handing_down(names: Sequence[str]):
    """Entry states of a node's children from its own, which stands in every row."""

    def run(table: pa.Table) -> pa.Table:
        table = _sorted(table, ["first", _CHUNK])
        at, used, before = (int(table.column(c)[0].as_py()) for c in ("__day", "__used", "__before"))
        states = []
        for transfer, first, n in zip(_unpacked(table), table.column("first").to_pylist(), table.column("items").to_pylist()):
            # Items that become eligible later open their own day.
            states.append((first, 0, before) if first > at else (at, used, before))
            (at, used), before = _through(transfer, at, used), before + n
        out = table.select(list(names))
        for i, (name, kind) in enumerate((("__day", pa.int32()), ("__used", pa.int64()), ("__before", pa.int64()))):
            out = out.append_column(name, pa.array([s[i] for s in states], kind))
        return out

    return run


def _entry_states(transfers: DataFrame, lane: list[str], by_chunk: list[str]) -> DataFrame:
    """(chunk keys, __day, __used, __before): the state in which each chunk is entered.

    Transfers are composed by number of the range piece, then by ``FAN_IN`` of
    those and so on up to one per segment; from its start the entry states are
    handed down again. A task holds the transfers of one node's children.
    """
    segment, widest = [*lane, _SEGMENT], transfers.agg(F.max(_CHUNK)).first()[0] or 0
    nodes, width = [transfers], 1
    while True:
        children = nodes[-1].withColumn("__node", F.floor(F.col(_CHUNK) / width).cast("int"))
        keys = [children.schema[c] for c in [*segment, "__node", *_CARRIED]]

        def compose(table: pa.Table) -> pa.Table:
            table = _sorted(table, ["first", _CHUNK])
            together = _unpacked(table)
            whole = reduce(_then, together)
            head = table.select([*segment, "__node", *_CARRIED]).slice(0, 1)
            return _packed(head, [whole], [sum(table.column("items").to_pylist())], [table.column("first")[0].as_py()])

        parents = children.groupBy(*segment, "__node").applyInArrow(compose, _packed_schema(keys))
        # A parent stands where its first chunk would.
        nodes.append(materialise(parents.withColumn(_CHUNK, F.col("__node") * width), "transfers"))
        if widest < width:
            break
        width *= FAN_IN
    began = F.col("__day0").isNotNull()
    entered = nodes[-1].select(
        *segment, "__node", F.coalesce("__day0", "first").cast("int").alias("__day"), F.when(began, F.col("__used0")).otherwise(F.lit(0)).cast("bigint").alias("__used"),
        F.col("__base").cast("bigint").alias("__before"),
    )
    for children in reversed(nodes[:-1]):
        names = by_chunk if children is transfers else [*segment, "__node"]
        grouped = children.withColumn("__in", F.floor(F.col(_CHUNK) / width).cast("int"))
        above = entered.select(*[F.col(c).alias(f"__a_{c}") for c in [*segment, "__node"]], "__day", "__used", "__before")
        on = all_of([F.col(c).eqNullSafe(F.col(f"__a_{c}")) for c in segment] + [F.col("__in") == F.col("__a___node")])
        joined = grouped.join(above, on).drop(*[f"__a_{c}" for c in [*segment, "__node"]])
        fields = [children.schema[c] for c in names] + [T.StructField("__day", T.IntegerType()), T.StructField("__used", T.LongType()), T.StructField("__before", T.LongType())]

        entered = joined.groupBy(*segment, "__in").applyInArrow(_handing_down(names), T.StructType(fields))
        width = max(1, width // FAN_IN)
    return entered


def _chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_items: int) -> DataFrame:
    """Number the chunks of every (lane, segment, eligible day).

    Range partitioning on the full order cuts every day into contiguous runs
    that fit one task. The cut is written out, because its boundaries come from
    a sample and both passes must see the same ones.
    """
    cols = [F.col(c).asc_nulls_first() for c in order]
    pieces = _pieces(df.count(), chunk_items)
    ranged = df.repartitionByRange(pieces, *[F.col(k).asc_nulls_first() for k in keys], *cols)
    return materialise(ranged.withColumn(_CHUNK, F.spark_partition_id()), "chunks")


def _pieces(items: int, chunk_items: int) -> int:
    """Number of range pieces: two per ``chunk_items``, but beyond ``MAX_PIECES`` only what keeps a piece within ``CHUNK_ITEMS``.

    An exchange has files and messages per pair of tasks, so small chunks of a
    large table would cost its square.
    """
    wanted, least = (math.ceil(items / size) * 2 for size in (chunk_items, max(chunk_items, CHUNK_ITEMS)))
    return max(2, least, min(wanted, MAX_PIECES))


def last_state(assigned: DataFrame, *, pages: str, lane: Sequence[str] = (), day: str = "assigned_day", rank: str = "rank") -> DataFrame:
    """State to resume from: last used day, pages used on it and last rank."""
    per_day = assigned.groupBy(*lane, day).agg(F.sum(pages).cast("bigint").alias("p"), F.max(rank).alias("r"))
    return per_day.groupBy(*lane).agg(
        F.max(day).alias("last_day"),
        F.max_by("p", day).alias("used_pages"),
        F.max("r").alias("last_rank"),
    )


def daily_load(assigned: DataFrame, *, pages: str, lane: Sequence[str] = (), day: str = "assigned_day") -> DataFrame:
    return assigned.groupBy(*lane, day).agg(
        F.sum(pages).cast("bigint").alias("pages"), F.count(F.lit(1)).alias("items")
    )


def mode_dates(df: DataFrame, key: str, value: str, *, nulls: bool = True) -> DataFrame:
    """Most frequent and second most frequent date per key.

    Counts come first (map-side combined), so what is ranked is one row per
    (key, date): calendar-sized, whatever the number of items. Ties go to the
    earlier date, NULL last.
    """
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    if not nulls:
        counts = counts.filter(F.col(value).isNotNull())
    spec = Window.partitionBy(key).orderBy(F.desc("n"), F.asc_nulls_last(value))
    ranked = counts.withColumn("rk", F.rank().over(spec)).withColumn("dense", F.dense_rank().over(spec))
    return ranked.groupBy(key).agg(
        F.max(F.when(F.col("rk") == 1, F.col(value))).alias("first_date"),
        F.max(F.when(F.col("rk") == 1, F.col("n"))).alias("first_count"),
        F.max(F.when(F.col("dense") == 2, F.col(value))).alias("second_date"),
    )


def over_grace(days: Column, grace: int = 2) -> Column:
    """Days beyond the grace, NULL when there are none."""
    return F.when(days - grace > 0, days - grace)
