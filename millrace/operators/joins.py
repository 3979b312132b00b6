"""Joins the reports need beyond a plain equi-join.

Broadcasting is never forced on data that can grow: plain lookups are left to
the optimiser, which compares the measured size with its own threshold, and
rule tables are broadcast only below an explicit row bound.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.ordered import HOT_ROWS, Running, running
from millrace.session import materialise

# A rule or interval table above this many rows is joined by shuffle instead.
BROADCAST_ROWS = 100_000
# Spans of one key a probe may compare one by one.
SPANS_PER_KEY = 64


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True if ``df`` has at most ``rows`` rows; reads no more than it must."""
    return df.limit(rows + 1).count() <= rows


def hinted(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if is_small(df, rows) else df


def enrich(df: DataFrame, dim: DataFrame, on: dict[str, str], cols: dict[str, str]) -> DataFrame:
    """Left join ``dim`` on ``{fact column: dim column}``, adding ``{output: dim column}``.

    The dimension is reduced to the needed columns first, so its size estimate
    (which decides between broadcast and shuffle) is that of those columns.
    """
    keyed = dim.select(
        *[F.col(d).alias(f"__d_{d}") for d in on.values()],
        *[F.col(c).alias(out) for out, c in cols.items()],
    )
    cond = all_of([F.col(f) == F.col(f"__d_{d}") for f, d in on.items()])
    return df.join(keyed, cond, "left").drop(*[f"__d_{d}" for d in on.values()])


def not_in(df: DataFrame, key: str, other: DataFrame, other_key: str, null_aware: bool = True) -> DataFrame:
    """``key NOT IN (SELECT other_key ...)``.

    With ``null_aware`` a NULL on the other side empties the result and NULL
    keys are dropped unless the other side is empty, exactly like SQL. Without
    it the join is a plain anti join on non-NULL keys and NULL keys stay.

    The SQL form cannot be hashed by key in general (one NULL decides every
    row), so its two row-level facts are taken from a one-row aggregate and the
    rest stays an ordinary anti join.
    """
    keys = other.select(F.col(other_key).alias("__k"))
    kept = df.join(keys.filter(F.col("__k").isNotNull()).distinct(), df[key] == F.col("__k"), "left_anti")
    if not null_aware:
        return kept
    facts = keys.agg(
        F.count(F.lit(1)).alias("__n"),
        F.count_if(F.col("__k").isNull()).alias("__nulls"),
    )
    return (
        kept.crossJoin(F.broadcast(facts))
        .filter((F.col("__n") == 0) | ((F.col("__nulls") == 0) & F.col(key).isNotNull()))
        .drop("__n", "__nulls")
    )


def only_in(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """``key IN (SELECT other_key ...)`` as a semi join."""
    # Distinct combines map-side, so a key repeated very often stays cheap.
    keys = other.select(F.col(other_key).alias("__k")).filter(F.col("__k").isNotNull()).distinct()
    return df.join(keys, df[key] == F.col("__k"), "left_semi")


def key_list(df: DataFrame, key: str, keys: DataFrame, keys_col: str) -> DataFrame:
    """Rows whose key is listed; the list is a table, so its length is free."""
    listed = keys.select(F.col(keys_col).alias("__k")).filter(F.col("__k").isNotNull()).distinct()
    return df.join(listed, df[key] == F.col("__k"), "left_semi")


def full_outer(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_cols: dict[str, str], right_cols: dict[str, str]
) -> DataFrame:
    """Full outer join with coalesced keys; ``{output: column}`` per side.

    Give it sides with one row per key (aggregate first): a full join of
    repeated keys multiplies rows and cannot be split by adaptive execution.
    """
    a = left.select(*[F.col(k).alias(f"__l_{k}") for k in keys], *[F.col(c).alias(o) for o, c in left_cols.items()])
    b = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[F.col(c).alias(o) for o, c in right_cols.items()])
    joined = a.join(b, all_of([F.col(f"__l_{k}") == F.col(f"__r_{k}") for k in keys]), "full")
    return joined.select(
        *[F.coalesce(f"__l_{k}", f"__r_{k}").alias(k) for k in keys], *left_cols.keys(), *right_cols.keys()
    )


def rule_join(
    df: DataFrame,
    rules: DataFrame,
    *,
    equal: dict[str, str],
    wildcard: dict[str, str],
    between: tuple[str, str, str] | None = None,
    values: Sequence[str],
    rule_id: str,
) -> DataFrame:
    """Attach the values of the best matching rule, NULL when none matches.

    ``equal`` and ``wildcard`` map fact columns to rule columns; a NULL in a
    wildcard column matches anything. ``between`` is (fact time, rule start,
    rule end), both ends included. Among the matches the rule with the most
    filled wildcard columns wins, then the smallest ``rule_id``.

    A join condition with OR would compare every fact with every rule and
    repeat facts that match several. Where no equality key has more than
    ``RULES_PER_KEY`` rules they become one list per key, sorted from best to
    worst, and a fact takes the first entry that fits. Beyond that the rules are
    indexed, see :func:`rule_index`, and a fact looks up a few short lists by
    equality. Either way facts are read once and stay one row each, and the
    optimiser decides how the rule side travels.
    """
    tagged = rules.select(*[F.col(c).alias(f"__r_{c}") for c in rules.columns])
    keys = [f"__r_{r}" for r in equal.values()]
    per_key = tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    widest, number = per_key.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if widest > RULES_PER_KEY:
        return _indexed_rules(df, tagged, equal, wildcard, between, values, rule_id)
    filled = [F.when(F.col(f"__r_{r}").isNotNull(), 1).otherwise(0) for r in wildcard.values()]
    score = reduce(lambda a, b: a + b, filled, F.lit(0))
    entry = [(-score).alias("__score"), F.col(f"__r_{rule_id}").alias("__id")]
    entry += [F.col(f"__r_{r}").alias(f"__w_{r}") for r in wildcard.values()]
    if between:
        entry += [F.col(f"__r_{between[1]}").alias("__lo"), F.col(f"__r_{between[2]}").alias("__hi")]
    entry += [F.col(f"__r_{v}").alias(v) for v in values]
    # RULES_PER_KEY entries at most.
    lists = tagged.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*entry))).alias("__rules"))
    cond = all_of([F.col(f) == F.col(f"__r_{r}") for f, r in equal.items()])
    joined = df.join(F.broadcast(lists) if number <= BROADCAST_ROWS else lists, cond, "left")

    def fits(rule: Column) -> Column:
        tests = [rule[f"__w_{r}"].isNull() | (rule[f"__w_{r}"] == F.col(f)) for f, r in wildcard.items()]
        if between:
            t = F.col(between[0])
            tests.append((t >= rule["__lo"]) & (t <= rule["__hi"]))
        return all_of(tests)

    best = F.get(F.filter("__rules", fits), F.lit(0))
    return (
        joined.withColumn("__best", best)
        .withColumns({v: F.col(f"__best.{v}") for v in values})
        .drop("__best", "__rules", *keys)
    )


# Rules of one equality key that a fact may compare one by one.
RULES_PER_KEY = 64


def rule_index(tagged: DataFrame, keys: Sequence[str], wildcard: Sequence[str], between: tuple[str, str] | None, rule_id: str) -> DataFrame:
    """Rules as a search tree: (pattern, keys, wildcards, start, end, chunk, columns of the rule).

    A rule's pattern says which wildcard columns it fills, so inside a pattern
    a rule matches by equality alone, but for its time span. Per pattern and key
    the spans, both ends included, become disjoint segments that carry the
    smallest ``rule_id`` in force, found in one sweep; in one task per key, as
    rules are written by people. A key's segments are numbered in chunks of
    about the square root of their number.
    """
    pattern = reduce(lambda a, b: a + b, [F.when(F.col(w).isNotNull(), 1 << i).otherwise(0) for i, w in enumerate(wildcard)], F.lit(0))
    names = tagged.columns
    marked = tagged.withColumn("__pattern", pattern.cast("int"))
    if between:
        lo, hi = (F.unix_micros(F.col(b).cast("timestamp")) for b in between)
        marked = marked.withColumns({"__start": lo, "__end": hi + 1}).where("__start < __end")
    else:
        marked = marked.withColumns({"__start": F.lit(0).cast("bigint"), "__end": F.lit(1).cast("bigint")})

    def sweep(table: pa.Table) -> pa.Table:
        starts, ends = (table.column(c).to_pylist() for c in ("__start", "__end"))
        order = sorted(range(table.num_rows), key=lambda i: _first_null(table.column(rule_id)[i].as_py()))
        rank = {row: r for r, row in enumerate(order)}
        edges = sorted({*starts, *ends})
        opening = sorted(range(table.num_rows), key=starts.__getitem__)
        heap, at, found = [], 0, []
        for begin, end in zip(edges, edges[1:]):
            while at < len(opening) and starts[opening[at]] <= begin:
                heapq.heappush(heap, rank[opening[at]])
                at += 1
            while heap and ends[order[heap[0]]] <= begin:
                heapq.heappop(heap)
            if not heap:
                continue
            row = order[heap[0]]
            if found and found[-1][0] == row and found[-1][2] == begin:
                found[-1] = (row, found[-1][1], end)
            else:
                found.append((row, begin, end))
        size = max(1, math.isqrt(len(found) - 1) + 1)
        out = table.select([*names, "__pattern"]).take(pa.array([f[0] for f in found], pa.int64()))
        for name, column in (("__start", [f[1] for f in found]), ("__end", [f[2] for f in found]), ("__chunk", [i // size for i in range(len(found))])):
            out = out.append_column(name, pa.array(column, pa.int64()))
        return out

    fields = [marked.schema[n] for n in [*names, "__pattern"]] + [T.StructField(n, T.LongType()) for n in ("__start", "__end", "__chunk")]
    return marked.groupBy("__pattern", *keys, *wildcard).applyInArrow(sweep, T.StructType(fields))


def _first_null(value):
    return (value is not None, value)


def _indexed_rules(df, tagged, equal, wildcard, between, values, rule_id) -> DataFrame:
    """Facts by way of :func:`rule_index`: per pattern two equality joins, of the chunk and of its segments."""
    keys, wild = [f"__r_{r}" for r in equal.values()], [f"__r_{r}" for r in wildcard.values()]
    spans = (f"__r_{between[1]}", f"__r_{between[2]}") if between else None
    index = materialise(rule_index(tagged, keys, wild, spans, f"__r_{rule_id}"), "rule-index")
    patterns = sorted((r[0] for r in index.select("__pattern").distinct().collect()), key=lambda p: -p.bit_count())
    t = F.unix_micros(F.col(between[0]).cast("timestamp")) if between else F.lit(0).cast("bigint")
    out, found = df.withColumn("__t", t), []
    for p in patterns:
        own = [*keys, *[w for i, w in enumerate(wild) if p >> i & 1]]
        facts = [*equal, *[f for i, f in enumerate(wildcard) if p >> i & 1]]
        rows = index.where(F.col("__pattern") == p)
        entry = F.struct("__start", "__end", F.lit(-p.bit_count()).alias("score"), F.col(f"__r_{rule_id}").alias("id"), *[F.col(f"__r_{v}").alias(f"v_{v}") for v in values])
        segments = rows.groupBy(*own, "__chunk").agg(F.array_sort(F.collect_list(entry)).alias(f"__segments{p}"), F.min("__start").alias("__from"))
        tops = segments.groupBy(*own).agg(F.array_sort(F.collect_list("__from")).alias(f"__starts{p}"))
        tops = tops.select(*[F.col(c).alias(f"__a{p}_{i}") for i, c in enumerate(own)], f"__starts{p}")
        leaves = segments.select(*[F.col(c).alias(f"__b{p}_{i}") for i, c in enumerate(own)], F.col("__chunk").alias(f"__c{p}"), f"__segments{p}")
        out = out.join(tops, all_of([F.col(f) == F.col(f"__a{p}_{i}") for i, f in enumerate(facts)]), "left")
        out = out.withColumn(f"__at{p}", F.size(F.filter(f"__starts{p}", lambda s: s <= F.col("__t"))).cast("bigint") - 1)
        out = out.join(leaves, all_of([F.col(f) == F.col(f"__b{p}_{i}") for i, f in enumerate(facts)] + [F.col(f"__at{p}") == F.col(f"__c{p}")]), "left")
        hit = F.get(F.filter(f"__segments{p}", lambda s: (s["__start"] <= F.col("__t")) & (s["__end"] > F.col("__t"))), F.lit(0))
        out = out.withColumn(f"__hit{p}", F.when(hit.isNotNull(), F.struct(hit["score"].alias("score"), hit["id"].alias("id"), *[hit[f"v_{v}"].alias(f"v_{v}") for v in values])))
        out = out.drop(*[f"__{x}{p}_{i}" for x in "ab" for i in range(len(own))], f"__starts{p}", f"__segments{p}", f"__at{p}", f"__c{p}")
        found.append(f"__hit{p}")
    if not found:
        return df.withColumns({v: F.lit(None).cast(tagged.schema[f"__r_{v}"].dataType) for v in values})
    best = F.array_min(F.array_compact(F.array(*found)))
    out = out.withColumn("__best", best).withColumns({v: F.col(f"__best.v_{v}") for v in values})
    return out.drop("__best", "__t", *found)


# Bits of the nested time block widths, from one second up to about 34 years.
BLOCK_BITS = tuple(range(0, 31, 2))


def _point_blocks(seconds: Column) -> Column:
    """The block of each width that contains an instant."""
    return F.array(
        *[
            F.struct(F.lit(level).alias("level"), F.shiftright(seconds, bits).alias("block"))
            for level, bits in enumerate(BLOCK_BITS)
        ]
    )


def _span_blocks(lo: Column, hi: Column) -> Column:
    """Disjoint blocks that together cover the instants ``lo <= t < hi``.

    At every width the aligned middle is left to the next width and only the
    two ragged ends stay, so an interval becomes at most 6 blocks per width
    whatever its length, and no instant is covered twice.
    """

    def inner(bits: int) -> tuple[Column, Column]:
        return F.shiftright(lo + F.lit((1 << bits) - 1), bits), F.shiftright(hi, bits)

    parts = []
    for level, bits in enumerate(BLOCK_BITS):
        first, last = inner(bits)
        if level + 1 == len(BLOCK_BITS):
            parts.append(_blocks(level, first, last))
            continue
        wider = BLOCK_BITS[level + 1]
        wide_first, wide_last = inner(wider)
        passed_on = wide_first < wide_last
        head_stop = F.when(passed_on, F.shiftleft(wide_first, wider - bits)).otherwise(last)
        tail_start = F.when(passed_on, F.shiftleft(wide_last, wider - bits)).otherwise(last)
        parts += [_blocks(level, first, head_stop), _blocks(level, tail_start, last)]
    return F.concat(*parts)


def _blocks(level: int, start: Column, stop: Column) -> Column:
    none = F.array().cast("array<struct<level:int,block:bigint>>")
    run = F.sequence(start, F.greatest(stop - 1, start), F.lit(1).cast("bigint"))
    made = F.transform(run, lambda b: F.struct(F.lit(level).alias("level"), b.alias("block")))
    return F.when(start < stop, made.cast("array<struct<level:int,block:bigint>>")).otherwise(none)


def interval_join(
    points: DataFrame,
    spans: DataFrame,
    *,
    on: dict[str, str],
    at: str,
    start: str,
    end: str,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Inner join of ``points`` with the spans valid at ``at``: start <= at < end.

    A small span table with few spans per key is broadcast and filtered on the
    fly. In a larger one the keys with few spans are joined by key: a point
    compares at most ``SPANS_PER_KEY`` of them and no row is repeated. Only the
    spans of the other keys are cut into disjoint time blocks of a few fixed
    widths; a point of such a key looks up the one block per width that holds
    it. That turns the range condition into an equality, so a key with many
    points and many spans never compares all pairs: a row pair meets once, in
    the block that both share. The spans are written once, as their size is
    looked at before they are joined.
    """
    span_cols, per_key_cols = spans.columns, [f"__s_{s}" for s in on.values()]
    tagged = materialise(spans.select(*[F.col(c).alias(f"__s_{c}") for c in span_cols]), "spans")
    cond = [F.col(p) == F.col(f"__s_{s}") for p, s in on.items()]
    inside = (F.col(at) >= F.col(f"__s_{start}")) & (F.col(at) < F.col(f"__s_{end}"))
    shared = [c for c in span_cols if c not in points.columns]
    keep = [*[F.col(c) for c in points.columns], *[F.col(f"__s_{c}").alias(c) for c in shared]]
    per_key = tagged.groupBy(*per_key_cols).agg(F.count(F.lit(1)).alias("__n"))
    widest, number = per_key.agg(F.coalesce(F.max("__n"), F.lit(0)), F.coalesce(F.sum("__n"), F.lit(0))).first()
    if widest <= SPANS_PER_KEY:
        few = F.broadcast(tagged) if number <= broadcast_rows else tagged
        return points.join(few, all_of(cond) & inside, "inner").select(*keep)
    wide = materialise(per_key.filter(F.col("__n") > SPANS_PER_KEY).select(*[F.col(c).alias(f"__w{c}") for c in per_key_cols]), "wide-keys")
    in_wide = all_of([F.col(c) == F.col(f"__w{c}") for c in per_key_cols])
    probing = all_of([F.col(p) == F.col(f"__w__s_{s}") for p, s in on.items()])
    # A point finds the spans of a key by key, whatever their number, so only spans need the split here.
    by_key = points.join(tagged.join(wide, in_wide, "left_anti"), all_of(cond) & inside, "inner").select(*keep)
    # Whole seconds decide the block; the exact condition settles the rest.
    lo = F.unix_seconds(F.col(f"__s_{start}").cast("timestamp"))
    hi = F.unix_seconds(F.col(f"__s_{end}").cast("timestamp")) + 1
    blocked = tagged.join(wide, in_wide, "left_semi").filter(F.col(f"__s_{start}") < F.col(f"__s_{end}"))
    blocked = blocked.withColumn("__b", F.explode(_span_blocks(lo, hi)))
    widths = [r[0] for r in blocked.select("__b.level").distinct().collect()]
    probes = F.filter(
        _point_blocks(F.unix_seconds(F.col(at).cast("timestamp"))), lambda b: b["level"].isin(widths or [-1])
    )
    probed = points.join(wide, probing, "left_semi").withColumn("__q", F.explode(probes))
    cond += [F.col("__q.level") == F.col("__b.level"), F.col("__q.block") == F.col("__b.block")]
    return by_key.unionByName(probed.join(blocked, all_of(cond) & inside, "inner").select(*keep))


def coverage(
    points: DataFrame,
    spans: DataFrame,
    *,
    on: dict[str, str],
    at: str,
    start: str,
    end: str,
    registered: DataFrame | None = None,
    out: str = "coverage",
    labels: tuple[str, str, str] = ("valid", "present_not_valid", "absent"),
    hot_rows: int | None = HOT_ROWS,
    piece_rows: int | None = None,
) -> DataFrame:
    """Label each point: a span is valid at its time, only exists, or is absent.

    Points and span starts share one ordering per key. A point is covered when
    the latest end among the spans started so far lies after it, so overlapping
    spans need no pairing and each point stays one row. ``registered`` lists
    every known key (by default the keys of ``spans``). The spans are written
    once, as the sweep looks at the size of its groups first.
    """
    keys = list(on)
    cols = points.columns
    spans = materialise(spans.select(*dict.fromkeys([*on.values(), start, end])), "spans")
    known = (spans if registered is None else registered).select(*[F.col(s).alias(p) for p, s in on.items()])
    data = points.select(
        *[F.col(k) for k in keys],
        F.col(at).cast("timestamp").alias("__t"),
        F.lit(1).alias("__kind"),
        F.lit(None).cast("timestamp").alias("__end"),
        F.struct(*cols).alias("__row"),
    )
    opens = spans.select(
        *[F.col(s).alias(p) for p, s in on.items()],
        F.col(start).cast("timestamp").alias("__t"),
        F.lit(0).alias("__kind"),
        F.col(end).cast("timestamp").alias("__end"),
        F.lit(None).cast(data.schema["__row"].dataType).alias("__row"),
    ).filter(F.col("__t") < F.col("__end"))
    order = [F.col("__t").asc_nulls_first(), F.col("__kind").asc()]
    both = data.unionByName(opens)
    # Rows that tie on (time, kind) see the same spans, except that span starts
    # at one instant may come in any order: none of them is a point.
    swept = running(
        both, keys, order, {"__open": Running("max", F.col("__end"))}, hot_rows=hot_rows, piece_rows=piece_rows
    ).filter(F.col("__kind") == 1)
    known = known.distinct().select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.lit(True).alias("__known"))
    joined = swept.join(known, all_of([F.col(k) == F.col(f"__k_{k}") for k in keys]), "left")
    label = (
        F.when(F.col("__open") > F.col("__t"), labels[0])
        .when(F.col("__known"), labels[1])
        .otherwise(labels[2])
    )
    return joined.select(*[F.col(f"__row.`{c}`").alias(c) for c in cols], label.alias(out))


def consecutive(
    df: DataFrame, key: Sequence[str], number: str, carry: dict[str, str], how: str = "inner"
) -> DataFrame:
    """Pair each attempt with the next one (``number + 1``) of the same key."""
    nxt = df.select(
        *[F.col(k).alias(f"__n_{k}") for k in key],
        F.col(number).alias("__n_number"),
        *[F.col(c).alias(out) for out, c in carry.items()],
    )
    cond = all_of([F.col(k) == F.col(f"__n_{k}") for k in key] + [F.col(number) + 1 == F.col("__n_number")])
    return df.join(nxt, cond, how).drop("__n_number", *[f"__n_{k}" for k in key])
