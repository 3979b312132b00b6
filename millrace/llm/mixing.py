"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong
to). A flow routes the words of the patterns to the quotas of the sources; the
first use of a word is free, each repetition costs more. The flow is solved on
the driver: its size is the number of patterns and sources, never of documents.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.batches import written

#: Cost of the first, second and third use of a word.
USE_COSTS = (0, 1, 3)
#: Patterns that the driver's flow may have.
MOST_PATTERNS = 100_000
#: Slots of the seeded order in which the documents of a pattern are added up.
SLOTS = 4096
#: Documents added to a pattern one by one behind the seeded order.
FINISHING = 4

WORD = r"[^\x20\x09-\x0D]+"


def capped_targets(sizes: list[int], weights: list[int], times: int = len(USE_COSTS)) -> list[Fraction]:
    """Shares of the total by weight, none above ``times`` its size; the excess goes to the others by weight."""
    total, out, open_ = Fraction(sum(sizes)), [Fraction(0)] * len(sizes), set(range(len(sizes)))
    while open_ and total > 0:
        weight = sum(weights[i] for i in open_)
        over = {i for i in open_ if total * weights[i] > times * sizes[i] * weight}
        if not over:
            for i in open_:
                out[i] = total * weights[i] / weight
            break
        for i in over:
            out[i] = Fraction(times * sizes[i])
            total -= out[i]
        open_ -= over
    return out


def min_cost_flow(supplies: list[int], members: list[list[int]], demands: list[int], costs: tuple[int, ...] = USE_COSTS) -> list[dict[int, int]]:
    """Words of each pattern that go to each of its sources, by cheapest augmenting paths.

    ``supplies[p]`` words may be used ``len(costs)`` times; ``demands[s]`` is met
    as far as the patterns with source s reach.
    """
    n, m = len(supplies), len(demands)
    end, graph = n + m + 1, [[] for _ in range(n + m + 2)]

    def edge(a, b, room, cost):
        graph[a].append([b, room, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    for p in range(n):
        for cost in costs:
            edge(0, 1 + p, supplies[p], cost)
        for s in members[p]:
            edge(1 + p, 1 + n + s, supplies[p] * len(costs), 0)
    for s in range(m):
        edge(1 + n + s, end, demands[s], 0)
    height = [0] * len(graph)
    while True:
        far, back = [None] * len(graph), [None] * len(graph)
        far[0], heap = 0, [(0, 0)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for i, (b, room, cost, _) in enumerate(graph[a]):
                if room > 0 and (far[b] is None or d + cost + height[a] - height[b] < far[b]):
                    far[b], back[b] = d + cost + height[a] - height[b], (a, i)
                    heapq.heappush(heap, (far[b], b))
        if far[end] is None:
            break
        height = [h + (f if f is not None else 0) for h, f in zip(height, far)]
        path, b = [], end
        while b:
            a, i = back[b]
            path.append(graph[a][i])
            b = a
        room = min(e[1] for e in path)
        for e in path:
            e[1] -= room
            graph[e[0]][e[3]][1] += room
    return [{e[0] - 1 - n: graph[e[0]][e[3]][1] for e in graph[1 + p] if e[0] > n and e[0] != end and graph[e[0]][e[3]][1]} for p in range(n)]


def mix(df: DataFrame, sources, size, weights: tuple[int, ...] = (1, 2, 3), id_col: str = "doc_id", seed: int = 6, passing: tuple[str, ...] = ()) -> tuple[DataFrame, dict]:
    """Rows (doc_id, size, sources, taken[, passing]) and what was planned for the sources.

    ``sources``: column expression, array of text (null members count as one
    source, last in order); a row without any is in none and taken 0 times.
    ``size``: column expression, whole number (null: 0). Source i in code-point
    order has the weight ``weights[i % len(weights)]``. The plan is a dict of
    source -> (size, target as float, words routed). A pattern takes every
    document a whole number of times and, in seeded order, some once more,
    until its words are reached; up to ``FINISHING`` further documents that fit
    bring the sum nearer. Equal seeds give equal mixes; rows alike in id, size and sources
    are told apart by their place only.
    """
    rows = df.select(
        F.monotonically_increasing_id().alias("row__"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(size.cast("long"), F.lit(0).cast("long")).alias("size"),
        F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>")))).alias("sources"),
        *(F.col(c).alias(f"passed {c}") for c in passing),
    ).withColumn("order__", F.xxhash64(F.lit(seed), "doc_id", "size"))
    rows = written(rows, "mix")
    found = rows.groupBy("sources").agg(F.sum("size").alias("n")).limit(MOST_PATTERNS + 1).collect()
    if len(found) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns")
    found = sorted(((tuple(r["sources"]), r["n"]) for r in found), key=lambda x: [(s is None, s or "") for s in x[0]])
    names = sorted({s for pattern, _ in found for s in pattern}, key=lambda s: (s is None, s or ""))
    number = {s: i for i, s in enumerate(names)}
    sizes = [sum(n for pattern, n in found if s in pattern) for s in names]
    targets = capped_targets(sizes, [weights[i % len(weights)] for i in range(len(names))])
    flows = min_cost_flow([n for _, n in found], [[number[s] for s in pattern] for pattern, _ in found], [int(t) for t in targets])
    routed = [sum(f.get(i, 0) for f in flows) for i in range(len(names))]
    spark = df.sparkSession
    plan = spark.createDataFrame([(list(p), sum(f.values()) // n if n else 0, sum(f.values()) % n if n else 0) for (p, n), f in zip(found, flows)], "sources array<string>, whole__ bigint, rest__ bigint")
    # Patterns meet by a hash of their text form, as arrays with nulls do not equal themselves.
    key = F.to_json(F.struct(F.col("sources").alias("s")), {"ignoreNullFields": "false"})
    plan = F.broadcast(plan.select(key.alias("key__"), "whole__", "rest__"))  # MOST_PATTERNS rows at most
    slots = rows.withColumn("key__", key).withColumn("slot__", F.pmod("order__", F.lit(SLOTS)))
    sums = slots.groupBy("key__", "slot__").agg(F.sum("size").alias("n"))
    upto = sums.withColumn("before__", F.sum("n").over(Window.partitionBy("key__").orderBy("slot__")) - F.col("n")).join(plan, "key__")
    # The slot in which the words are reached, the only one whose documents are ordered.
    edge = upto.where((F.col("before__") <= F.col("rest__")) & (F.col("before__") + F.col("n") > F.col("rest__"))).select("key__", F.col("slot__").alias("edge__"), "before__")
    edge = F.broadcast(edge)  # a row per pattern at most
    placed = slots.join(plan, "key__", "left").join(edge, "key__", "left")
    inside = placed.where(F.col("slot__") == F.col("edge__"))
    running = F.sum("size").over(Window.partitionBy("key__").orderBy("size", "order__", "doc_id", "row__"))
    chosen = written(inside.select("row__", "key__", "size", (F.col("before__") + running).alias("sum__"), "rest__").where("sum__ <= rest__").select("row__", "key__", "size"), "mix-edge")
    reached = written(edge.join(chosen.groupBy("key__").agg(F.sum("size").alias("n")), "key__", "left").select("key__", (F.col("before__") + F.coalesce("n", F.lit(0))).alias("sum__")), "mix-sums")
    picked = placed.join(chosen.select("row__", F.lit(True).alias("picked__")), "row__", "left")
    picked = picked.withColumn("more__", (F.col("rest__") > 0) & (F.col("edge__").isNull() | (F.col("slot__") < F.col("edge__")) | F.coalesce("picked__", F.lit(False))))
    # Further documents that still fit, the largest first, and at last one that brings the sum nearer.
    last = None
    for step in range(FINISHING):
        open_ = picked.join(F.broadcast(reached), "key__").where(~F.col("more__") & (F.col("size") > 0))
        if last is not None:
            open_ = open_.join(last.select("row__"), "row__", "left_anti")
        gap = F.col("rest__") - F.col("sum__")
        open_ = open_.withColumn("off__", gap - F.col("size"))
        fit = open_.where("off__ >= 0") if step + 1 < FINISHING else open_.withColumn("off__", F.abs("off__")).where(F.col("off__") < gap)
        best = fit.groupBy("key__").agg(F.min(F.struct("off__", "order__", "doc_id", "row__", "size")).alias("best"))
        best = written(best.select("key__", "best.row__", "best.size"), "mix-last")
        reached = written(reached.join(best.select("key__", F.col("size").alias("n")), "key__", "left").select("key__", (F.col("sum__") + F.coalesce("n", F.lit(0))).alias("sum__")), "mix-sums")
        last = best if last is None else last.union(best)
    last = F.broadcast(last.select("row__", F.lit(True).alias("last__")))  # FINISHING rows per pattern at most
    times = F.coalesce("whole__", F.lit(0)) + F.when(F.col("more__") | F.coalesce("last__", F.lit(False)), 1).otherwise(0)
    mixed = picked.join(last, "row__", "left").select("doc_id", "size", "sources", (F.col("size") * times).alias("taken"), times.alias("times"), *(F.col(f"passed {c}").alias(c) for c in passing))
    return mixed, {s: (sizes[i], float(targets[i]), routed[i]) for s, i in number.items()}


def word_count(text):
    """Words of a text column (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0))


def mix_by_source(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, taken): every row's words, its source's words and target, the words taken."""
    mixed, plan = mix(df, F.array(F.col(source_col).cast("string")), word_count(F.col(text_col)), id_col=id_col)
    known = df.sparkSession.createDataFrame([(s, n, t) for s, (n, t, _) in plan.items()], "s string, source_size bigint, target double")
    joined = mixed.join(F.broadcast(known), F.col("sources")[0].eqNullSafe(F.col("s")), "left")  # MOST_PATTERNS sources at most
    return joined.select("doc_id", "size", "source_size", "target", "taken")
