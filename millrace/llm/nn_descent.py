"""Embedding near-duplicates by NN-descent.

A neighbour graph starts from random hyperplane groups and is refined by
joining the neighbours of each vector with one another. Lists that are full of
near-duplicates are saturated; they are enlarged to their whole component,
which is compared in blocks. Components with saturated lists are compared with
one another, as such lists have no room for links to another dense group. A sample compared with every vector audits the
recall; the graph is started wider until that is reached, and if it never is,
all vectors are compared in blocks. Only links whose
cosine in double precision reaches the threshold are kept.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import written
from millrace.llm.components import components

#: Neighbours in a list, hyperplane tables at first, vectors aimed at per group, most vectors compared in one piece.
NEIGHBOURS, TABLES, GROUP, PIECE = 8, 8, 64, 256
#: Vectors per block where whole components are compared.
BLOCK = 1024
#: Vectors audited against all; recall to reach; times the start may be widened.
AUDITED, RECALL, WIDENINGS = 2000, 0.999, 3
#: Half-precision cosines this much under the threshold are compared again in double precision.
SLACK = 0.01

PAIRS = "node bigint, other bigint, cosine float"


def _unit(values: list) -> np.ndarray | None:
    if values is None or any(v is None for v in values):
        return None
    x = np.array(values, np.float64)
    peak = np.abs(x).max(initial=0)
    if not np.isfinite(peak) or not peak:
        return None
    x = x / peak
    return x / math.sqrt(float(x @ x))


def unit_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, unit as doubles); unit is null where the vector links with nothing."""

    def run(batches):
        for batch in batches:
            units = [_unit(v) for v in batch.column("vector").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([None if u is None else u.astype("<f8").tobytes() for u in units], pa.binary())], ["vec_id", "unit"])

    return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).mapInArrow(run, "vec_id bigint, unit binary")


def _grouped(batches, keys: list[str]):
    """Rows of each group of a sorted stream, as dicts of lists."""
    held, now = None, None
    for batch in batches:
        rows = batch.to_pydict()
        group = list(zip(*(rows[k] for k in keys)))
        cuts = [0, *(i for i in range(1, len(group)) if group[i] != group[i - 1]), len(group)]
        for begin, end in zip(cuts, cuts[1:]):
            if begin == end:
                continue
            part = {k: v[begin:end] for k, v in rows.items()}
            if held is not None and group[begin] == now:
                for k, v in part.items():
                    held[k] += v
            else:
                if held is not None:
                    yield held
                held, now = part, group[begin]
            while len(held[keys[0]]) >= 2 * PIECE:  # a long group goes on in pieces
                yield {k: v[:PIECE] for k, v in held.items()}
                held = {k: v[PIECE:] for k, v in held.items()}
    if held is not None:
        yield held


def _best(nodes: np.ndarray, units: np.ndarray, least: np.ndarray, known: list, most: int):
    """For each vector of a piece its best others above ``least`` that it does not know."""
    cosine = units @ units.T
    cosine[nodes[:, None] == nodes[None, :]] = -2
    if known is not None:
        wide = max(1, max(len(k or ()) for k in known))
        own = np.array([[*(k or ()), *[-1] * (wide - len(k or ()))] for k in known])
        cosine[(own[:, :, None] == nodes[None, None, :]).any(1)] = -2
    cosine[cosine <= least[:, None]] = -2
    take = min(most, len(nodes) - 1)
    if take < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    at = np.argpartition(-cosine, take - 1, axis=1)[:, :take]
    value = np.take_along_axis(cosine, at, 1)
    i, j = np.nonzero(value > -2)
    return nodes[i], nodes[at[i, j]], value[i, j]


def _halves(units: list) -> np.ndarray:
    return np.frombuffer(b"".join(units), "<f2").reshape(len(units), -1).astype(np.float32)


def _emit(found) -> pa.RecordBatch:
    a, b, c = (np.concatenate(x) for x in zip(*found))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c.astype(np.float32))], ["node", "other", "cosine"])


def _start(nodes: DataFrame, dim: int, count: int, tables: int, seed: int, most: int) -> DataFrame:
    """Best pairs inside random hyperplane groups, several tables of them."""
    bits = max(1, math.ceil(math.log2(max(2, count / GROUP))))
    rng = np.random.default_rng(seed)
    planes = rng.standard_normal((tables, dim, bits + 1))

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            units = _halves(batch.column("half").to_pylist())
            for t in range(tables):
                side = units @ planes[t]
                code = ((side[:, :bits] > 0) << np.arange(bits)).sum(1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(units), t), pa.int32()), pa.array(code, pa.int64()), pa.array(side[:, bits]), batch.column("node"), batch.column("half")], ["t", "code", "side", "node", "half"])

    def compare(batches):
        found = []
        for group in _grouped(batches, ["t", "code"]):
            node, units = np.array(group["node"]), _halves(group["half"])
            for low in range(0, max(1, len(node) - PIECE // 2), PIECE // 2):  # overlapping pieces along one more direction
                part = slice(low, low + PIECE)
                found.append(_best(node[part], units[part], np.full(len(node[part]), -1.5), None, most))
            if len(found) > 200:
                yield _emit(found)
                found = []
        if found:
            yield _emit(found)

    placed = nodes.select("node", "half").mapInArrow(place, "t int, code bigint, side double, node bigint, half binary")
    return placed.repartition("t", "code").sortWithinPartitions("t", "code", "side", "node").mapInArrow(compare, PAIRS)


def _lists(pairs: DataFrame, most: int) -> DataFrame:
    """(node, list of (cosine, other) from the best down, at most ``most``)."""
    best = pairs.groupBy("node", "other").agg(F.max("cosine").alias("cosine"))
    ranked = F.sort_array(F.collect_list(F.struct("cosine", "other")), False)
    return best.groupBy("node").agg(F.slice(ranked, 1, most).alias("list"))


def _flat(lists: DataFrame) -> DataFrame:
    return lists.select("node", F.explode("list").alias("x")).select("node", F.col("x.other").alias("other"), F.col("x.cosine").alias("cosine"))


def _joined_neighbours(nodes: DataFrame, lists: DataFrame, most: int, full: float) -> DataFrame:
    """Better neighbours found among the neighbours, either way, of every vector.

    A list that is full of cosines from ``full`` on is saturated and gets no more here.
    """
    edges = _flat(lists).select("node", "other")
    around = edges.select(F.col("node").alias("centre"), F.col("other").alias("node")).union(edges.select(F.col("other").alias("centre"), "node")).distinct()
    last = F.element_at("list", -1)["cosine"]
    last = F.when(last >= full, F.lit(2.0)).otherwise(last)
    known = nodes.select("node", "half").join(lists, "node", "left")
    known = known.select("node", "half", F.col("list.other").alias("known"), F.when(F.size("list") >= most, last).otherwise(F.lit(-1.5)).cast("float").alias("least"))
    members = around.join(known, "node")

    def compare(batches):
        found = []
        for group in _grouped(batches, ["centre"]):
            if len(group["node"]) > 1:
                found.append(_best(np.array(group["node"]), _halves(group["half"]), np.array(group["least"]), group["known"], most))
            if len(found) > 500:
                yield _emit(found)
                found = []
        if found:
            yield _emit(found)

    return members.select("centre", "node", "half", "known", "least").repartition("centre").sortWithinPartitions("centre", "node").mapInArrow(compare, PAIRS)


def neighbour_graph(nodes: DataFrame, dim: int, count: int, enough: float, tables: int = TABLES, most: int = NEIGHBOURS, seed: int = 9, rounds: int = 8) -> DataFrame:
    """Written lists (node, list), refined until a round gains no neighbour with a cosine from ``enough`` on."""
    lists = written(_lists(_start(nodes, dim, count, tables, seed, most), most), "neighbours")
    for _ in range(rounds):
        better = written(_joined_neighbours(nodes, lists, most, enough + 2 * SLACK), "better")
        lists = written(_lists(_flat(lists).unionByName(better), most), "neighbours")
        if better.where(F.col("cosine") >= enough).isEmpty():
            break
    return lists


def _doubles(units: list) -> np.ndarray:
    return np.frombuffer(b"".join(units), "<f8").reshape(len(units), -1)


def threshold_links(nodes: DataFrame, lists: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a < b, of the graph whose cosine in double precision reaches the threshold."""
    near = _flat(lists).where(F.col("cosine") >= threshold - SLACK).select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    both = near.join(nodes.select(F.col("node").alias("a"), F.col("unit").alias("ua")), "a").join(nodes.select(F.col("node").alias("b"), F.col("unit").alias("ub")), "b")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                cosine = np.einsum("ij,ij->i", _doubles(batch.column("ua").to_pylist()), _doubles(batch.column("ub").to_pylist()))
                yield batch.select(["a", "b"]).filter(pa.array(cosine >= threshold))

    return both.select("a", "b", "ua", "ub").mapInArrow(run, "a bigint, b bigint")


def _whole_groups(batches, keys: list[str]):
    """(key, rows as a dict of lists) of each group of a sorted stream."""
    held, now = None, None
    for batch in batches:
        rows = batch.to_pydict()
        group = list(zip(*(rows[k] for k in keys)))
        cuts = [0, *(i for i in range(1, len(group)) if group[i] != group[i - 1]), len(group)]
        for begin, end in zip(cuts, cuts[1:]):
            if begin == end:
                continue
            part = {k: v[begin:end] for k, v in rows.items()}
            if held is not None and group[begin] == now:
                for k, v in part.items():
                    held[k] += v
                continue
            if held is not None:
                yield now, held
            held, now = part, group[begin]
    if held is not None:
        yield now, held


def _block_pairs(rows: DataFrame, blocks, key: str, *columns: str) -> DataFrame:
    """Rows by every pair (i, j) of blocks that their block is in: (i, j, block, columns)."""
    dealt = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64(key), F.col("blocks")).cast("int"))
    paired = dealt.withColumn("pair", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("block", o).alias("i"), F.greatest("block", o).alias("j")))))
    return paired.select(F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), "block", *columns)


def _component_counts(members: DataFrame, threshold: float) -> DataFrame:
    """(node, n): copies linked with each node among all of its component (root, node, unit, copies), in blocks."""
    sizes = members.groupBy("root").agg(F.count("*").alias("m"))
    # Every pair of blocks is a group of its own.
    rows = _block_pairs(members.join(sizes, "root"), F.ceil(F.col("m") / BLOCK).cast("int"), "node", "root", "node", "copies", "unit")

    def run(batches):
        for (_, i, j), rows in _whole_groups(batches, ["root", "i", "j"]):
            units, block, copies = _doubles(rows["unit"]), np.array(rows["block"]), np.array(rows["copies"])
            cosine = units @ units.T >= threshold
            np.fill_diagonal(cosine, False)
            if i != j:
                cosine &= block[:, None] != block[None, :]
            yield pa.RecordBatch.from_arrays([pa.array(rows["node"], pa.int64()), pa.array((cosine * copies[None, :]).sum(1))], ["node", "n"])

    return rows.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "node").mapInArrow(run, "node bigint, n bigint").groupBy("node").agg(F.sum("n").alias("n"))


def _angles(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def _between(members: DataFrame, threshold: float) -> DataFrame:
    """(a, b): groups of ``members`` (root, node, unit) with a link from one to the other. Exact.

    A group is represented by its root and the widest angle to a member. Two
    groups are compared, member by member in blocks, unless the angles rule a
    link out; of their members, those too far from the other root stay out.
    """
    reach, room = math.acos(threshold), 1e-6
    centres = members.where("node = root").select("root", F.col("unit").alias("centre"))

    def widths(batches):
        for batch in batches:
            if batch.num_rows:
                cosine = np.einsum("ij,ij->i", _doubles(batch.column("unit").to_pylist()), _doubles(batch.column("centre").to_pylist()))
                yield pa.RecordBatch.from_arrays([batch.column("root"), pa.array(_angles(cosine))], ["root", "width"])

    width = members.join(centres, "root").select("root", "unit", "centre").mapInArrow(widths, "root bigint, width double").groupBy("root").agg(F.max("width").alias("width"))
    groups = written(centres.join(width, "root"), "dense-groups")

    def near(batches):
        for (i, j), rows in _whole_groups(batches, ["i", "j"]):
            root, block, width, units = np.array(rows["root"]), np.array(rows["block"]), np.array(rows["width"]), _doubles(rows["centre"])
            hit = _angles(units @ units.T) <= width[:, None] + width[None, :] + reach + room
            hit &= root[:, None] < root[None, :]
            if i != j:
                hit &= block[:, None] != block[None, :]
            a, b = np.nonzero(hit)
            yield pa.RecordBatch.from_arrays([pa.array(root[a], pa.int64()), pa.array(root[b], pa.int64())], ["a", "b"])

    blocks = F.lit(max(1, -(-groups.count() // BLOCK)))
    paired = _block_pairs(groups, blocks, "root", "root", "width", "centre").repartition("i", "j").sortWithinPartitions("i", "j", "root")
    pairs = written(paired.mapInArrow(near, "a bigint, b bigint"), "near-groups")

    def close(batches):
        for batch in batches:
            if batch.num_rows:
                angle = _angles(np.einsum("ij,ij->i", _doubles(batch.column("unit").to_pylist()), _doubles(batch.column("centre").to_pylist())))
                yield batch.select(["a", "b", "side", "node", "unit"]).filter(pa.array(angle <= np.asarray(batch.column("width")) + reach + room))

    sides = None
    for side, (own, other) in enumerate((("a", "b"), ("b", "a"))):
        one = pairs.join(members.withColumnRenamed("root", own), own).join(groups.withColumnRenamed("root", other), other)
        one = one.select("a", "b", F.lit(side).alias("side"), "node", "unit", "centre", "width").mapInArrow(close, "a bigint, b bigint, side int, node bigint, unit binary")
        sides = one if sides is None else sides.union(one)
    sides = written(sides, "group-sides")
    parts = lambda side: F.ceil(F.sum((F.col("side") == side).cast("int")) / BLOCK).cast("int")
    sizes = sides.groupBy("a", "b").agg(parts(0).alias("m0"), parts(1).alias("m1")).where("m0 > 0 and m1 > 0")
    first = F.col("side") == 0
    own = F.pmod(F.xxhash64("node"), F.when(first, F.col("m0")).otherwise(F.col("m1"))).cast("int")
    dealt = sides.join(sizes, ["a", "b"]).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.when(first, F.col("m1")).otherwise(F.col("m0")) - 1)))
    dealt = dealt.select("a", "b", F.when(first, F.col("own")).otherwise(F.col("other")).alias("i"), F.when(first, F.col("other")).otherwise(F.col("own")).alias("j"), "side", "unit")

    def compare(batches):
        for (a, b, _, _), rows in _whole_groups(batches, ["a", "b", "i", "j"]):
            units, side = _doubles(rows["unit"]), np.array(rows["side"])
            if (units[side == 0] @ units[side == 1].T >= threshold).any():
                yield pa.RecordBatch.from_arrays([pa.array([a], pa.int64()), pa.array([b], pa.int64())], ["a", "b"])

    return dealt.repartition("a", "b", "i", "j").sortWithinPartitions("a", "b", "i", "j").mapInArrow(compare, "a bigint, b bigint").distinct()


def linked(nodes: DataFrame, lists: DataFrame, threshold: float, most: int) -> DataFrame:
    """Written (node, n, root): copies linked with a node that has links, and the smallest node it reaches."""
    links = written(threshold_links(nodes, lists, threshold), "vector-links")
    roots = components(links)
    full = lists.where((F.size("list") >= most) & (F.element_at("list", -1)["cosine"] >= threshold - SLACK)).select("node")
    # A full list without a link is a group of its own.
    roots = written(roots.union(full.join(roots, "node", "left_anti").select("node", F.col("node").alias("root"))), "vector-roots")
    dense = written(roots.join(full, "node", "left_semi").select("root").distinct(), "dense-roots")
    members = roots.join(dense, "root", "left_semi").join(nodes.select("node", "copies", "unit"), "node")
    tops = written(components(_between(members.select("root", "node", "unit"), threshold)).select(F.col("node").alias("root"), F.col("root").alias("top")), "dense-tops")
    topped = lambda x: x.join(tops, "root", "left").withColumn("root", F.coalesce("top", "root")).drop("top")
    weight = nodes.select(F.col("node").alias("other"), "copies")
    plain = links.union(links.select("b", "a")).toDF("node", "other").join(weight, "other").groupBy("node").agg(F.sum("copies").alias("n"))
    members = topped(members).select("root", "node", "copies", "unit")
    whole = _component_counts(members, threshold)
    n = plain.join(members.select("node"), "node", "left_anti").union(whole)
    return written(topped(roots).join(n, "node").select("node", "n", "root"), "linked")


def audited_recall(nodes: DataFrame, found: DataFrame, threshold: float, audited: int = AUDITED) -> float:
    """Share of the linked vectors of a hashed sample, compared with every vector, whose links were all found.

    Vectors with fewer links than a list holds and the others are measured on
    their own, so that a dense group cannot hide them; the lesser share counts.
    """
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(audited).select("node", "unit").toPandas()
    units, own = _doubles(sample["unit"].tolist()), sample["node"].to_numpy()

    def run(batches):
        total, others = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        for batch in batches:
            if batch.num_rows:
                hit = units @ _doubles(batch.column("unit").to_pylist()).T >= threshold
                hit &= own[:, None] != np.asarray(batch.column("node"))[None, :]
                others += hit.sum(1)
                total += (hit * np.asarray(batch.column("copies"))[None, :]).sum(1)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(total), pa.array(others)], ["node", "true", "others"])

    true = nodes.select("node", "copies", "unit").mapInArrow(run, "node bigint, true bigint, others bigint").groupBy("node").agg(F.sum("true").alias("true"), F.sum("others").alias("others")).where(F.col("true") > 0)
    whole = F.avg((F.coalesce("n", F.lit(0)) == F.col("true")).cast("int")).alias("whole")
    shares = true.join(found.select("node", "n"), "node", "left").groupBy(F.col("others") < NEIGHBOURS).agg(whole).collect()  # at most two rows
    return min((r["whole"] for r in shares), default=1.0)


def _all_linked(nodes: DataFrame, threshold: float) -> DataFrame:
    """Written (node, n, root) like ``linked``, by comparing all vectors in blocks. Exact; the work grows with the square."""
    blocks = F.lit(max(1, -(-nodes.count() // BLOCK)))
    rows = _block_pairs(nodes, blocks, "node", "node", "copies", "unit")

    def run(batches):
        for (i, j), rows in _whole_groups(batches, ["i", "j"]):
            units, block, copies, node = _doubles(rows["unit"]), np.array(rows["block"]), np.array(rows["copies"]), np.array(rows["node"])
            hit = units @ units.T >= threshold
            np.fill_diagonal(hit, False)
            if i != j:
                hit &= block[:, None] != block[None, :]
            n, left, links = (hit * copies[None, :]).sum(1), np.ones(len(node), bool), []
            for start in np.flatnonzero(n).tolist():  # links that join what is linked here
                stack = [start] if left[start] else []
                left[start] = False
                while stack:
                    at = stack.pop()
                    new = np.flatnonzero(hit[at] & left)
                    left[new] = False
                    links += [(at, x) for x in new.tolist()]
                    stack += new.tolist()
            a, b = (node[[x[k] for x in links]] if links else node[:0] for k in (0, 1))
            some = n > 0
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([node[some], a]), pa.int64()), pa.array(np.concatenate([n[some], np.zeros(len(a), np.int64)])), pa.array([None] * int(some.sum()) + b.tolist(), pa.int64())], ["node", "n", "other"])

    dealt = rows.repartition("i", "j").sortWithinPartitions("i", "j", "node").mapInArrow(run, "node bigint, n bigint, other bigint")
    dealt = written(dealt, "all-links")
    roots = components(dealt.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    return written(dealt.groupBy("node").agg(F.sum("n").alias("n")).join(roots, "node"), "linked")


def embedding_near_duplicates(df: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing and are kept. Vectors of different lengths do not link;
    those of each length are compared with one another. Equal vectors are one
    node with a number of copies, all linked. Null ids do not count as smallest;
    an empty table gives no rows; other columns are not read.
    """
    vectors = written(unit_vectors(df, id_col, vector_col).withColumn("row", F.monotonically_increasing_id()), "vectors")
    sizes = vectors.where("unit is not null").groupBy(F.octet_length("unit").alias("size")).count().orderBy(F.desc("count"), "size").collect()  # a row per length
    alone = vectors.where("unit is null")
    out = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    for k, r in enumerate(sizes):
        own = vectors.where(F.octet_length("unit") == r["size"])
        # What is rare and no larger than the audit's sample is compared as a whole at once.
        out = _of_one_length(own, r["size"], threshold, k > 0 and r["count"] <= AUDITED).union(out)
    return out


def _of_one_length(vectors: DataFrame, size: int, threshold: float, whole: bool) -> DataFrame:
    """The result rows for vectors of ``size`` bytes; ``whole``: all are compared in blocks, without a graph."""
    grouped = vectors.groupBy("unit").agg(F.min("row").alias("node"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))

    def half(batches):
        for batch in batches:
            units = [np.frombuffer(u, "<f8").astype("<f2").tobytes() for u in batch.column("unit").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("unit", "node", "copies", "least")), pa.array(units, pa.binary())], ["unit", "node", "copies", "least", "half"])

    nodes = written(grouped.mapInArrow(half, "unit binary, node bigint, copies bigint, least bigint, half binary"), "vector-nodes")
    count, tables = nodes.count(), TABLES
    for _ in range(0 if whole else WIDENINGS + 1):
        lists = neighbour_graph(nodes, size // 8, count, threshold - SLACK, tables)
        found = linked(nodes, lists, threshold, NEIGHBOURS)
        if audited_recall(nodes, found, threshold) >= RECALL:
            break
        tables *= 2
    else:
        found = _all_linked(nodes, threshold)
    each = nodes.join(found, "node", "left").select("node", "unit", "copies", "least", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("root", "node").alias("root"))
    classes = each.groupBy("root").agg(F.min("least").alias("component_id"))
    each = each.join(classes, "root").select("unit", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id")
    return vectors.select("vec_id", "unit").join(each, "unit").select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
