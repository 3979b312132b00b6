"""Best-fit packing by exact complements over the histogram of lengths.

Lengths are at most the capacity, so their histogram is bounded. It is planned
on the driver as patterns (lengths of one sequence, how often); the pieces
themselves are numbered per length and placed by Spark.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.batches import row_slices, written
from millrace.llm.tokens import ENCODED_BYTES, text_ids

#: Pieces of one length that are numbered together.
LOT_ROWS = 1_000_000


def _times(have: np.ndarray, parts: tuple[int, ...]) -> int:
    """How often the parts can be taken together."""
    return min(int(have[p]) // parts.count(p) for p in parts)


def _complement(have: np.ndarray, sums: np.ndarray, length: int, gap: int) -> tuple[int, ...] | None:
    """One, two or three lengths that with ``length`` fill the capacity; the largest first."""
    have[length] -= 1
    try:
        if have[gap]:
            return (gap,)
        top = min(gap, len(have) - 1)
        for first in [gap, *(np.flatnonzero(have[: gap + 1])[::-1].tolist())]:
            # The first round looks for pairs, the others for the pairs beside ``first``.
            whole = first == gap
            rest = gap if whole else gap - first
            if rest < 2 or (not whole and (rest > 2 * first or not sums[rest])):
                continue
            a = np.arange(min(top, rest - 1 if whole else min(first, rest - 1)), (rest + 1) // 2 - 1, -1)
            for x in a[(have[a] > 0) & (have[rest - a] > 0)].tolist():
                parts = (x, rest - x) if whole else (first, x, rest - x)
                if _times(have, parts):
                    return parts
        return None
    finally:
        have[length] += 1


def plan(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, times) that use every piece; ``histogram[l]``: pieces of length l, the capacity last.

    From the longest down, a length takes the single, pair or triple sum that
    fills its gap exactly, as often as there are such pieces. What finds no
    complement goes by best fit, longest first, into the smallest gap.
    """
    cap, have = len(histogram) - 1, histogram.astype(np.int64).copy()
    have[0] = 0
    out: list[tuple[tuple[int, ...], int]] = []
    if have[cap]:
        out.append(((cap,), int(have[cap])))
        have[cap] = 0
    some = (have > 0).astype(np.float64)
    sums = np.rint(np.convolve(some, some))[: cap + 1] > 0  # lengths that are the sum of two
    for length in range(cap - 1, 0, -1):
        while have[length]:
            parts = _complement(have, sums, length, cap - length)
            if parts is None:
                break
            parts = (length, *parts)
            times = _times(have, parts)
            for p in parts:
                have[p] -= times
            out.append((parts, times))
    open_: dict[int, list[list]] = defaultdict(list)  # by gap: [lengths, times]
    for length in range(cap, 0, -1):
        left = int(have[length])
        while left:
            gap = min((g for g, x in open_.items() if g >= length and x), default=None)
            if gap is None:
                each = min(cap // length, left)
                open_[cap - each * length].append([(length,) * each, left // each])
                left %= each
                continue
            parts, times = open_[gap].pop()
            each = min(gap // length, left)
            used = min(times, left // each)
            if times > used:
                open_[gap].append([parts, times - used])
            open_[gap - each * length].append([parts + (length,) * each, used])
            left -= used * each
    return out + [(parts, times) for x in open_.values() for parts, times in x if times]


def pieces(df: DataFrame, tokenizer: str, end_id: int, cap: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): texts as ids with ``end_id``, cut only beyond ``cap`` ids.

    Of a longer text all pieces but the first are full. Null text is empty.
    """

    def run(batches):
        for rows in row_slices(batches, "text", ENCODED_BYTES):
            ids, counts = text_ids(tokenizer).encode(rows.column("text"))
            data = np.insert(ids, np.cumsum(counts), end_id).astype("<u4").tobytes()
            counts = counts + 1
            many = -(-counts // cap)
            first = counts - (many - 1) * cap
            number = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            length = np.where(number == 0, np.repeat(first, many), cap)
            start = np.where(number == 0, 0, np.repeat(first, many) + (number - 1) * cap)
            cuts = [0, *np.cumsum(length * 4).tolist()]
            crc = [zlib.crc32(data[b:e]) for b, e in zip(cuts, cuts[1:])]
            docs = rows.column("doc_id").take(pa.array(np.repeat(np.arange(len(counts)), many)))
            row = rows.column("row").take(pa.array(np.repeat(np.arange(len(counts)), many)))
            yield pa.RecordBatch.from_arrays([row, docs, pa.array(number, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], ["row", "doc_id", "piece", "start", "length", "ids_crc32"])

    slim = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "row bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(table: DataFrame, cap: int, length_col: str = "length", keys: tuple[str, ...] = ("row", "piece")) -> DataFrame:
    """``table`` with sequence_id and offset, its rows in as few sequences of ``cap`` as the plan finds.

    ``table`` is read several times: pass a written one. ``keys`` tell its rows
    apart. Lengths run from 1 to ``cap``; others raise. An empty table stays empty.
    """
    sizes = table.groupBy(F.col(length_col).alias("l")).agg(F.count("*").alias("n"))
    counted = sizes.toPandas()  # a row per length
    if len(counted) and not counted["l"].between(1, cap).all():
        raise ValueError(f"lengths must lie between 1 and {cap}")
    counts = np.zeros(cap + 1, np.int64)
    counts[counted["l"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    whole, counts[cap] = int(counts[cap]), 0
    dealt = np.maximum(1, -(-counts // LOT_ROWS))
    lot, first = F.lit(0), np.concatenate([[0], np.cumsum(dealt)])
    before = np.zeros(int(first[-1]), np.int64)
    pieces_left = table.where(F.col(length_col) < cap)
    if (dealt > 1).any():
        many = F.get(F.split(F.lit(",".join(map(str, dealt.tolist()))), ",").cast("array<int>"), F.col(length_col).cast("int"))
        lot = F.pmod(F.xxhash64(*keys), many).cast("int")
        each = np.zeros(len(before), np.int64)
        for row in pieces_left.groupBy(F.col(length_col).alias("l"), lot.alias("lot")).agg(F.count("*").alias("n")).collect():  # a row per lot
            each[first[row["l"]] + row["lot"]] = row["n"]
        before = np.cumsum(each) - each
        before -= np.repeat(before[first[:-1]], dealt)
    lots = pieces_left.withColumn("lot__", lot)
    made = plan(counts)
    used, sequence, slots = np.zeros(cap + 1, np.int64), 0, []
    for parts, times in made:
        offset = 0
        for p in parts:
            slots.append((p, int(used[p]), sequence, offset))
            used[p] += times
            offset += p
        sequence += times
    slots.sort()
    slot = np.array(slots, np.int64).reshape(-1, 4)
    key = slot[:, 0] << 44 | slot[:, 1]

    def run(batches):
        for batch in batches:
            size, lot, rank = (np.asarray(batch.column(c)).astype(np.int64) for c in (length_col, "lot__", "rank__"))
            rank = rank - 1 + before[first[size] + lot]
            at = np.searchsorted(key, size << 44 | rank, "right") - 1
            kept = [c for c in batch.schema.names if c not in ("lot__", "rank__")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(slot[at, 2] + rank - slot[at, 1]), pa.array(slot[at, 3])], [*kept, "sequence_id", "offset"])

    ranked = lots.withColumn("rank__", F.row_number().over(Window.partitionBy("lot__", length_col).orderBy(*keys)))
    schema = table.drop("sequence_id", "offset").schema.add("sequence_id", "long").add("offset", "long")
    placed = ranked.drop("sequence_id", "offset").mapInArrow(run, schema)
    if not whole:
        return placed
    # A piece as long as a sequence has one of its own; no order is needed for that.
    alone = table.drop("sequence_id", "offset").where(F.col(length_col) == cap)
    return placed.union(alone.withColumns({"sequence_id": F.lit(sequence) + F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}))


def pack_documents(df: DataFrame, tokenizer: str, end_id: int, cap: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every row of ``df`` with their sequence and offset; nulls and repeated rows are documents of their own."""
    cut = written(pieces(df, tokenizer, end_id, cap, id_col, text_col), "pieces")
    return pack(cut, cap).drop("row")
