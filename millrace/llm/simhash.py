"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints that differ in at most r bits agree in at least B - r of B bands,
so they meet in a bucket keyed by some choice of bands. Inside a bucket the
fingerprints are stored as bit planes; distances of a block of them to all
others grow plane by plane in carry-save bitwise counters, and a block is left
as soon as every counter has passed r.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import free_name, slices, written
from millrace.llm.components import components

BITS = 64
#: Fingerprints that one comparison holds; larger buckets are dealt by further bands.
BUCKET = 4096
#: Small buckets are compared together up to so many fingerprints.
BLOCK = 512
#: Shingles summed in 16-bit counters.
RUN = 60_000

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: bytes, size: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every run of ``size`` words, A-Z lowered, joined by spaces; of all words if there are fewer."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = np.concatenate([[0], ends[:-1]])
    return np.fromiter((hashed(joined[b:e], seed) for b, e in zip(begins[: len(words) - size + 1].tolist(), (ends[size - 1 :] - 1).tolist())), np.uint64, len(words) - size + 1)


#: For each half byte: its four bits in counters of 16 bits.
_SPREAD = np.array([sum((n >> i & 1) << 16 * i for i in range(4)) for n in range(16)], np.uint64)


def majority_bits(hashes: list[np.ndarray]) -> np.ndarray:
    """A fingerprint per array: each bit set that over half of the hashes set; zero for none."""
    counts = np.fromiter(map(len, hashes), np.int64, len(hashes))
    out = np.zeros(len(hashes), np.uint64)
    if not counts.sum():
        return out
    flat = np.concatenate(hashes)
    # Runs short enough for 16-bit counters; most texts are one run.
    runs = -(-counts // RUN)
    owner = np.repeat(np.arange(len(hashes)), runs)
    first = (np.cumsum(counts) - counts)[owner] + RUN * (np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs))
    for nibble in range(16):
        sums = np.add.reduceat(_SPREAD[(flat >> np.uint64(4 * nibble) & np.uint64(15)).astype(np.intp)], first)
        for i in range(4):
            ones = np.zeros(len(hashes), np.int64)
            np.add.at(ones, owner, (sums >> np.uint64(16 * i) & np.uint64(0xFFFF)).astype(np.int64))
            out |= (2 * ones > counts).astype(np.uint64) << np.uint64(4 * nibble + i)
    return out


def fingerprints(df: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text", sign: str | None = None) -> DataFrame:
    """(doc_id, print as signed long[, sign]) of every row; null text has no words. ``sign`` names a long to carry along."""

    def run(batches):
        for rows, texts in slices(batches, "text"):
            found = majority_bits([shingle_hashes(t, size) for t in texts])
            carried = [rows.column("sign")] if sign else []
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(found.view(np.int64)), *carried], ["doc_id", "print", "sign"][: 2 + len(carried)])

    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *([F.col(sign).alias("sign")] if sign else []))
    return slim.mapInArrow(run, "doc_id bigint, print bigint" + (", sign bigint" if sign else ""))


def _near(prints: np.ndarray, radius: int, asked: int):
    """(rows, words of bits of the fingerprints over ``radius`` differing bits from each), for rows with a near one.

    ``prints``: a row of one or more 64-bit words per fingerprint.

    Bit-sliced: plane p has bit p of all fingerprints, 64 to a word. A counter
    of k bits per pair starts at 2**k - 1 - radius, so its carry out says that
    the distance is over the radius.
    """
    n = len(prints)
    wide = -(-n // 64) * 64
    bits = np.unpackbits(np.ascontiguousarray(prints.reshape(n, -1)).view(np.uint8), axis=1)
    count = bits.shape[1]
    padded = np.zeros((wide, count), np.uint8)
    padded[:n] = bits
    planes = np.packbits(np.ascontiguousarray(padded.T), axis=1, bitorder="little").view(np.uint64).reshape(count, -1)
    real = np.packbits(np.arange(wide) < n, bitorder="little").view(np.uint64)
    size = max(1, radius.bit_length())
    begin = (1 << size) - 1 - radius
    for low in range(0, n, asked):
        rows = np.arange(low, min(n, low + asked))
        counters = [np.full((len(rows), planes.shape[1]), np.uint64(0xFFFFFFFFFFFFFFFF if begin >> i & 1 else 0)) for i in range(size)]
        over = np.zeros_like(counters[0]) | ~real
        for p in range(count):
            carry = planes[p] ^ (np.uint64(0) - bits[rows, p].astype(np.uint64))[:, None]
            for counter in counters:
                carry, counter[:] = carry & counter, carry ^ counter
            over |= carry
            if p % 4 == 3:
                alive = np.bitwise_count(~over).sum(axis=1) > 1  # itself is always near
                if not alive.any():
                    break
                if not alive.all():
                    rows, over, counters = rows[alive], over[alive], [c[alive] for c in counters]
        else:
            yield rows, over


def within_radius(prints: np.ndarray, radius: int, asked: int = 256) -> list[tuple[int, int]]:
    """Links that join the fingerprints at ``radius`` or fewer differing bits; each link is such a pair."""
    near: dict[int, int] = {}
    for rows, over in _near(prints, radius, asked):
        near |= {r: int.from_bytes((~o).tobytes(), "little") for r, o in zip(rows.tolist(), over)}
    links, left = [], (1 << len(prints)) - 1
    for root in near:
        if not left >> root & 1:
            continue
        left &= ~(1 << root)
        stack = [root]
        while stack:
            from_ = stack.pop()
            new = near.get(from_, 0) & left
            left &= ~new
            while new:
                low = new & -new
                links.append((from_, low.bit_length() - 1))
                stack.append(links[-1][1])
                new ^= low
    return links


def _masks(fixed: int, bands: list[int], radius: int) -> list[int]:
    """``fixed`` with every choice of all but ``radius`` of the bands."""
    return [fixed | sum(chosen) for chosen in combinations(bands, len(bands) - radius)]


def _bands(free: int, count: int) -> list[int]:
    """The set bits of ``free`` in ``count`` bands."""
    places = [i for i in range(BITS) if free >> i & 1]
    return [sum(1 << int(i) for i in part) for part in np.array_split(places, count)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _bucketed(df: DataFrame, masks: list[int]) -> DataFrame:
    """Rows by every mask: (mask, value, print)."""
    each = F.explode(F.array(*[F.lit(_signed(m)).cast("long") for m in masks]))
    return df.select("print", each.alias("mask")).select("mask", F.col("print").bitwiseAND(F.col("mask")).alias("value"), "print")


def links_within(nodes: DataFrame, radius: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (print) within ``radius`` bits of one another.

    Exact. ``nodes`` is a written table of distinct fingerprints. A bucket of
    more than ``bucket`` is dealt again by bands of its free bits, down to few
    enough free bits, so no group of rows is unbounded.
    """
    count = radius + 2
    frames, masks = [], _masks(0, _bands((1 << BITS) - 1, count), radius)
    now = _bucketed(nodes, masks)
    while True:
        sizes = now.groupBy("mask", "value").agg(F.count("*").alias("n")).where("n > 1")
        free = BITS - max(m.bit_count() for m in masks)
        hot = sizes.where(F.col("n") > bucket).select("mask", "value")
        if free <= bucket.bit_length() - 1 or free < count or hot.isEmpty():
            frames.append(now.join(sizes.select("mask", "value"), ["mask", "value"], "left_semi"))
            break
        fit = sizes.where(F.col("n") <= bucket).select("mask", "value")
        frames.append(now.join(fit, ["mask", "value"], "left_semi"))
        hot = written(now.join(hot, ["mask", "value"], "left_semi"), "hot-buckets")
        # Each mask of the hot rows is refined by its own further bands.
        again = [hot.where(F.col("mask") == _signed(m)).transform(_bucketed, _masks(m, _bands(((1 << BITS) - 1) & ~m, count), radius)) for m in masks]
        masks = sorted({x for m in masks for x in _masks(m, _bands(((1 << BITS) - 1) & ~m, count), radius)})
        now = again[0]
        for frame in again[1:]:
            now = now.union(frame)
        now = written(now.distinct(), "buckets")

    def run(batches):
        def compared(keys, prints):
            # Buckets share a comparison up to BLOCK rows; a link between two of them is a link all the same.
            cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            ends, begin = np.append(cuts, len(prints)), 0
            found = []
            for i, end in enumerate(ends):
                if i + 1 < len(ends) and ends[i + 1] - begin <= BLOCK:
                    continue
                part = np.unique(prints[begin:end])
                found += [(part[a], part[b]) for a, b in within_radius(part.view(np.uint64), radius)]
                begin = end
            return pa.RecordBatch.from_arrays([pa.array(np.array([x[k] for x in found], np.int64)) for k in (0, 1)], ["a", "b"])

        held_keys, held = np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
        for batch in batches:
            keys = np.column_stack([np.asarray(batch.column("mask")), np.asarray(batch.column("value"))])
            held_keys, held = np.concatenate([held_keys, keys]), np.concatenate([held, np.asarray(batch.column("print"))])
            # Up to the last bucket, which may go on.
            whole = np.flatnonzero(np.any(held_keys != held_keys[-1:], axis=1))
            if len(whole):
                end = int(whole[-1]) + 1
                yield compared(held_keys[:end], held[:end])
                held_keys, held = held_keys[end:], held[end:]
        if len(held):
            yield compared(held_keys, held)

    out = None
    for frame in frames:
        dealt = frame.repartition("mask", "value").sortWithinPartitions("mask", "value").mapInArrow(run, "a bigint, b bigint")
        out = dealt if out is None else out.union(dealt)
    return out


def near_duplicates(df: DataFrame, size: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row.

    Equal fingerprints are one node, so copies are never paired. Texts without
    words have the fingerprint zero and link like any other; null text is empty.
    component_id is the smallest doc_id reachable (null ids do not count: null
    if there is no other). Repeated doc_ids stay rows of their own. An empty table
    gives no rows. Other columns are not read.
    """
    docs = written(fingerprints(df, size, id_col, text_col), "prints")
    nodes = written(docs.groupBy("print").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links_within(nodes.select("print"), radius))
    rooted = nodes.join(roots.withColumnRenamed("node", "print"), "print", "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.select("print", "root").join(least, "root").select("print", "component_id")
    return docs.join(classes, "print").select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def drop_similar(df: DataFrame, size: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with one document of each component of :func:`near_duplicates`, the one with the smallest id.

    Null ids come last, then the smaller hash of the text decides. Texts without
    words are one component, so one of them stays. Of rows alike in id and text
    one is kept. An empty table stays empty. All columns stay, whatever their
    names.
    """
    sign = free_name(df, "sign")
    marked = df.withColumn(sign, F.xxhash64(F.col(text_col)))
    docs = written(fingerprints(marked, size, id_col, text_col, sign), "prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sign")).alias("first")
    nodes = written(docs.groupBy("print").agg(first), "nodes")
    roots = components(links_within(nodes.select("print"), radius))
    rooted = nodes.join(roots.withColumnRenamed("node", "print"), "print", "left")
    kept = rooted.groupBy(F.coalesce("root", "print").alias("root")).agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("kept_id"), F.col("first.sign").alias("kept_sign"))
    kept = written(kept, "kept")
    keep = kept.select(*[F.col(c).alias(free_name(df, c)) for c in kept.columns])
    on = marked[id_col].cast("long").eqNullSafe(keep[keep.columns[0]]) & (marked[sign] == keep[keep.columns[1]])
    out = marked.join(keep, on, "left_semi")
    repeats = docs.groupBy("doc_id", "sign").agg(F.count("*").alias("n")).where("n > 1")
    if not repeats.isEmpty():
        out = out.dropDuplicates([id_col, sign])
    return out.select(*df.columns)
