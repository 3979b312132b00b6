"""Token-id files: canonical length-limited Huffman codes from global counts.

Format (a Parquet folder): ``codes`` holds the code length of every id; ``blocks``
holds rows of whole documents in ascending id order. A block is decoded on its
own: it has the bit offset of every ``STEP``-th id of each document, so a table
of ``2 ** LIMIT`` entries decodes all stretches side by side.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.batches import part_of, ragged, range_parts, row_slices, slices, written
from millrace.llm.tokens import ENCODED_BYTES, text_ids

#: Longest code in bits, ids between two bit-offset checkpoints, coded bytes of a block.
LIMIT, STEP, BLOCK_BYTES = 18, 256, 1 << 18
#: Ids of a range of documents that one task codes and writes.
PART_IDS = 6_000_000

BLOCKS = "first_start bigint, doc_ids array<bigint>, lengths array<bigint>, marks binary, bits binary"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 for unused ids."""
    out = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    n = len(used)
    if n > 1 << limit:
        raise ValueError(f"{n} ids need more than {limit} bits")
    if n < 2:
        out[used] = 1
        return out
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    row, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        both = np.concatenate([leaves, row[: len(row) // 2 * 2].reshape(-1, 2).sum(1)])
        at = np.argsort(both, kind="stable")
        row = both[at]
        is_leaf.append(at < n)
    take, lengths = 2 * n - 2, np.zeros(n, np.uint8)
    for flags in reversed(is_leaf):
        own = int(flags[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out[order] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    size = lengths[order].astype(np.uint64)
    if len(order):
        top = np.uint64(int(size.max()))
        room = np.uint64(1) << (top - size)  # codes of full length below each code
        codes[order] = (np.cumsum(room) - room) >> (top - size)
    return codes


def pack_bits(ids: np.ndarray, counts: np.ndarray, codes: np.ndarray, lengths: np.ndarray):
    """Bits of each document from a byte of its own on: bytes, byte bounds, bit position of every id in its document."""
    size = lengths[ids].astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(size)])
    first = np.cumsum(counts) - counts
    bits = ends[first + counts] - ends[first]
    bounds = np.concatenate([[0], np.cumsum((bits + 7) // 8)])
    inside = ends[:-1] - np.repeat(ends[first], counts)
    at = inside + np.repeat(bounds[:-1] * 8, counts)
    words = np.zeros(int(bounds[-1]) // 8 + 2, np.uint64)
    if len(ids):
        code, word, left = codes[ids], at >> 6, 64 - (at & 63) - size
        over = left < 0
        put = np.where(over, code >> np.maximum(-left, 0).astype(np.uint64), code << np.maximum(left, 0).astype(np.uint64))
        begins = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
        words[word[begins]] = np.bitwise_or.reduceat(put, begins)
        words[word[over] + 1] |= code[over] << (64 + left[over]).astype(np.uint64)
    return words.astype(">u8").tobytes(), bounds, inside


def decode_table(lengths: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """For each ``limit`` bits: the id they begin with and its code length, as id * 32 + length."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    size = lengths[order].astype(np.int64)
    table = np.zeros(1 << limit, np.uint32)
    filled = np.repeat((order * 32 + size).astype(np.uint32), 1 << (limit - size))
    table[: len(filled)] = filled
    return table


def unpack_bits(data: bytes, starts: np.ndarray, counts: np.ndarray, table: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Ids of stretches that begin at the bits ``starts`` and hold ``counts`` ids, decoded side by side."""
    raw = np.frombuffer(data + b"\0" * 8, np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    out = np.zeros(int(counts.sum()), np.uint32)
    order = np.argsort(-counts, kind="stable")
    at, to = starts[order].copy(), (np.cumsum(counts) - counts)[order]
    ascending = counts[order][::-1]
    mask = np.uint32((1 << limit) - 1)
    for step in range(int(counts.max(initial=0))):
        n = len(counts) - int(np.searchsorted(ascending, step, "right"))
        now = at[:n]
        hit = table[(window[now >> 3] >> (32 - limit - (now & 7)).astype(np.uint32)) & mask]
        out[to[:n] + step] = hit >> 5
        at[:n] += hit & 31
    return out


def encode_ids(df: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids as little-endian unsigned 32-bit): every text with ``end_id`` appended. Null text: empty."""

    def run(batches):
        for rows in row_slices(batches, "text", ENCODED_BYTES):
            ids, counts = text_ids(tokenizer).encode(rows.column("text"))
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id).astype("<u4")
            counts = counts + 1
            cuts = [0, *np.cumsum(counts * 4).tolist()]
            data = ids.tobytes()
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(counts), pa.array([data[b:e] for b, e in zip(cuts, cuts[1:])], pa.binary())], ["doc_id", "n_tokens", "ids"])

    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary")


def id_counts(ids: DataFrame, column: str = "ids") -> DataFrame:
    """Global (id, n), summed inside tasks first."""

    def run(batches):
        total = np.zeros(0, np.int64)
        for _, ids in slices(batches, column):
            got = np.bincount(np.frombuffer(b"".join(ids), "<u4"))
            if len(got) > len(total):
                total, got = got.astype(np.int64), total
            total[: len(got)] += got
        seen = np.flatnonzero(total)
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    return ids.select(column).mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(ids: DataFrame, path: str) -> None:
    """Write (doc_id, n_tokens, ids) in the format above, in ascending doc_id order.

    ``ids`` is read several times: pass a written table. Null doc_ids come
    first, rows with one doc_id are ordered by count, then bits. The collected
    counts are one row per used id, bounded by the vocabulary.
    """
    spark = ids.sparkSession
    counted = id_counts(ids).toPandas()
    counts = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 1, np.int64)
    counts[counted["id"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    lengths = code_lengths(counts)
    codes = canonical_codes(lengths)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{path}/codes")

    def code(batches):
        for batch, ids in slices(batches, "ids"):
            flat = np.frombuffer(b"".join(ids), "<u4")
            n = np.asarray(batch.column("n_tokens"))
            data, bounds, inside = pack_bits(flat, n, codes, lengths)
            first = np.cumsum(n) - n
            marks = [inside[f : f + k : STEP].astype("<u8").tobytes() for f, k in zip(first.tolist(), n.tolist())]
            cuts = bounds.tolist()
            bits = [data[b:e] for b, e in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("doc_id"), batch.column("n_tokens"), pa.array(marks, pa.binary()), pa.array(bits, pa.binary())], ["part", "doc_id", "n_tokens", "marks", "bits"])

    parts = max(1, -(-int(counts.sum()) // PART_IDS))
    bounds = range_parts(ids, "doc_id", parts)
    ranged = ids.withColumn("part", part_of(F.col("doc_id"), bounds))
    totals = dict(ranged.groupBy("part").agg(F.sum("n_tokens")).collect())  # a row per range
    before, start = {}, 0
    for part in range(len(bounds) + 1):
        before[part], start = start, start + totals.get(part, 0)
    coded = ranged.mapInArrow(code, "part int, doc_id bigint, n_tokens bigint, marks binary, bits binary")
    placed = coded.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", F.asc_nulls_first("doc_id"), "n_tokens", "bits")

    def blocks(batches):
        held, size, start = [], 0, None

        def block():
            docs, n, marks, bits = zip(*held)
            offsets = np.cumsum([0, *map(len, bits)])[:-1] * 8
            lanes = b"".join((np.frombuffer(m, "<u8") + o).astype("<u8").tobytes() for m, o in zip(marks, offsets.tolist()))
            return pa.RecordBatch.from_arrays([pa.array([start], pa.int64()), pa.array([docs], pa.list_(pa.int64())), pa.array([n], pa.list_(pa.int64())), pa.array([lanes], pa.binary()), pa.array([b"".join(bits)], pa.binary())], ["first_start", "doc_ids", "lengths", "marks", "bits"])

        for batch in batches:
            if start is None and batch.num_rows:
                start = before[batch.column("part")[0].as_py()]
            for row in zip(*[batch.column(i).to_pylist() for i in range(1, 5)]):
                held.append(row)
                size += len(row[3])
                if size >= BLOCK_BYTES:
                    yield block()
                    start, held, size = start + sum(r[1] for r in held), [], 0
        if held:
            yield block()

    placed.mapInArrow(blocks, BLOCKS).write.parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of the files: (doc_id, start, n_tokens, ids_crc32[, ids little-endian unsigned 32-bit])."""
    lengths = np.frombuffer(bytes(spark.read.parquet(f"{path}/codes").first()[0]), np.uint8)

    def run(batches):
        table = decode_table(lengths)
        for batch in batches:
            for i in range(batch.num_rows):
                start, docs, n, marks, bits = (batch.column(k)[i].as_py() for k in ("first_start", "doc_ids", "lengths", "marks", "bits"))
                n = np.asarray(n, np.int64)
                lanes = -(-n // STEP)
                counts = np.minimum(STEP, np.repeat(n, lanes) - STEP * (ragged(np.zeros(len(n), np.int64), lanes)))
                data = unpack_bits(bits, np.frombuffer(marks, "<u8").astype(np.int64), counts, table).astype("<u4").tobytes()
                ends = np.cumsum(n)
                cuts = [0, *(ends * 4).tolist()]
                each = [data[b:e] for b, e in zip(cuts, cuts[1:])]
                arrays = [pa.array(docs, pa.int64()), pa.array(start + ends - n), pa.array(n), pa.array([zlib.crc32(x) for x in each], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays + ([pa.array(each, pa.binary())] if with_ids else []), ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(arrays) + with_ids])

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")
    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks").mapInArrow(run, schema)


def huffman_id_file(df: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, write to ``path`` and read back; every row of ``df`` is one document.

    Null text is empty (only the end id). Null and repeated doc_ids are kept.
    An empty table gives an empty file set. Other columns are not read.
    """
    ids = written(encode_ids(df, tokenizer, end_id, id_col, text_col), "ids")
    write_ids(ids, path)
    return read_ids(df.sparkSession, path)
