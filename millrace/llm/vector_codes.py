"""Vector code compression: whole-number product codes fitted with norm-of-sum bounds.

A vector becomes whole numbers, is cut into equal parts, and each part is
replaced by the number of the nearest entry of its position's codebook. The
codebooks are fitted by rounds of assignment and mean. Every codebook of every
round is retained. For each part and each group of entries a vector keeps one
lower bound on the distance to the group's entries other than its own, stamped
with the round whose codebook it was measured against. Later that bound is
lessened by the net displacement of the entries since the stamp (the norm of
the sum of their moves, not the sum of the norms), and only groups whose bound
does not lie beyond the exact distance to the own entry are scanned again.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256

#: Neighbouring entries that share a bound.
GROUP = 8

#: Vectors handled at once inside a task.
ROWS = 2048

#: Largest component after scaling.
MOST = 2**31 - 1

_STATE = "id bigint, label string, v array<int>, code binary, bound binary, stamp binary, slot int, sums array<bigint>"
_CODED = "id bigint, label string, code binary, error bigint"


@dataclass
class Assigned:
    """Nearest entries of some vectors' parts, exact squared distances, and the bounds kept for later rounds."""

    code: np.ndarray  # (vectors, parts)
    squared: np.ndarray  # (vectors, parts)
    bound: np.ndarray  # (vectors, parts, groups), float16, rounded down
    stamp: np.ndarray  # (vectors, parts, groups)
    scanned: int  # distances to single entries that were computed


def whole_numbers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * value)`` as 64-bit numbers; a component beyond 32 bits raises ``ValueError``."""
    scaled = np.floor(np.asarray(values, np.float64) * scale)
    if scaled.size and np.abs(scaled).max() > MOST:
        raise ValueError(f"a component times {scale} does not fit 32 bits")
    return scaled.astype(np.int64)


def in_parts(vectors: np.ndarray, parts: int) -> np.ndarray:
    """(vectors, parts, width); a length that ``parts`` does not divide is filled up with zeros."""
    width = -(-vectors.shape[1] // parts)
    short = parts * width - vectors.shape[1]
    return np.pad(vectors, ((0, 0), (0, short))).reshape(len(vectors), parts, width)


def _numbers_for(x: np.ndarray, book: np.ndarray) -> type:
    """A type in which squared distances are exact: doubles where they fit, else 64-bit integers."""
    reach = max((int(np.abs(a).max()) for a in (x, book) if a.size), default=0)
    largest = 4 * max(x.shape[-1], 1) * reach * reach
    if largest < 2**53:
        return np.float64
    if largest < 2**63:
        return np.int64
    raise ValueError("squared distances do not fit 64 bits")


def _distances(x: np.ndarray, entries: np.ndarray, kind: type) -> np.ndarray:
    """Squared distances (n, entries) of (n, width) to (entries, width)."""
    x, entries = x.astype(kind), entries.astype(kind)
    return ((x * x).sum(1)[:, None] + (entries * entries).sum(1)[None, :] - 2 * (x @ entries.T)).astype(np.int64)


def _rounded_down(squared: np.ndarray) -> np.ndarray:
    """Square roots as half floats that are not above them; what is beyond their range becomes their largest."""
    root = np.minimum(np.sqrt(squared.astype(np.float64)) * (1 - 1e-12), 65000.0)
    half = root.astype(np.float16)
    return np.where(half.astype(np.float64) > root, np.nextafter(half, np.float16(-1)), half)


def displacement(history: list[np.ndarray], group: int = GROUP) -> np.ndarray:
    """(rounds, parts, groups): the largest net move of a group's entries from each round's codebook to the last one."""
    now = history[-1].astype(np.float64)
    starts = np.arange(0, now.shape[1], group)
    moves = [np.sqrt(((now - old) ** 2).sum(2)) * (1 + 1e-9) for old in history]
    return np.stack([np.maximum.reduceat(m, starts, axis=1) for m in moves])


def assign(x: np.ndarray, history: list[np.ndarray], kept: Assigned | None = None, group: int = GROUP) -> Assigned:
    """Nearest entries of the last codebook, ties to the lower index.

    ``history`` holds the codebooks (parts, entries, width) of all rounds so far.
    Without ``kept`` every entry is scanned; with it, only groups whose bound,
    less their entries' net displacement since its stamp, does not lie beyond
    the exact distance to the entry of before.
    """
    book, n = history[-1], len(x)
    parts, entries, _ = book.shape
    starts = np.arange(0, entries, group)
    groups, now, kind = len(starts), len(history) - 1, _numbers_for(x, book)
    part = np.arange(parts)
    if kept is None:
        need = np.ones((n, parts, groups), bool)
        bound, stamp = np.zeros((n, parts, groups), np.float16), np.full((n, parts, groups), now, np.uint8)
        code = np.zeros((n, parts), np.int64)
        squared = np.full((n, parts), np.iinfo(np.int64).max)
    else:
        code, bound, stamp = kept.code.astype(np.int64), kept.bound.copy(), kept.stamp.copy()
        apart = x - book[part, code]
        squared = (apart * apart).sum(2)
        moved = displacement(history, group)[stamp, part[None, :, None], np.arange(groups)[None, None, :]]
        need = bound.astype(np.float64) - moved <= (np.sqrt(squared.astype(np.float64)) * (1 + 1e-9))[:, :, None]
        # A part that may change its entry has the group of that entry measured anew.
        rows, which = np.nonzero(need.any(2))
        need[rows, which, code[rows, which] // group] = True
    scanned, found = 0 if kept is None else n * parts, []
    for p in range(parts):
        for g, begin in enumerate(starts.tolist()):
            rows = np.flatnonzero(need[:, p, g])
            if not len(rows):
                continue
            d = _distances(x[rows, p], book[p, begin : begin + group], kind)
            scanned += d.size
            first = d.argmin(1)
            at = np.arange(len(rows)), first
            least = d[at]
            d[at] = np.iinfo(np.int64).max
            found.append((p, g, rows, begin + first, least, d.min(1)))
            better = (least < squared[rows, p]) | ((least == squared[rows, p]) & (begin + first < code[rows, p]))
            squared[rows[better], p], code[rows[better], p] = least[better], (begin + first)[better]
    for p, g, rows, first, least, second in found:
        others = np.where(first == code[rows, p], second, least)
        bound[rows, p, g], stamp[rows, p, g] = _rounded_down(others), now
    return Assigned(code, squared, bound, stamp, scanned)


def _lists(column) -> tuple[np.ndarray, int]:
    """The vectors of an Arrow list column without nulls, all of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1), len(column)


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary value per row."""
    flat = np.ascontiguousarray(rows).reshape(len(rows), -1).view(np.uint8)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * flat.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(flat.tobytes())])


def _array(column, kind, shape) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape)


def _round(source: DataFrame, history: list[np.ndarray], scale: int, group: int, last: bool) -> DataFrame:
    """One assignment of all vectors of ``source``: vectors at first, states later.

    A task gives a row per vector and, unless it is the last round, one row of
    sums per entry that it has used, so the means need no second reading.
    """
    parts, entries, width = history[-1].shape
    groups, first = -(-entries // group), len(history) == 1

    def run(batches):
        sums = np.zeros((parts * entries, 1 + width), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                v, n = _lists(rows.column("v"))
                v = whole_numbers(v, scale) if first else v.astype(np.int64)
                kept = None
                if not first:
                    kept = Assigned(_array(rows.column("code"), np.uint8 if entries <= 256 else np.uint16, (parts,)), None, _array(rows.column("bound"), np.float16, (parts, groups)), _array(rows.column("stamp"), np.uint8, (parts, groups)), 0)
                x = in_parts(v, parts)
                got = assign(x, history, kept, group)
                code = _binary(got.code.astype(np.uint8 if entries <= 256 else np.uint16))
                if last:
                    yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("label"), code, pa.array(got.squared.sum(1), pa.int64())], ["id", "label", "code", "error"])
                    continue
                slots = (got.code + entries * np.arange(parts)).ravel()
                np.add.at(sums, slots, np.concatenate([np.ones((n * parts, 1), np.int64), x.reshape(n * parts, width)], axis=1))
                flat = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * v.shape[1], pa.array(v.astype(np.int32).ravel()))
                yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("label"), flat, code, _binary(got.bound), _binary(got.stamp), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int64()))], _STATE_SCHEMA)
        used = np.flatnonzero(sums[:, 0])
        if len(used):
            none = [pa.nulls(len(used), t) for t in (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary())]
            lists = pa.ListArray.from_arrays(np.arange(len(used) + 1, dtype=np.int32) * (1 + width), pa.array(sums[used].ravel()))
            yield pa.RecordBatch.from_arrays([*none, pa.array(used, pa.int32()), lists], _STATE_SCHEMA)

    return source.mapInArrow(run, _CODED if last else _STATE)


_STATE_SCHEMA = pa.schema([("id", pa.int64()), ("label", pa.string()), ("v", pa.list_(pa.int32())), ("code", pa.binary()), ("bound", pa.binary()), ("stamp", pa.binary()), ("slot", pa.int32()), ("sums", pa.list_(pa.int64()))])


def _means(state: DataFrame, book: np.ndarray) -> np.ndarray:
    """The next codebook: floored means per entry; entries that no part uses stay.

    One number per entry and component reaches the driver.
    """
    parts, entries, width = book.shape
    each = state.where("slot is not null").select("slot", F.posexplode("sums").alias("at", "value"))
    totals = np.zeros((parts * entries, 1 + width), object)
    for row in each.groupBy("slot", "at").agg(F.sum("value").alias("total")).collect():
        totals[row["slot"], row["at"]] = row["total"]
    new = book.copy().reshape(parts * entries, width)
    for slot in range(parts * entries):
        if totals[slot, 0]:
            new[slot] = [total // totals[slot, 0] for total in totals[slot, 1:]]
    return new.reshape(book.shape)


def fit_codes(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, group: int = GROUP) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """(id, label, length, code, error) for every vector, and the final codebook of each length.

    ``code`` holds an unsigned byte per part (two, little-endian, above 256
    entries), ``error`` the squared distance to the coded vector. Vectors that
    are null or hold null or non-finite components are left out. Null and
    repeated ids and equal rows all stay: the starting entries are those of the
    smallest ids, nulls last, then the smaller vector; fewer vectors than
    ``entries`` give as many entries. Vectors of each length have a codebook of
    their own. A length that ``parts`` does not divide is filled up with zeros,
    an empty vector has only zeros. Labels are carried as text. An empty table
    gives no rows. Other columns are not read.
    """
    spark = df.sparkSession
    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(label).cast("string").alias("label"), v.alias("v"))
    rows = rows.where("v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    coded, books = [], {}
    lengths = sorted(r["n"] for r in rows.select(F.size("v").alias("n")).distinct().collect())
    for length in lengths:
        own = rows.where(F.size("v") == length)
        heads = own.select("id", "v").orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()
        start = whole_numbers(np.array([r["v"] for r in heads], np.float64).reshape(len(heads), length), scale)
        history = [np.ascontiguousarray(in_parts(start, parts).transpose(1, 0, 2))]
        source = own
        for _ in range(rounds):
            state = written(_round(source, history, scale, group, False), "vector-codes")
            history.append(_means(state, history[-1]))
            source = state.where("slot is null")
        done = _round(source, history, scale, group, True)
        coded.append(done.withColumn("length", F.lit(length)))
        books[length] = history[-1]
    if not coded:
        return spark.createDataFrame([], "id bigint, label string, length int, code binary, error bigint"), books
    out = coded[0]
    for more in coded[1:]:
        out = out.union(more)
    return out.select("id", "label", "length", "code", "error"), books


def decode(coded: DataFrame, books: dict[int, np.ndarray], scale: int = SCALE) -> DataFrame:
    """(id, vector): the entries that the codes name, in order, divided by ``scale``."""

    def run(batches):
        for batch in batches:
            out = []
            for length, code in zip(batch.column("length").to_pylist(), batch.column("code").to_pylist()):
                book = books[length]
                at = np.frombuffer(code, np.uint8 if book.shape[1] <= 256 else np.uint16)
                out.append(book[np.arange(len(at)), at].ravel()[:length] / scale)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.list_(pa.float64()))], ["id", "vector"])

    return coded.select("id", "length", "code").mapInArrow(run, "id bigint, vector array<double>")


def digest(book: np.ndarray) -> str:
    """SHA-256 of all components in decimal by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def compress_vectors(df: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) with the settings above.

    ``label_error`` adds the errors of all vectors with an equal label, nulls
    together, whatever their lengths; ``codebooks_sha256`` is that of the
    vector's length. Label sums are added up before they are dealt, written, and
    joined by size: a hot label is one small row.
    """
    coded, books = fit_codes(df)
    coded = written(coded, "vector-codes")
    sums = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    sums = sums.withColumnRenamed("label", "of")
    shas = F.create_map(*[F.lit(x) for n, book in books.items() for x in (n, digest(book))]) if books else F.create_map().cast("map<int,string>")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", shas[F.col("length")].alias("codebooks_sha256")
    )
