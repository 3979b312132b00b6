"""Helpers shared by the operators: Arrow batches, ids per distinct word, range numbering."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  used as pa.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import materialise

#: Text bytes handled at once inside a task.
SLICE_BYTES = 4 << 20


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of the folder, by Spark's own reader."""
    return spark.read.parquet(f"{folder}/{table}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the name with underscores behind it that no column of ``df`` has, in any letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    return materialise(df, f"llm-{label}")


def release() -> None:
    """Give memory that is no longer used back to the system: workers are kept for later stages, where it would count beside theirs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def row_slices(batches, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of about ``limit`` bytes of a text column; a single longer text is a slice of its own, never cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column)
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0), dtype=np.int64)
        piece = (np.cumsum(sizes) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            yield batch.slice(begin, end - begin)
    release()


def slices(batches, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Row slices as :func:`row_slices` cuts them, each with its texts as UTF-8 (null: empty)."""
    for rows in row_slices(batches, column, limit):
        yield rows, [t or b"" for t in rows.column(column).cast(pa.binary()).to_pylist()]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes ``starts[i] .. starts[i] + lengths[i] - 1`` for all i, in order."""
    total = int(lengths.sum())
    shift = starts - (np.cumsum(lengths) - lengths)
    return np.repeat(shift, lengths) + np.arange(total)


def range_parts(df: DataFrame, column: str, parts: int) -> list[int]:
    """Upper bounds cutting an integer column into about equal ranges; reads that column only.

    The list has at most ``parts - 1`` numbers.
    """
    if parts < 2:
        return []
    found = df.select(F.col(column).cast("double").alias("v")).approxQuantile("v", [i / parts for i in range(1, parts)], 0.2 / parts)
    return sorted({int(v) for v in found})


def part_of(column, bounds: list[int]):
    """Number of the range of :func:`range_parts` that holds the value; nulls come first."""
    cut = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<long>")
    return F.coalesce(F.size(F.filter(cut, lambda b: b < column)), F.lit(0)).cast("int")
