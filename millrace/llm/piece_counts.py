"""Token counts: pieces once per distinct pre-token, joined to per-document frequencies."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import slices, written

#: Text bytes whose documents share one list of pre-tokens.
GROUP_BYTES = 16 << 20
#: Documents per bucket of pre-tokens.
BUCKET_ROWS = 50_000

_SPACED = re.compile(rb" +[^ ]+| +$")
_MODELS: dict[str, sentencepiece.SentencePieceProcessor] = {}


def _model(path: str) -> sentencepiece.SentencePieceProcessor:
    if path not in _MODELS:
        _MODELS[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _MODELS[path]


def pre_tokens(text: bytes) -> list[bytes]:
    """Stretches that no piece crosses, each without the one space that stands before it.

    The model puts a space before the text and no piece holds a space behind
    another character, so a piece never reaches over the space before a word.
    """
    if not text:
        return []
    found = text.split(b" ")
    return found if b"" not in found else [w[1:] for w in _SPACED.findall(b" " + text)]


def _groups(df: DataFrame, id_col: str, text_col: str, buckets: int) -> DataFrame:
    """Documents by group, as two kinds of rows.

    With a bucket: the group's distinct pre-tokens whose hash falls there, in a
    row. Without: the frequencies of the numbered pre-tokens in each document.
    """
    blank = {"bucket": pa.int32(), "words": pa.binary(), "doc_ids": pa.list_(pa.int64()), "n_bytes": pa.list_(pa.int64()), "sizes": pa.binary(), "places": pa.binary(), "times": pa.binary()}

    def rows_of(group: int, n: int, **given):
        return pa.RecordBatch.from_arrays([pa.array([group] * n, pa.int64()), *(pa.array(given.get(k, [None] * n), t) for k, t in blank.items())], ["group", *blank])

    def run(batches):
        task, n = TaskContext.get().partitionId(), 0
        for rows, texts in slices(batches, "text", GROUP_BYTES):
            group = (task << 32) + n
            numbers: dict[bytes, int] = {}
            number, sizes, places, times = numbers.setdefault, [], [], []
            for text in texts:
                own = [number(w, len(numbers)) for w in pre_tokens(text)]
                at, many = np.unique(np.array(own, np.int32), return_counts=True)
                sizes.append(len(at))
                places.append(at)
                times.append(many)
            # Sorted words and rising numbers lie close together, which leaves little to write and shuffle.
            words = sorted(numbers)
            bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
            order = np.argsort(bucket, kind="stable")
            place = np.empty(len(words), np.int64)
            place[np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))[order]] = np.arange(len(words))
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            listed = [words[i] for i in order.tolist()]
            used = np.flatnonzero(np.diff(cuts)).tolist()
            yield rows_of(group, len(used), bucket=used, words=[_pack(listed[cuts[b] : cuts[b + 1]]) for b in used])
            text = np.repeat(np.arange(len(texts)), sizes)
            at = text * len(words) + place[np.concatenate(places)]
            order = np.argsort(at)
            yield rows_of(
                group, 1,
                doc_ids=[rows.column("doc_id").to_pylist()],
                n_bytes=[list(map(len, texts))],
                sizes=[_pack_numbers(np.array(sizes))],
                places=[_pack_numbers(np.diff(at[order], prepend=0))],
                times=[_pack_numbers(np.concatenate(times)[order])],
            )
            n += 1

    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "group bigint, bucket int, words binary, doc_ids array<bigint>, n_bytes array<bigint>, sizes binary, places binary, times binary")


def _pack_numbers(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, by planes of bytes, compressed."""
    return zstandard.ZstdCompressor(level=3).compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack_numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8").ravel()


def _pack(words: list[bytes]) -> bytes:
    lengths = _pack_numbers(np.fromiter(map(len, words), np.int64, len(words)))
    return len(lengths).to_bytes(4, "little") + lengths + zstandard.ZstdCompressor(level=3).compress(b"".join(words))


def _unpack(data: bytes) -> list[bytes]:
    end = 4 + int.from_bytes(data[:4], "little")
    cuts = [0, *np.cumsum(_unpack_numbers(data[4:end])).tolist()]
    joined = zstandard.ZstdDecompressor().decompress(data[end:])
    return [joined[b:e] for b, e in zip(cuts, cuts[1:])]


def _pieces_of(model: str, words: list[bytes]) -> list[int]:
    """Pieces of each pre-token. An empty one is a single space at the end, which encode() would take for no text."""
    one = _model(model)
    space = int(one.piece_to_id("▁") != one.unk_id())
    texts = [w.decode() for w in words]
    return [len(ids) if text else space for text, ids in zip(texts, one.encode(texts, num_threads=1))]


def pieces_per_bucket(groups: DataFrame, model: str, buckets: int) -> DataFrame:
    """(group, bucket, pieces): the join of the groups' pre-tokens with the pieces of the distinct ones.

    All pre-tokens of a bucket meet in one task, which runs the model once for
    each; a frequent pre-token is there once per group.
    """

    def run(batches):
        known, now = {}, None
        for batch in batches:
            for group, bucket, data in zip(*(batch.column(k).to_pylist() for k in ("group", "bucket", "words"))):
                if bucket != now:
                    known, now = {}, bucket
                words = _unpack(data)
                new = [w for w in words if w not in known]
                known.update(zip(new, _pieces_of(model, new)))
                pieces = _pack_numbers(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
                yield pa.RecordBatch.from_arrays([pa.array([group], pa.int64()), pa.array([bucket], pa.int32()), pa.array([pieces], pa.binary())], ["group", "bucket", "pieces"])

    listed = groups.where("bucket is not null").select("group", "bucket", "words")
    return listed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "group").mapInArrow(run, "group bigint, bucket int, pieces binary")


def piece_counts(df: DataFrame, model: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row.

    Pre-tokens are listed once per group of documents, counted once each over
    the whole table, and joined back to the lists. No ids are kept. Null text is
    empty: 0 bytes, 0 tokens. Null and repeated doc_ids stay rows of their own;
    other columns are not read.
    """
    # About as many buckets as tasks that shuffle, and more where the table has many rows.
    buckets = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() // BUCKET_ROWS)
    groups = written(_groups(df, id_col, text_col, buckets), "pre-tokens")
    pieces = pieces_per_bucket(groups, model, buckets).groupBy("group").agg(F.collect_list(F.struct("bucket", "pieces")).alias("found"))
    joined = groups.where("bucket is null").drop("bucket", "words").join(pieces, "group", "left")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
                sizes, at, times = (_unpack_numbers(row[k]) for k in ("sizes", "places", "times"))
                n = np.concatenate([np.zeros(0, np.int64), *(_unpack_numbers(x["pieces"]) for x in sorted(row["found"] or [], key=lambda x: x["bucket"]))])
                at = np.cumsum(at) % max(1, len(n))
                sums = np.concatenate([[0], np.cumsum(n[at] * times)])
                ends = np.cumsum(sizes)
                tokens = sums[ends] - sums[ends - sizes]
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(row["n_bytes"], pa.int64()), pa.array(tokens), pa.array(tokens > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return joined.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
