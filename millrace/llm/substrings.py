"""Substring deduplication with a compressed FM-index per shard.

The windows of a document fall into stretches with the same anchor, the least
hash of the runs of ``GRAM`` words in the window. Equal windows have equal
anchors, so all places of a window meet in one shard. A shard indexes its
stretches in an FM-index over a wavelet matrix and streams them through a
backward search; the interval of the index that a window's matching statistics
reach tells the smallest document it starts in. Only anchors of two or more
documents go to a shard, and equal stretches go once.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import free_name, slices, written

#: Words in the runs whose least hash is the anchor of a window.
GRAM = 8
#: Words that one index holds (about), and stretches of one anchor above which their windows are dealt singly.
SHARD_WORDS, ANCHOR_STRETCHES = 500_000, 20_000

_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _WordHashes(dict):
    def __missing__(self, word):
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _sliding_least(x: np.ndarray, size: int) -> np.ndarray:
    span = 1
    while 2 * span <= size:
        x, span = np.minimum(x[:-span], x[span:]), 2 * span
    return np.minimum(x[: len(x) - (size - span)], x[size - span :]) if size > span else x


def stretches(words: list[list[bytes]], window: int) -> tuple[np.ndarray, ...]:
    """Stretches of windows with one anchor: text number, first word, number of windows, anchor, hash of their words."""
    counts = np.fromiter(map(len, words), np.int64, len(words))
    total, gram = int(counts.sum()), min(GRAM, window)
    none = np.zeros(0, np.int64)
    if not (counts >= window).any():
        return none, none, none, none, none
    known = _WordHashes()
    hashes = np.concatenate([np.fromiter(map(known.__getitem__, w), np.uint64, len(w)) for w in words])
    text = np.repeat(np.arange(len(words)), counts)
    first = np.cumsum(counts) - counts
    at = np.flatnonzero(np.repeat(first + counts, counts) - np.arange(total) >= window)
    with np.errstate(over="ignore"):
        grams = hashes[: total - gram + 1].copy()
        for i in range(1, gram):
            grams = _mix(grams) + hashes[i : total - gram + 1 + i]
        anchor = _sliding_least(_mix(grams), window - gram + 1)[at]
        new = np.ones(len(at), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (np.diff(at) > 1) | (text[at][1:] != text[at][:-1])
        begin = np.flatnonzero(new)
        many = np.diff(np.append(begin, len(at)))
        start = at[begin]
        powers, back, sums = np.full(total + 1, _BASE, np.uint64), np.full(total + 1, _BACK, np.uint64), np.zeros(total + 1, np.uint64)
        powers[0] = back[0] = 1
        powers, back = np.cumprod(powers), np.cumprod(back)
        sums[1:] = np.cumsum(hashes * powers[:-1])
        end = start + many + window - 1
        content = _mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))
    return text[start], start - first[text[start]], many, anchor[begin].view(np.int64), content.view(np.int64)


class WaveletMatrix:
    """Ranks of symbols in a sequence, in a bit row per bit of the alphabet."""

    def __init__(self, sequence: np.ndarray, bits: int):
        self.bits, self.rows = bits, []
        for level in range(bits - 1, -1, -1):
            bit = (sequence >> level & 1).astype(np.uint8)
            packed = np.packbits(np.append(bit, np.zeros(-len(bit) % 64 + 64, np.uint8)), bitorder="little").view(np.uint64)
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            zeros = len(bit) - int(bit.sum())
            self.rows.append((level, packed, before, zeros))
            order = np.argsort(bit, kind="stable")
            sequence = sequence[order]

    def place(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the first ``at`` places put the next such symbol; the rank plus the symbol's place for at = 0."""
        for level, packed, before, zeros in self.rows:
            word, inside = at >> 6, (at & 63).astype(np.uint64)
            ones = before[word] + np.bitwise_count(packed[word] & ((np.uint64(1) << inside) - np.uint64(1)))
            at = np.where(symbols >> level & 1, zeros + ones, at - ones)
        return at


class FmIndex:
    """FM-index of several sequences of symbols >= 1, each closed by a symbol 0."""

    def __init__(self, sequences: list[np.ndarray], depth: int):
        closed = np.array([0], np.int64)
        self.text = np.concatenate([x for s in sequences for x in (s, closed)])
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        self.owner = np.repeat(np.arange(len(sequences)), lengths + 1)
        n = len(self.text)
        # Ends differ from one another, so suffixes differ within the longest sequence.
        rank = np.where(self.text > 0, self.text + len(sequences), self.owner)
        rank = np.unique(rank, return_inverse=True)[1]
        span, half = 1, 1 << (depth.bit_length() - 1)
        at_half = rank if half == 1 else None
        while True:
            ahead = np.zeros(n, np.int64)
            ahead[:-span] = rank[span:] + 1
            key = rank * (n + 1) + ahead
            order = np.argsort(key, kind="stable")
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) > 0)])
            span *= 2
            if span == half:
                at_half = rank
            if rank[order[-1]] == n - 1 and span >= half:
                break
        self.order = order
        # Suffixes that share their first ``depth`` symbols are neighbours: number those classes.
        late = np.zeros(n, np.int64)
        late[: n - (depth - half)] = at_half[depth - half :] + 1
        key = (at_half * (n + 1) + late)[order]
        self.class_of = np.concatenate([[0], np.cumsum(np.diff(key) != 0)])
        last = self.text[order - 1]
        bits = max(1, int(self.text.max(initial=0)).bit_length())
        self.matrix = WaveletMatrix(last, bits)
        symbols = np.arange(int(self.text.max(initial=0)) + 1)
        self.base = self.matrix.place(symbols, np.zeros(len(symbols), np.int64))
        counts = np.bincount(self.text, minlength=len(symbols))
        self.less = np.cumsum(counts) - counts

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that begin with the symbol before those of the given intervals."""
        both = self.matrix.place(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        move = self.less[symbols] - self.base[symbols]
        return both[: len(symbols)] + move, both[len(symbols) :] + move


def least_documents(sequences: list[np.ndarray], documents: np.ndarray, depth: int) -> list[np.ndarray]:
    """For each sequence and each of its windows of ``depth`` symbols: the smallest document that has the window.

    All sequences go backwards through the index at once. A window is reached
    when its search has matched ``depth`` symbols or more; the first row of the
    interval then lies in the window's class.
    """
    index = FmIndex(sequences, depth)
    begins = np.concatenate([[0], np.flatnonzero(np.diff(index.class_of)) + 1])
    least = np.minimum.reduceat(documents[index.owner[index.order]], begins)
    lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
    flat, ends = np.concatenate(sequences), np.cumsum(lengths)
    windows = np.maximum(lengths - depth + 1, 0)
    to = np.cumsum(windows) - windows
    out = np.zeros(int(windows.sum()), np.int64)
    order = np.argsort(-lengths, kind="stable")
    low, high = np.zeros(len(order), np.int64), np.full(len(order), len(index.text))
    ascending = lengths[order][::-1]
    for step in range(int(lengths.max(initial=0))):
        n = len(order) - int(np.searchsorted(ascending, step, "right"))
        now = order[:n]
        low[:n], high[:n] = index.extend(flat[ends[now] - 1 - step], low[:n], high[:n])
        if step + 1 >= depth:
            out[to[now] + lengths[now] - 1 - step] = least[index.class_of[low[:n]]]
    return np.split(out, np.cumsum(windows)[:-1])


def _found(rows: list[tuple], window: int) -> pa.RecordBatch:
    """Runs of windows with one smallest document, for the (anchor, content, least, words) of a shard."""
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    sequences = [np.array([number(w, len(numbers) + 1) for w in text.split()], np.int64) for *_, text in rows]
    out = []
    for (anchor, content, *_), least in zip(rows, least_documents(sequences, np.array([r[2] for r in rows], np.int64), window)):
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(least)) + 1])
        out.append((anchor, content, cuts.tolist(), np.append(cuts[1:], len(least)).tolist(), least[cuts].tolist()))
    columns = list(zip(*out))
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), *(pa.array(c, pa.list_(pa.int64())) for c in columns[2:])], ["anchor", "content", "begins", "ends", "least"])


def _searched(stretches_: DataFrame, window: int) -> DataFrame:
    """(anchor, content, begins, ends, least) for (anchor, content, least, words), shard by shard."""

    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("anchor", "content", "least", "words"))):
                if size >= SHARD_WORDS and row[0] != last:
                    yield _found(held, window)
                    held, size = [], 0
                held.append(row)
                size, last = size + row[3].count(b" ") + 2, row[0]
        if held:
            yield _found(held, window)

    dealt = stretches_.select("anchor", "content", "least", "words").repartition("anchor").sortWithinPartitions("anchor", "content")
    return dealt.mapInArrow(run, "anchor bigint, content bigint, begins array<bigint>, ends array<bigint>, least array<bigint>")


def _places(docs: DataFrame, window: int) -> DataFrame:
    """(key, doc_id, first, windows, anchor, content) of every stretch."""

    def run(batches):
        for rows, texts in slices(batches, "text"):
            text, first, many, anchor, content = stretches([t.split() for t in texts], window)
            if len(text):
                at = pa.array(text)
                yield pa.RecordBatch.from_arrays([rows.column("key").take(at), rows.column("doc_id").take(at), pa.array(first, pa.int32()), pa.array(many, pa.int32()), pa.array(anchor), pa.array(content)], ["key", "doc_id", "first", "windows", "anchor", "content"])

    return docs.where("doc_id is not null").select("key", "doc_id", "text").mapInArrow(run, "key bigint, doc_id bigint, first int, windows int, anchor bigint, content bigint")


def _cut_out(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(anchor, content, part, least, words) of the wanted stretches (key, list of (anchor, content, first, windows, least, single)).

    Windows of a stretch marked ``single`` come one by one, numbered by ``part``; else ``part`` is null.
    """
    names, types = ["anchor", "content", "part", "least", "words"], (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())

    def run(batches):
        out = []
        for batch in batches:
            for text, want in zip(batch.column("text").to_pylist(), batch.column("want").to_pylist()):
                words = text.encode().split()
                for w in want:
                    begin, many = w["first"], w["windows"]
                    parts = [(None, many + window - 1)] if not w["single"] else [(i, window) for i in range(many)]
                    out += [(w["anchor"], w["content"], i, w["least"], b" ".join(words[begin + (i or 0) : begin + (i or 0) + size])) for i, size in parts]
                if len(out) > 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return docs.join(wanted, "key").select("text", "want").mapInArrow(run, "anchor bigint, content bigint, part int, least bigint, words binary")


def repeated_spans(df: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", most: int = ANCHOR_STRETCHES) -> DataFrame:
    """(key, spans): for documents with words to remove, the word ranges [begin, end) of windows that start in an earlier document.

    ``key`` is :func:`document_key`. Earlier: with a smaller id; a row without
    an id neither loses words nor makes others lose any.
    """
    docs = df.select(document_key(id_col, text_col).alias("key"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    places = written(_places(docs, window), "stretches")
    shared = places.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("anchor")
    repeated = written(places.join(shared, "anchor", "left_semi"), "shared-stretches")
    once = repeated.groupBy("anchor", "content").agg(F.min(F.struct("doc_id", "key", "first", "windows")).alias("r"))
    once = written(once.select("anchor", "content", "r.*").withColumnRenamed("doc_id", "least"), "distinct-stretches")
    hot = once.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > most).select("anchor", F.lit(True).alias("single"))
    has_hot = not hot.isEmpty()
    marked = once.join(hot, "anchor", "left") if has_hot else once.withColumn("single", F.lit(False))
    wanted = marked.groupBy("key").agg(F.collect_list(F.struct("anchor", "content", "first", "windows", "least", F.coalesce("single", F.lit(False)).alias("single"))).alias("want"))
    cut = _cut_out(docs, wanted, window)
    if not has_hot:
        found = _searched(cut, window).withColumn("part", F.lit(0))
    else:
        cut = written(cut, "cut-out")
        # Windows of an anchor with very many stretches: each distinct window is a stretch and an anchor of its own.
        parts = cut.where("part is not null").withColumn("own", F.xxhash64("words"))
        distinct = parts.groupBy("own").agg(F.min(F.struct("least", "words")).alias("m")).select(F.col("own").alias("anchor"), F.col("own").alias("content"), "m.least", "m.words")
        searched = _searched(distinct, window).select(F.col("anchor").alias("own"), "begins", "ends", "least")
        single = parts.select("anchor", "content", "part", "own").join(searched, "own").select("anchor", "content", "begins", "ends", "least", "part")
        found = _searched(cut.where("part is null"), window).withColumn("part", F.lit(0)).unionByName(single)
    hits = repeated.join(found, ["anchor", "content"]).select("key", "doc_id", "first", "part", F.explode(F.arrays_zip("begins", "ends", "least")).alias("x"))
    hits = hits.where(F.col("x.least") < F.col("doc_id"))
    base = F.col("first") + F.col("part")
    span = F.struct((base + F.col("x.begins")).cast("int").alias("begin"), (base + F.col("x.ends") + window - 1).cast("int").alias("end"))
    return hits.select("key", span.alias("s")).groupBy("key").agg(F.collect_set("s").alias("spans"))


def document_key(id_col: str, text_col: str):
    """Tells rows apart that share an id; rows alike in both are cut alike."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))


def remove_repeats(df: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", most: int = ANCHOR_STRETCHES) -> DataFrame:
    """``df`` with its text cut, and n_words, n_removed, kept_sha256 (of the kept words joined by spaces).

    A word goes if a window of ``window`` words over it also starts in a
    document with a smaller id; windows are judged on the input. A text that
    loses words keeps the white space before each kept word; others stay as
    they are. Null text has no words and stays null. Columns of ``df`` named
    like the three new ones are replaced; others stay, whatever their names. An
    empty table stays empty.
    """
    spans = repeated_spans(df, window, id_col, text_col, most)
    plain = df.drop("n_words", "n_removed", "kept_sha256")
    names = plain.columns
    key, cut = free_name(plain, "key"), free_name(plain, "spans")
    keyed = plain.withColumn(key, document_key(id_col, text_col)).join(spans.select(F.col("key").alias(key), F.col("spans").alias(cut)), key, "left").drop(key)

    def run(batches):
        for rows, texts in slices(batches, text_col):
            counts, gone, digests, kept = [], [], [], []
            for data, cuts, old in zip(texts, rows.column(cut).to_pylist(), rows.column(text_col).to_pylist()):
                words = data.split()
                counts.append(len(words))
                if not cuts:
                    gone.append(0)
                    kept.append(old)
                else:
                    dead = np.zeros(len(words) + 1, np.int64)
                    np.add.at(dead, [c["begin"] for c in cuts], 1)
                    np.add.at(dead, [c["end"] for c in cuts], -1)
                    dead = (np.cumsum(dead)[:-1] > 0).tolist()
                    gone.append(sum(dead))
                    words = [w for w, d in zip(words, dead) if not d]
                    kept.append(b"".join(m[0] for m, d in zip(_WORD.finditer(data), dead) if not d).decode())
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            columns = [pa.array(kept, pa.string()) if c == text_col else rows.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests)], [*names, "n_words", "n_removed", "kept_sha256"])

    return keyed.mapInArrow(run, T.StructType([*plain.schema.fields, *T._parse_datatype_string("n_words bigint, n_removed bigint, kept_sha256 string").fields]))


#: A word and the white space before it.
_WORD = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+")
