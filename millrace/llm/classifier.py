"""Quality classifier: Bradley-Terry ranking of preference pairs.

A pair is a document of label 1 and one of label 0; the scores' difference is
linear in the difference of their features and fitted by logistic loss. The cut
is a quantile of the training scores, placed at ``THRESHOLD`` of the output.
"""

from __future__ import annotations



import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textstats
from millrace.llm.batches import slices

#: Bound on the labelled rows that are fitted, and on the pairs made of them.
TRAIN_ROWS, PAIRS = 20_000, 60_000
#: Output score of the cut.
THRESHOLD = 0.3

_DIGITS, _STOPS, _UPPER = bytes(range(48, 58)), b".,;:!?", bytes(range(65, 91))
_NOT_ASCII = bytes(range(128, 256))


def features(texts: list[bytes]) -> np.ndarray:
    """Measures of each text; ratios also as logarithms."""
    words = [t.split() for t in texts]
    n = np.fromiter(map(len, words), np.float64, len(texts))
    some, bare = np.maximum(n, 1), lambda drop: np.array([len(t) - len(t.translate(None, drop)) for t in texts], np.float64)
    rows = [textstats.lines(t) for t in texts]
    n_lines = np.maximum(np.fromiter(map(len, rows), np.float64, len(texts)), 1)
    ratios = [
        bare(textstats.SYMBOLS) / some,
        np.array([t.count(b"|") for t in texts]) / some,
        np.array([len(x) - len(set(x)) for x in rows]) / n_lines,
        textstats.repeated_words(words) / some,
        textstats.repeated_words(words, 2) / some,
        np.array([len(set(w)) for w in words]) / some,
        np.array([sum(map(bytes.__eq__, w, w[1:])) for w in words]) / some,
        bare(_STOPS) / some,
        bare(_DIGITS) / some,
        bare(_UPPER) / some,
        bare(_NOT_ASCII) / some,
        n_lines / some,
        np.array([sum(len(x) <= 3 for x in w) for w in words]) / some,
        np.array([max(map(len, w), default=0) for w in words]) / 50,
    ]
    length = np.array([textstats.word_chars(t) for t in texts]) / some
    both = np.minimum(np.stack(ratios, 1), 10)
    return np.column_stack([both, np.log(both + 0.01), np.log1p(n), length, length**2 / 10, n == 0])


def fit_pairs(x: np.ndarray, label: np.ndarray, pairs: int = PAIRS, rounds: int = 300, seed: int = 10):
    """(mean, scale, weights, cut, spread) from random pairs of the two labels.

    Without both labels the weights are zero: every score is the same.
    """
    mean, scale = x.mean(0) if len(x) else np.zeros(x.shape[1]), x.std(0) + 1e-6 if len(x) else np.ones(x.shape[1])
    z = np.clip((x - mean) / scale, -8, 8)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    w = np.zeros(x.shape[1])
    if not len(good) or not len(bad):
        return mean, scale, w, -1.0, 1.0
    rng = np.random.default_rng(seed)
    d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        slope = -(d.T @ (1 / (1 + np.exp(np.clip(d @ w, -30, 30))))) / len(d) + 1e-4 * w
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        w -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    score = z @ w
    # The quantile with the best balance of both labels.
    order = np.sort(score)
    cuts = np.unique(np.quantile(order, np.linspace(0, 1, 1001)))
    low_good = np.searchsorted(np.sort(score[good]), cuts) / len(good)
    low_bad = np.searchsorted(np.sort(score[bad]), cuts) / len(bad)
    value = low_bad - low_good
    best = np.flatnonzero(value >= value.max() - 1e-12)
    return mean, scale, w, float(cuts[best].mean()), float(score.std() + 1e-9)


def train(df: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"):
    """Fit on at most ``train_rows`` labelled rows, those with the smallest hash of their id.

    Null ids and labels are left out; of several labels of an id the smallest
    counts, of several texts the smallest. No labelled rows: every score is the
    same. Other columns are not read.
    """
    some = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.min(label_col).cast("int").alias("label"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(some), "doc_id")  # train_rows at most
    # One row per id, before anything comes to the driver.
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def run(batches):
        for part, texts in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(features(texts).tolist(), pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    found = rows.select("doc_id", "label", "text").mapInArrow(run, "doc_id bigint, label int, x array<double>").toPandas().sort_values("doc_id")
    x = np.array(found["x"].tolist(), np.float64).reshape(len(found), -1 if len(found) else features([b""]).shape[1])
    return fit_pairs(x, found["label"].to_numpy())


def score(df: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row; null text is empty. The training cut has the score ``THRESHOLD``."""
    mean, scale, w, cut, spread = model
    base = np.log(THRESHOLD / (1 - THRESHOLD))

    def run(batches):
        for part, texts in slices(batches, "text"):
            value = np.clip((features(texts) - mean) / scale, -8, 8) @ w
            out = 1 / (1 + np.exp(-np.clip(4 * (value - cut) / spread + base, -30, 30)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out)], ["doc_id", "score"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id bigint, score double")
