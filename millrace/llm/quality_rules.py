"""Quality rules as a short-circuit cascade ordered on a sample.

Every rule has a cost and rejects some documents; both are estimated on a
sample, and rules run in the order of rejections per cost until one rejects.
The order changes the work, never the verdict: a document is kept if no rule
rejects it.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textstats
from millrace.llm.batches import slices

#: Rows of the sample on which costs and rejections are estimated.
SAMPLE_ROWS = 2000


class Text:
    """A text whose parts are found when a rule first asks for them."""

    def __init__(self, data: bytes, words: list[bytes], n_symbols: int, n_chars: int):
        self.data, self.words, self.n_symbols, self.n_chars = data, words, n_symbols, n_chars

    def __getattr__(self, name):
        if name != "lines":
            raise AttributeError(name)
        self.lines = textstats.lines(self.data)
        return self.lines


def _symbols(t: Text) -> bool:
    """More than one symbol in ten words."""
    return 10 * t.n_symbols > len(t.words)


def _word_length(t: Text) -> bool:
    """Mean word shorter than 2 or longer than 20 characters."""
    return not 2 * len(t.words) <= t.n_chars <= 20 * len(t.words)


def _repeated_lines(t: Text) -> bool:
    """At least ten lines, more than 30 % of which equal an earlier one."""
    return len(t.lines) >= 10 and 10 * (len(t.lines) - len(set(t.lines))) > 3 * len(t.lines)


def _no_letters(t: Text) -> bool:
    """More than 40 % of the words without a letter."""
    return 5 * sum(not (w.isalpha() or any(c > 127 or chr(c).isalpha() for c in w)) for w in t.words) > 2 * len(t.words)


def _bullets(t: Text) -> bool:
    """At least ten lines, more than 90 % of which are list items."""
    return len(t.lines) >= 10 and 10 * sum(x.lstrip()[:1] in (b"-", b"*", b"+") or x.lstrip().startswith("•".encode()) for x in t.lines) > 9 * len(t.lines)


def _cut_lines(t: Text) -> bool:
    """At least ten lines, more than half of which end in an ellipsis."""
    return len(t.lines) >= 10 and 2 * sum(x.rstrip().endswith((b"...", "…".encode())) for x in t.lines) > len(t.lines)


def _one_word(t: Text) -> bool:
    """At least ten words, more than half of which are one and the same."""
    return len(t.words) >= 10 and 2 * max(Counter(t.words).values()) > len(t.words)


def _stutter(t: Text) -> bool:
    """At least ten words, more than 30 % of which equal the word before."""
    return len(t.words) >= 10 and 10 * sum(map(bytes.__eq__, t.words, t.words[1:])) > 3 * len(t.words)


RULES: dict[str, Callable[[Text], bool]] = {f.__name__[1:]: f for f in (_symbols, _word_length, _repeated_lines, _no_letters, _bullets, _cut_lines, _one_word, _stutter)}


def _base(texts: list[bytes]):
    """Words, and the base measures of every text."""
    words = [t.split() for t in texts]
    lines = [textstats.lines(t) for t in texts]
    return words, {
        "n_words": np.fromiter(map(len, words), np.int64, len(texts)),
        "word_chars": np.fromiter(map(textstats.word_chars, texts), np.int64, len(texts)),
        "n_symbols": np.fromiter(map(textstats.symbols, texts), np.int64, len(texts)),
        "n_dup_lines": np.fromiter((len(x) - len(set(x)) for x in lines), np.int64, len(texts)),
        "n_repeat_words": textstats.repeated_words(words),
    }


def _failed(base: dict) -> np.ndarray:
    return (base["n_words"] < 10) | (100 * base["n_repeat_words"] > 20 * base["n_words"])


def rule_order(df: DataFrame, text_col: str = "text", rules: dict | None = None, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Names of the rules by rejections per second of cost, on a random sample of about ``sample_rows`` rows."""
    rules = rules or RULES
    count = df.count()
    texts = df.select(F.col(text_col).alias("text"))
    if count > sample_rows:
        texts = texts.sample(sample_rows / count, seed=8)

    def run(batches):
        spent, rejected = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0)
        for _, data in slices(batches, "text"):
            words, base = _base(data)
            for i in np.flatnonzero(~_failed(base)).tolist():
                for name, rule in rules.items():
                    text = Text(data[i], words[i], int(base["n_symbols"][i]), int(base["word_chars"][i]))
                    began = time.perf_counter()
                    rejected[name] += rule(text)
                    spent[name] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict({"rule": list(rules), "spent": list(spent.values()), "rejected": list(rejected.values())})

    found = texts.mapInArrow(run, "rule string, spent double, rejected bigint").groupBy("rule").agg(F.sum("spent").alias("s"), F.sum("rejected").alias("r")).collect()  # a row per rule
    gain = {x["rule"]: x["r"] / max(x["s"], 1e-9) for x in found}
    return sorted(rules, key=lambda n: (-gain.get(n, 0.0), n))


def _verdicts(df: DataFrame, text_col: str, rules: dict | None) -> Callable:
    """Base measures, base verdict and verdict of a list of texts."""
    rules = rules or RULES
    order = [rules[n] for n in rule_order(df, text_col, rules)]

    def judge(texts: list[bytes]):
        words, base = _base(texts)
        failed = _failed(base)
        kept = ~failed
        for i in np.flatnonzero(kept).tolist():
            text = Text(texts[i], words[i], int(base["n_symbols"][i]), int(base["word_chars"][i]))
            kept[i] = not any(rule(text) for rule in order)  # stops at the first that rejects
        return base, failed, kept

    return judge


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict | None = None) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) for every row.

    Null text is empty, which fails the base rule (fewer than ten words). Null
    and repeated doc_ids stay rows of their own; other columns are not read.
    Windows are compared by 64-bit hashes of their words.
    """
    judge = _verdicts(df, text_col, rules)

    def run(batches):
        for rows, texts in slices(batches, "text"):
            base, failed, kept = judge(texts)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *map(pa.array, base.values()), pa.array(failed), pa.array(kept)], ["doc_id", *base, "base_failed", "kept"])

    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean")


def keep_good(df: DataFrame, text_col: str = "text", rules: dict | None = None) -> DataFrame:
    """The rows of ``df``, all columns, that pass the base rule and the cascade; null text is empty."""
    judge = _verdicts(df, text_col, rules)

    def run(batches):
        for rows, texts in slices(batches, text_col):
            yield rows.filter(pa.array(judge(texts)[2]))

    return df.mapInArrow(run, df.schema)
