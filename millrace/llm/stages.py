"""Stages of the corpus pipeline: (name, function of (spark, docs, sf_dir)).

All but the last return the columns of ``documents``; each works on every row
that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from millrace.llm.batches import free_name
from millrace.llm.best_fit import pack_documents
from millrace.llm.mixing import mix, word_count
from millrace.llm.quality_rules import keep_good
from millrace.llm.simhash import drop_similar
from millrace.llm.substrings import remove_repeats


def quality(spark, docs, folder):
    """Documents that fail the base rule or the cascade go."""
    return keep_good(docs)


def near_dedup(spark, docs, folder):
    """One document of each component at 2 or fewer differing bits over three-word shingles stays, the smallest id."""
    return drop_similar(docs, 3, 2)


def substring_dedup(spark, docs, folder):
    """Words of 50-word windows that an earlier document has go; ``n_chars`` follows the text."""
    return remove_repeats(docs, 50).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixing(spark, docs, folder):
    """Documents as often as the mix takes them: rows repeat, those taken 0 times go.

    Rows alike in id and text share their number of uses, rounded.
    """
    key, times, use = (free_name(docs, n) for n in ("key", "times", "use"))
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    taken, _ = mix(keyed, F.array("source"), word_count(F.col("text")), passing=(key,))
    counted = taken.groupBy(key).agg(F.round(F.avg("times")).cast("int").alias(times)).where(F.col(times) > 0)
    return keyed.join(counted, key).withColumn(use, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)


def packing(spark, docs, folder):
    """Pieces of all remaining documents with their sequence and offset."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 0, 2048)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources", mixing),
    ("best-fit packing", packing),
]
