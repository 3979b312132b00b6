"""The queries of the operators and of the pipeline, with SQL where it can express them."""

from __future__ import annotations

import uuid

import public_tokenizers

from pyspark.sql import functions as F

from millrace.llm import classifier
from millrace.llm.batches import read, written
from millrace.llm.best_fit import pack_documents
from millrace.llm.chat import chat_round_trip
from millrace.llm.chat_repair import repair_report
from millrace.llm.huffman_ids import encode_ids, read_ids, write_ids
from millrace.llm.mixing import mix_by_source
from millrace.llm.nn_descent import embedding_near_duplicates
from millrace.llm.piece_counts import piece_counts
from millrace.llm.quality_rules import quality_rules
from millrace.llm.simhash import near_duplicates
from millrace.llm.substrings import remove_repeats
from millrace.llm.vector_codes import compress_vectors
from millrace.llm.warc import pages_to_warc, read_pages
from millrace.session import scratch_root


def op1_huffman_ids(spark, folder):
    path = f"{scratch_root(spark).rstrip('/')}/llm-id-file-{uuid.uuid4().hex}"
    ids = encode_ids(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2)
    write_ids(written(ids, "ids"), path)
    return read_ids(spark, path, with_ids=False)


def op2_simhash_near_dedup(spark, folder):
    return near_duplicates(read(spark, folder, "documents"), 3, 2)


def op3_piece_counts(spark, folder):
    return piece_counts(read(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), 4096)


def op4_best_fit_packing(spark, folder):
    return pack_documents(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 0, 2048)


def op5_chat_formatting(spark, folder):
    said = r"\### Assistant: </turn> ok"
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat_round_trip(rows.union(more))


def op6_source_mixing(spark, folder):
    return mix_by_source(read(spark, folder, "documents"))


def op7_substring_dedup(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return remove_repeats(docs, 50).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_quality_rules(spark, folder):
    return quality_rules(read(spark, folder, "documents"))


def op9_embedding_near_dedup(spark, folder):
    return embedding_near_duplicates(read(spark, folder, "embeddings"), 0.95)


def op10_quality_classifier(spark, folder):
    docs = read(spark, folder, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = classifier.train(docs, read(spark, folder, "labels").where(~held_out))
    scored = classifier.score(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= classifier.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op11_vector_codes(spark, folder):
    return compress_vectors(read(spark, folder, "embeddings"))


def op12_conversation_repair(spark, folder):
    return repair_report(read(spark, folder, "conversations"))


def op13_warc(spark, folder):
    path = f"{scratch_root(spark).rstrip('/')}/llm-warc-{uuid.uuid4().hex}"
    pages_to_warc(read(spark, folder, "pages"), path)
    return read_pages(spark, path)


QUERIES = {f.__name__: f for f in (
    op1_huffman_ids, op2_simhash_near_dedup, op3_piece_counts, op4_best_fit_packing, op5_chat_formatting,
    op6_source_mixing, op7_substring_dedup, op8_quality_rules, op9_embedding_near_dedup, op10_quality_classifier,
    op11_vector_codes, op12_conversation_repair, op13_warc,
)}
SQL: dict[str, str] = {}
