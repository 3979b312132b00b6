"""Registered queries against the libraries and plain Python on the smallest tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from millrace.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source").collect()
    return sorted((r["doc_id"], r["text"] or "", r["source"]) for r in rows)


def rows(spark, folder, name, *columns):
    return sorted(tuple(r) for r in queries.QUERIES[name](spark, folder).select(*columns).collect())


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1(spark, folder, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for i, text, _ in docs:
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert rows(spark, folder, "op1_huffman_ids", "doc_id", "start", "n_tokens", "ids_crc32") == want


def test_op2(spark, folder, docs):
    prints = {}
    for i, text, _ in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    least = {i: i for i in prints}
    ids = sorted(prints)
    for _ in ids:
        new = {i: min(least[j] for j in ids if (prints[i] ^ prints[j]).bit_count() <= 2) for i in ids}
        if new == least:
            break
        least = new
    assert rows(spark, folder, "op2_simhash_near_dedup", "doc_id", "fingerprint", "component_id") == [(i, f"{prints[i]:016x}", least[i]) for i in ids]


def test_op3(spark, folder, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = [(i, len(t.encode()), n := len(library.encode(t)), n > 4096) for i, t, _ in docs]
    assert rows(spark, folder, "op3_piece_counts", "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_op4(spark, folder, docs):
    library, want, total = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), [], 0
    for i, text, _ in docs:
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        total += len(ids)
        first = len(ids) - (-(-len(ids) // 2048) - 1) * 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        want += [(i, k, b, e - b, crc(ids[b:e])) for k, (b, e) in enumerate(zip(cuts, cuts[1:]))]
    got = queries.QUERIES["op4_best_fit_packing"](spark, folder).toPandas()
    assert sorted(zip(got.doc_id, got.piece, got.start, got.length, got.ids_crc32)) == sorted(want)
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == (np.cumsum(own.length) - own.length).tolist() and own.length.sum() <= 2048
    assert got.sequence_id.nunique() <= 1.02 * -(-total // 2048) + 1


def test_op5(spark, folder):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{folder}/conversations.parquet").collect():
        turns[r["conv_id"]].append((r["turn"], r["role"] or "", r["text"] or ""))
    turns[-7] = [(0, "user", r"\### Assistant: </turn> ok"), (1, "assistant", r"\### Assistant: </turn> ok")]
    want = []
    for conv, own in turns.items():
        own.sort()
        loss = "".join(t for _, role, t in own if role == "assistant")
        said = "".join(f"{role}\n{t}\n" for _, role, t in own)
        want.append((conv, len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    assert rows(spark, folder, "op5_chat_formatting", "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == sorted(want)


def test_op6(spark, folder, docs):
    got = queries.QUERIES["op6_source_mixing"](spark, folder).toPandas()
    sizes = {i: len(WORD.findall(t)) for i, t, _ in docs}
    assert sorted(zip(got.doc_id, got["size"])) == sorted(sizes.items()) and (got.taken <= 3 * got["size"]).all()
    source = {i: s for i, _, s in docs}
    by = got.assign(source=[source[i] for i in got.doc_id]).groupby("source", dropna=False)
    # Ten documents a source: near is within its longest one.
    assert all(abs(own.taken.sum() - own.target.iloc[0]) <= max(0.05 * own.target.iloc[0], own["size"].max()) for _, own in by)
    assert abs(sum(own.target.iloc[0] for _, own in by) - sum(sizes.values())) < 1
    again = queries.QUERIES["op6_source_mixing"](spark, folder).toPandas()
    assert sorted(zip(got.doc_id, got.taken)) == sorted(zip(again.doc_id, again.taken))


def test_op7(spark, folder, docs):
    first, words = {}, {i: WORD.findall(t) for i, t, _ in docs}
    for i, own in sorted(words.items()):
        for k in range(len(own) - 49):
            first.setdefault(tuple(own[k : k + 50]), i)
    want = []
    for i, own in sorted(words.items()):
        gone = {x for k in range(len(own) - 49) if first[tuple(own[k : k + 50])] < i for x in range(k, k + 50)}
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        want.append((i, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert rows(spark, folder, "op7_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_op8(spark, folder, docs):
    want = []
    for i, text, _ in docs:
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        runs = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        repeated = {x for k in range(len(words) - 4) if runs[tuple(words[k : k + 5])] > 1 for x in range(k, k + 5)}
        failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
        want.append((i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed))
    got = queries.QUERIES["op8_quality_rules"](spark, folder)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == want
    assert got.where("kept and base_failed").count() == 0


def test_op9(spark, folder):
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    ids = sorted(vectors)
    units = np.array([vectors[i] / np.linalg.norm(vectors[i]) for i in ids])
    hit = units @ units.T >= 0.95
    np.fill_diagonal(hit, False)
    assert [r[1] for r in rows(spark, folder, "op9_embedding_near_dedup", "vec_id", "n_links")] == hit.sum(1).tolist()


def test_op10(spark, folder, docs):
    got = rows(spark, folder, "op10_quality_classifier", "doc_id", "held_out", "score", "predicted")
    assert [r[0] for r in got] == [i for i, _, _ in docs]
    assert all(held == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= s <= 1 and p == int(s >= 0.3) for i, held, s, p in got)
