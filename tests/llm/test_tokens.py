"""Token ids, Huffman files, token counts and packing against the libraries."""

import uuid
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from millrace.llm import best_fit, huffman_ids, piece_counts
from millrace.llm.tokens import TextIds
from millrace.session import scratch_root

WORD, BYTE, PIECE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
HARD = ["", " ", "a  b\n\nc\td ", "<|endoftext|> x<|endoftext|>y", "it's 'Re don't", "a \n\nb", "ΣΑΣ İx Å", "́abc 12 4a", "x\r\ny  ", "a\x1cb !\x1cb", "a \n\nb", "café café ﬁ", "a\n b", "\n", " a"]


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("kept", [3, 10**6])
def test_ids_equal_the_library(path, kept, odd_rows):
    texts = HARD + [t or "" for _, t in odd_rows]
    table, whole = TextIds(path, kept), Tokenizer.from_file(path)
    want = [x.ids for x in whole.encode_batch(texts, add_special_tokens=False)]
    for part in (texts[:9], texts[9:]):
        ids, counts = table.encode([t.encode() for t in part])
        ends = np.cumsum(counts)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == want[: len(part)]
        want = want[len(part) :]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_of_random_texts_equal_the_library(path):
    rng = np.random.default_rng(4)
    signs = [*"ab Zé\n\t.,'%*#<|>0", "\u2003", "日", "ß", "  ", "\n\n", "\r\n", "word", "Word ", "</s>", "ﬁ", "\x1c"]
    texts = ["".join(rng.choice(signs, rng.integers(0, 40))) for _ in range(1500)]
    plain = [" ".join(rng.choice(["Étion", "dans", "aipa%%%", "ierç,", "99", "x\ny"], rng.integers(1, 12))) for _ in range(300)]
    table, whole = TextIds(path), Tokenizer.from_file(path)
    texts = [t for pair in zip(texts, plain * 5) for t in pair]
    for begin in range(0, len(texts), 400):
        part = texts[begin : begin + 400]
        ids, counts = table.encode([t.encode() for t in part])
        ends = np.cumsum(counts)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == [x.ids for x in whole.encode_batch(part, add_special_tokens=False)]


@pytest.mark.parametrize("limit", [6, 9, 18])
def test_code_lengths(limit):
    rng = np.random.default_rng(limit)
    counts = rng.integers(0, 1000, 50)
    counts[0] = 10**6
    lengths = huffman_ids.code_lengths(counts, limit).astype(int)
    assert lengths.max() <= limit and ((lengths > 0) == (counts > 0)).all() and sum(2.0**-n for n in lengths if n) <= 1
    codes = huffman_ids.canonical_codes(lengths.astype(np.uint8))
    ids, n = rng.permutation(np.repeat(np.arange(50), np.minimum(counts, 300))), None
    n = np.array([0, 3, len(ids) - 10, 7])
    data, bounds, inside = huffman_ids.pack_bits(ids, n, codes, lengths.astype(np.uint8))
    first = np.cumsum(n) - n
    starts = np.concatenate([bounds[k] * 8 + inside[first[k] : first[k] + n[k] : 256] for k in range(4)])
    sizes = np.concatenate([np.minimum(256, n[k] - np.arange(0, n[k], 256)) for k in range(4)])
    assert (huffman_ids.unpack_bits(data, starts, sizes, huffman_ids.decode_table(lengths.astype(np.uint8), limit), limit) == ids).all()


def test_code_lengths_are_optimal_without_a_tight_limit():
    counts = np.array([5, 1, 1, 2, 8, 13])
    assert (counts * huffman_ids.code_lengths(counts)).sum() == 2 + 4 + 9 + 17 + 30  # the sums of the merges
    assert huffman_ids.code_lengths(np.array([0, 4])).tolist() == [0, 1] and huffman_ids.code_lengths(np.zeros(3, int)).tolist() == [0, 0, 0]


@pytest.mark.parametrize("part_ids", [10**6, 2000])
def test_id_files(spark, odd, odd_rows, part_ids, monkeypatch):
    monkeypatch.setattr(huffman_ids, "PART_IDS", part_ids)
    monkeypatch.setattr(huffman_ids, "BLOCK_BYTES", 3000)
    path = f"{scratch_root(spark)}/{uuid.uuid4().hex}"
    got = huffman_ids.huffman_id_file(odd, path, WORD, 2).collect()
    whole = Tokenizer.from_file(WORD)
    ids = lambda t: np.array(whole.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in got) == Counter((i, ids(t)) for i, t in odd_rows)
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at and r["n_tokens"] * 4 == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(bytes(r["ids"]))
        at += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda i: (i is not None, i))


def test_no_documents(spark, none):
    assert huffman_ids.huffman_id_file(none, f"{scratch_root(spark)}/{uuid.uuid4().hex}", WORD, 2).count() == 0
    assert piece_counts.piece_counts(none, PIECE, 10).count() == 0
    assert best_fit.pack_documents(none, BYTE, 0, 64).count() == 0


def test_piece_counts(spark, odd, odd_rows, monkeypatch):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(HARD)], "doc_id bigint, text string")
    both = odd.select("doc_id", "text").union(more)
    got = Counter(map(tuple, piece_counts.piece_counts(both, PIECE, 20).collect()))
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(HARD)]
    assert got == Counter((i, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 20) for i, t in rows)
    empty = spark.createDataFrame([(1, ""), (2, None)], "doc_id bigint, text string")
    assert sorted(map(tuple, piece_counts.piece_counts(empty, PIECE, 20).collect())) == [(1, 0, 0, False), (2, 0, 0, False)]


def test_plan_uses_every_piece():
    rng = np.random.default_rng(4)
    for _ in range(100):
        histogram = np.zeros(31, int)
        for length in rng.integers(1, 31, rng.integers(0, 60)):
            histogram[length] += rng.integers(1, 5)
        used, made = np.zeros(31, int), best_fit.plan(histogram)
        for parts, times in made:
            assert sum(parts) <= 30 and times > 0
            for p in parts:
                used[p] += times
        assert (used == histogram).all()


def test_plan_takes_exact_complements():
    histogram = np.zeros(101, int)
    histogram[[60, 40, 50, 30, 20, 25, 15]] = [3, 1, 1, 1, 2, 1, 1]
    made = best_fit.plan(histogram)
    full = sum(times for parts, times in made if sum(parts) == 100)
    assert full >= 2 and sum(t for _, t in made) <= 4


@pytest.mark.parametrize("lot_rows", [10**6, 2])
def test_packing(spark, odd, odd_rows, lot_rows, monkeypatch):
    monkeypatch.setattr(best_fit, "LOT_ROWS", lot_rows)
    cap = 64
    got = best_fit.pack_documents(odd, BYTE, 0, cap).toPandas()
    whole = Tokenizer.from_file(BYTE)
    docs = [(i, np.array(whole.encode(t or "", add_special_tokens=False).ids + [0], "<u4")) for i, t in odd_rows]
    want = Counter()
    for i, ids in docs:
        first = len(ids) - (-(-len(ids) // cap) - 1) * cap
        cuts = [0, *range(first, len(ids) + 1, cap)]
        for k, (b, e) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, b, e - b, zlib.crc32(ids[b:e].tobytes())] += 1
    ids = [None if x != x else int(x) for x in got.doc_id]
    assert Counter(zip(ids, got.piece, got.start, got.length, got.ids_crc32)) == want
    for _, rows in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert rows.offset.tolist() == (np.cumsum(rows.length) - rows.length).tolist() and rows.length.sum() <= cap
    bound = -(-sum(len(x) for _, x in docs) // cap)
    assert got.sequence_id.nunique() <= bound + 1


def test_pack_refuses_other_lengths(spark):
    with pytest.raises(ValueError):
        best_fit.pack(spark.createDataFrame([(1, 0, 65)], "row bigint, piece int, length bigint"), 64)
