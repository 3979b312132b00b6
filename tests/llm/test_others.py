"""Chat formatting, embeddings and the classifier."""

import hashlib
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import chat, classifier, nn_descent

PARTS = ["### ", "</turn>", "\\", ": ", "x", "\n", "assistant", "### Assistant: ", "<", "#", "/turn>", "é"]


def test_long_runs_of_control_strings_take_linear_time():
    for text in ("\\" * 400_000 + "x" * 200_000, "### " * 100_000, "\\### </turn>\\" * 50_000, ": " * 200_000):
        began = time.process_time()
        assert chat.parse(chat.render("user", text)) == [("user", text)]
        assert time.process_time() - began < 20


def test_turns_come_back():
    rnd = random.Random(5)
    for _ in range(5000):
        role, text = ("".join(rnd.choices(PARTS, k=rnd.randrange(n))) for n in (3, 7))
        assert chat.parse(chat.render(role, text)) == [(role, text)]
    assert chat.render("user", "hi a\\b") == "### user: hi a\\b</turn>\n"
    two = chat.render("a", "\\### Assistant: </turn> ok") + chat.render("b", "")
    assert chat.parse(two) == [("a", "\\### Assistant: </turn> ok"), ("b", "")]
    for broken in ("### a", "x", "### a: b</turn>", "### a: ### b</turn>\n"):
        with pytest.raises(chat.Malformed):
            chat.parse(broken)


def test_conversations(spark):
    rnd = random.Random(2)
    rows = [(c, t, rnd.choice(["user", "assistant", None, "system"]), rnd.choice([None, "", "".join(rnd.choices(PARTS, k=5))]), "q") for c in (1, 2, 3, None) for t in range(rnd.randrange(1, 9))]
    rows += [(3, 0, "user", "again", "q"), (3, None, "assistant", "no turn", "q")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat.chat_round_trip(frame).collect()}
    by = defaultdict(list)
    for c, t, role, text, _ in rows:
        by[c].append(((t is not None, t or 0), chat.render(role or "", text or ""), role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort(key=lambda x: x[:2])
        said = "".join(t for *_, role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for *_, role, t in turns)
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert r["formatted_chars"] == sum(len(x[1]) for x in turns)
    assert chat.chat_round_trip(frame.limit(0)).count() == 0


def brute(ids, vectors):
    units = []
    for v in vectors:
        good = v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
        units.append(np.array(v, float) / np.linalg.norm(v) if good else np.full(0, np.nan))
    lengths, wide = np.array([len(u) for u in units]), max(map(len, units), default=0)
    units = np.array([np.pad(u, (0, wide - len(u))) for u in units])
    hit = (units @ units.T >= 0.95) & (lengths[:, None] == lengths[None, :]) & (lengths[:, None] > 0)
    np.fill_diagonal(hit, False)
    root = list(range(len(ids)))
    for _ in range(len(ids)):
        new = [min([root[i], *(root[j] for j in np.flatnonzero(hit[i]))]) for i in range(len(ids))]
        if new == root:
            break
        root = new
    least = defaultdict(lambda: 10**9)
    for i, r in enumerate(root):
        least[r] = min(least[r], ids[i])
    return Counter((ids[i], int(hit[i].sum()), least[root[i]], ids[i] == least[root[i]]) for i in range(len(ids)))


@pytest.mark.parametrize("block", [16, 1024])
def test_embeddings(spark, block, monkeypatch):
    monkeypatch.setattr(nn_descent, "BLOCK", block)
    rng = np.random.default_rng(9)
    vectors = [v.tolist() for v in rng.standard_normal((250, 16))]
    dense = rng.standard_normal(16)
    vectors += [(dense + 0.08 * rng.standard_normal(16)).tolist() for _ in range(60)]  # more links than a list holds
    vectors += [(np.array(vectors[i]) + 0.15 * rng.standard_normal(16)).tolist() for i in range(30)] + vectors[:10] + [(2 * np.array(vectors[3])).tolist()]
    vectors += [[1.0, 2.0, 3.0], [2.0, 4.0, 6.0], [1.1, 2.0, 3.0], [-1.0, 0.0, 0.5], [3.0] * 20, [3.0] * 19 + [2.9], [1.0]]  # rarer lengths
    vectors += [None, [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [], [1.0] * 15]
    ids = rng.permutation(len(vectors)).tolist()
    frame = spark.createDataFrame([(i, v, 1, "q") for i, v in zip(ids, vectors)], "vec_id bigint, embedding array<double>, label int, node string")
    assert Counter(map(tuple, nn_descent.embedding_near_duplicates(frame).collect())) == brute(ids, vectors)
    assert nn_descent.embedding_near_duplicates(frame.limit(0)).count() == 0
    assert nn_descent.embedding_near_duplicates(frame.where("embedding is null")).collect()[0]["kept"]


@pytest.mark.parametrize("block", [7, 1024])
def test_links_between_dense_groups(spark, block, monkeypatch):
    monkeypatch.setattr(nn_descent, "BLOCK", block)
    monkeypatch.setattr(nn_descent, "WIDENINGS", 0)
    rng = np.random.default_rng(4)
    x, y, z = np.linalg.qr(rng.standard_normal((16, 3)))[0].T
    centres = [x, 0.96 * x + np.sqrt(1 - 0.96**2) * y, z]  # the first two groups are linked, the third is not
    vectors = [(c + 0.002 * rng.standard_normal(16)).tolist() for c in centres for _ in range(20)]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    assert Counter(map(tuple, nn_descent.embedding_near_duplicates(frame).collect())) == brute(range(len(vectors)), vectors)


def test_audit_sees_missing_links(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((20, 16))
    units = [x / np.linalg.norm(x) for x in np.concatenate([base, base + 1e-3])]
    nodes = spark.createDataFrame([(i, 1, bytearray(u.astype("<f8").tobytes())) for i, u in enumerate(units)], "node bigint, copies bigint, unit binary")
    found = spark.createDataFrame([(i, 1) for i in range(0, 40, 2)], "node bigint, n bigint")
    assert nn_descent.audited_recall(nodes, found, 0.95) == 0.5


def test_audit_counts_vectors_not_links(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal(16)
    base = rng.standard_normal((10, 16))
    units = [v / np.linalg.norm(v) for v in np.concatenate([x + 1e-3 * rng.standard_normal((80, 16)), base, base + 1e-3])]
    nodes = spark.createDataFrame([(i, 1, bytearray(u.astype("<f8").tobytes())) for i, u in enumerate(units)], "node bigint, copies bigint, unit binary")
    found = spark.createDataFrame([(i, 79) for i in range(80)], "node bigint, n bigint")  # nothing of the pairs
    assert nn_descent.audited_recall(nodes, found, 0.95) == 0


@pytest.mark.parametrize("block", [9, 1024])
def test_all_are_compared_if_the_graph_falls_short(spark, block, monkeypatch):
    monkeypatch.setattr(nn_descent, "BLOCK", block)
    monkeypatch.setattr(nn_descent, "WIDENINGS", 0)
    empty = spark.createDataFrame([], "node bigint, list array<struct<cosine: float, other: bigint>>")
    monkeypatch.setattr(nn_descent, "neighbour_graph", lambda *a: empty)
    rng = np.random.default_rng(6)
    base = rng.standard_normal((15, 16))
    vectors = [v.tolist() for v in np.concatenate([base, base[:10] + 0.1 * rng.standard_normal((10, 16)), base[:3]])]
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>")
    assert Counter(map(tuple, nn_descent.embedding_near_duplicates(frame).collect())) == brute(range(len(vectors)), vectors)


def test_classifier(spark, odd, odd_rows):
    rnd = random.Random(10)
    rows, labels = [], []
    for i in range(400):
        words = [rnd.choice("the and of with from word other text here some more".split()) + rnd.choice(["", "s", "ing"]) for _ in range(rnd.randrange(5, 90))]
        good = i % 4 > 0
        rows.append((i, " ".join(words) + "." if good else " ".join(w + rnd.choice(["%%%", "###", " |"]) for w in words)))
        labels.append((i, int(good)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id bigint, quality int")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = classifier.train(frame, marks.where(~held))
    twice = classifier.train(frame.union(frame).union(frame.limit(5)), marks.where(~held))
    assert np.allclose(model[2], twice[2])  # repeated documents count once
    got = {r["doc_id"]: r["score"] for r in classifier.score(frame, model).collect()}
    out = [(got[i] >= classifier.THRESHOLD) == bool(q) for i, q in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(out) > 50 and sum(out) / len(out) > 0.97
    scored = classifier.score(odd, model).collect()
    assert len(scored) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in scored)
    empty = classifier.train(frame.limit(0), marks)
    assert {round(r["score"], 6) for r in classifier.score(frame.limit(3), empty).collect()} and classifier.score(frame.limit(0), model).count() == 0
