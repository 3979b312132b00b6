import hashlib
from collections import defaultdict

import numpy as np
import pytest

from millrace.llm import queries
from millrace.llm.vector_codes import assign, compress_vectors, decode, digest, fit_codes, in_parts, whole_numbers


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    """(id, label, vector) rows, each compared with every entry; vectors of one length."""
    kept = [(i, label, [int(np.floor(float(x) * scale)) for x in v]) for i, label, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[2]))
    width = -(-len(kept[0][2]) // parts)
    x = np.zeros((len(kept), parts * width), np.int64)
    for k, r in enumerate(kept):
        x[k, : len(r[2])] = r[2]
    x = x.reshape(len(kept), parts, width)
    book = x[:entries].copy()
    for turn in range(rounds + 1):
        d = ((x[:, None] - book[None]) ** 2).sum(3)
        code = d.argmin(1)
        if turn == rounds:
            break
        new = book.copy()
        for p in range(parts):
            for e in range(len(book)):
                own = x[code[:, p] == e, p]
                if len(own):
                    new[e, p] = own.sum(0) // len(own)
        book = new
    error = d.min(1).sum(1)
    totals = defaultdict(int)
    for (_, label, _), e in zip(kept, error):
        totals[label] += int(e)
    sha = hashlib.sha256(",".join(str(int(c)) for p in range(parts) for e in range(len(book)) for c in book[e, p]).encode()).hexdigest()
    return sorted(((i, "".join(f"{c:02x}" for c in row), int(e), totals[label], sha) for (i, label, _), row, e in zip(kept, code, error)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def test_query_equals_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    got = found(queries.QUERIES["op11_vector_codes"](spark, folder))
    assert got == brute(rows) and len({r[1] for r in got}) > 50


ODD = [
    (1, 1, None), (2, None, [1.0] * 16), (3, None, [None, *[1.0] * 15]), (4, 1, [float("nan"), *[0.5] * 15]), (5, 2, [float("inf")] * 16),
    (6, 1, [0.25 * i for i in range(16)]), (6, 1, [0.25 * i for i in range(16)]), (None, 2, [-0.001] * 16), (None, None, [-1000.5] * 16), (9, 1, [3e5] * 16),
]


def test_odd_rows_and_clashing_columns(spark):
    schema = "vec_id bigint, label int, embedding array<double>"
    df = spark.createDataFrame(ODD, schema)
    wide = df.selectExpr("*", "'q' as code", "7 as id", "8 as v", "'x' as slot", "'y' as sums", "1 as length", "2 as of", "3 as error", "4 as label_error")
    assert found(compress_vectors(wide)) == brute(ODD)
    assert compress_vectors(df.limit(0)).collect() == []
    assert compress_vectors(df.where("vec_id = 1")).collect() == []


def test_lengths_have_codebooks_of_their_own(spark):
    rng = np.random.default_rng(3)
    short, long = ([(k, k % 3, rng.normal(size=n).round(3).tolist()) for k in range(90)] for n in (16, 21))
    schema = "vec_id bigint, label int, embedding array<float>"
    coded, books = fit_codes(spark.createDataFrame([*short, *long, (900, 1, [])], schema))
    got = [(r["id"], r["length"], r["code"].hex(), r["error"]) for r in coded.collect()]
    as_floats = lambda rows: [(i, label, np.float32(v).tolist()) for i, label, v in rows]
    for rows, n in ((short, 16), (long, 21)):
        want = brute(as_floats(rows))
        assert sorted((i, c, e) for i, length, c, e in got if length == n) == sorted(r[:3] for r in want)
        assert digest(books[n]) == want[0][4]
    assert (900, 0, "00" * 16, 0) in got
    back = {(r["id"], len(r["vector"])): r["vector"] for r in decode(coded, books).collect()}
    for i, length, code, error in got:
        if length == 16:
            x = whole_numbers(np.float32([short[i][2]]))[0]
            assert int(((x - np.array(back[i, 16]) * 256) ** 2).sum()) == error


def test_too_large_components_are_refused(spark):
    df = spark.createDataFrame([(1, 1, [1e30] * 16)], "vec_id bigint, label int, embedding array<double>")
    with pytest.raises(Exception, match="fit 32 bits"):
        compress_vectors(df).collect()


def test_bounds_by_net_displacement_skip_most_scans_and_none_wrongly():
    rng = np.random.default_rng(1)
    centres = rng.integers(-2000, 2000, (64, 16, 4))
    x = (centres[rng.integers(0, 64, 4000)] + rng.integers(-40, 41, (4000, 16, 4))).astype(np.int64)
    history, kept = [np.ascontiguousarray(x[:64].transpose(1, 0, 2))], None
    scans = []
    for _ in range(4):
        kept = assign(x, history, kept)
        d = ((x[:, :, None, :] - history[-1][None]) ** 2).sum(3)
        assert (kept.code == d.argmin(2)).all() and (kept.squared == d.min(2)).all()
        scans.append(kept.scanned)
        book = history[-1].copy()
        for p in range(16):
            for e in range(64):
                own = x[kept.code[:, p] == e, p]
                if len(own):
                    book[p, e] = own.sum(0) // len(own)
        history.append(book)
    assert scans[0] == 4000 * 16 * 64 and scans[3] < scans[0] / 3
    # Entries that return to where they were have no net displacement: bounds of the first round hold in full.
    away = [history[0], history[0] + 500, history[0]]
    first = assign(x, away[:1])
    assert assign(x, away, first).scanned < scans[0] / 2


def test_ties_go_to_the_lower_index_where_bounds_are_equal():
    x = in_parts(np.array([[0] * 16, [2] * 16, [1] * 16]), 16)
    book = np.ascontiguousarray(x[:2].transpose(1, 0, 2))
    first = assign(x, [book], group=1)
    assert first.code[2].tolist() == [0] * 16
    again = assign(x, [book, book[:, ::-1].copy()], first, group=1)
    assert again.code.tolist() == [[1] * 16, [0] * 16, [0] * 16]
