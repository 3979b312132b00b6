"""SimHash, substrings, quality rules, mixing and the pipeline against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import mixing, quality_rules, simhash, stages, substrings, textstats
from millrace.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def classes(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [" ".join(words)] * bool(words)


def fingerprint(text):
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, 3)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.fixture(scope="module")
def near(spark):
    """Texts with edits of a few words, in a frame; (id, text)."""
    rnd = random.Random(3)
    rows = []
    for base in range(25):
        words = [f"w{rnd.randrange(400)}" for _ in range(rnd.choice([20, 120, 300]))]
        for _ in range(rnd.choice([1, 2, 6])):
            own = words[:]
            for _ in range(rnd.choice([0, 1, 3, 12])):
                own[rnd.randrange(len(own))] = f"new{rnd.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("bucket", [1, 2, 4096])
def test_links_of_fingerprints(spark, bucket, monkeypatch):
    rng = np.random.default_rng(bucket)
    prints = rng.integers(-(2**62), 2**62, 60)
    for i in range(60):  # a dense ball that fills buckets, and chains
        prints[i] = prints[0 if i < 40 else i - 1] ^ sum(1 << int(b) for b in rng.integers(0, 40, 2))
    prints = np.unique(prints)
    nodes = spark.createDataFrame([(int(p),) for p in prints], "print bigint")
    links = [(r["a"], r["b"]) for r in simhash.links_within(nodes, 2, bucket).collect()]
    true = [(int(a), int(b)) for a in prints for b in prints if a < b and (int(a) ^ int(b)).bit_count() <= 2]
    signed = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2
    assert all(signed(a, b) for a, b in links)
    true = [(int(a), int(b)) for a in prints for b in prints if a < b and signed(int(a), int(b))]
    assert classes(map(int, prints), links) == classes(map(int, prints), true)


@pytest.mark.parametrize("radius", [0, 1, 2, 5])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    prints = rng.integers(0, 2**63, 300).astype(np.uint64)
    for i in range(150):
        prints[i] = prints[rng.integers(300)] ^ np.uint64(sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(1, 5))))
    prints = np.unique(prints)
    true = np.argwhere(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius).tolist()
    assert classes(range(len(prints)), simhash.within_radius(prints, radius)) == classes(range(len(prints)), true)


def test_near_duplicates(spark, near, odd, odd_rows, none):
    rows, frame = near
    rows = rows + [(1000 + (i or 500), t) for i, t in odd_rows]
    both = frame.union(odd.select((F.coalesce("doc_id", F.lit(500)) + 1000).alias("doc_id"), "text"))
    got = Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(both).collect())
    prints = [fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    roots = classes(range(len(rows)), links)
    least = defaultdict(lambda: 10**9)
    for i, r in roots.items():
        least[r] = min(least[r], rows[i][0])
    assert got == Counter((rows[i][0], f"{prints[i]:016x}", least[roots[i]]) for i in range(len(rows)))
    assert simhash.near_duplicates(odd).count() == len(odd_rows) and simhash.near_duplicates(none).count() == 0


def test_long_texts_use_several_runs(monkeypatch):
    monkeypatch.setattr(simhash, "RUN", 7)
    texts = [("a b c " * n).encode() for n in range(20)]
    assert simhash.majority_bits([simhash.shingle_hashes(t, 3) for t in texts]).tolist() == [fingerprint(t.decode()) for t in texts]


def test_components(spark):
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(rnd.randrange(2000, 2100), rnd.randrange(2000, 2100)) for _ in range(60)]
    links = [(a, b) for a, b in links if a != b]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == classes({x for e in links for x in e}, links)


def test_one_document_of_each_component_stays(spark, near, odd, odd_rows, none):
    rows, frame = near
    prints = [fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    roots = classes(range(len(rows)), links)
    least = defaultdict(lambda: 10**9)
    for i, r in roots.items():
        least[r] = min(least[r], rows[i][0])
    left = simhash.drop_similar(frame)
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(least.values()) and len(least) < len(rows)
    left = simhash.drop_similar(odd)
    assert left.columns == odd.columns and left.count() == len({r["component_id"] for r in simhash.near_duplicates(odd).collect()})
    ids = [r["doc_id"] for r in left.collect()]
    assert 4 in ids and 5 not in ids  # 4 and both rows of 5 are one text
    assert simhash.drop_similar(none).count() == 0


def test_dropping_with_clashing_names_and_null_ids(spark):
    rows = [(None, "a b c d e"), (None, "a b c d e"), (None, "x y z u v"), (3, "x y z u v"), (None, None), (None, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as sign", "2 as kept_id", "'k' as kept_sign", "3 as SIGN_", "4 as print", "5 as __hash", "6 as __id", "7 as __same")
    left = simhash.drop_similar(frame)
    assert left.columns == frame.columns
    got = Counter((r["doc_id"], r["text"] or "") for r in left.collect())
    assert got == Counter([(None, "a b c d e"), (3, "x y z u v"), (None, "")])


def test_stages_with_clashing_names(spark, odd):
    from millrace.llm import stages

    names = "key times use spans sign kept_id __key __spans __times __use row__ order__".split()
    wide = odd.select("doc_id", "text", "lang", "source", "n_chars", *[F.lit("q").alias(n) for n in names])
    for stage in (stages.quality, stages.near_dedup, stages.substring_dedup, stages.mixing):
        out = stage(spark, wide, None)
        assert out.columns == wide.columns
        out.count()


# -- substrings ---------------------------------------------------------------


@pytest.mark.parametrize("depth", [1, 3, 8])
def test_fm_index(depth):
    rng = np.random.default_rng(depth)
    for _ in range(15):
        pool, sequences = rng.integers(1, 6, 300), []
        for _ in range(rng.integers(1, 12)):
            at = rng.integers(0, 200)
            part = pool[at : at + rng.integers(0, 90)].copy()
            if len(part):
                part[rng.integers(len(part))] = rng.integers(1, 6)
            sequences.append(part)
        docs, least = rng.integers(0, 50, len(sequences)), {}
        for d, s in zip(docs, sequences):
            for i in range(len(s) - depth + 1):
                least[tuple(s[i : i + depth])] = min(least.get(tuple(s[i : i + depth]), 99), d)
        for s, found in zip(sequences, substrings.least_documents(sequences, docs, depth)):
            assert found.tolist() == [least[tuple(s[i : i + depth])] for i in range(len(s) - depth + 1)]


def without_repeats(rows, window):
    first, out = {}, []
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        words = (t or "").encode().split()
        for k in range(len(words) - window + 1):
            first.setdefault(tuple(words[k : k + window]), i)
    for i, t in rows:
        words = (t or "").encode().split()
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and first[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = [w for j, w in enumerate(words) if j not in gone]
        out.append((i, len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("most,shard", [(20_000, 500_000), (0, 40), (3, 40)])
def test_remove_repeats(spark, odd, odd_rows, near, most, shard, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_WORDS", shard)
    rnd = random.Random(7)
    pool = [f"v{rnd.randrange(30)}" for _ in range(400)]
    rows = [(500 + i, " ".join(pool[(a := rnd.randrange(300)) : a + rnd.randrange(120)])) for i in range(40)]
    rows += [(600 + i, f"u{i} " * 3 + " ".join(pool[100:170]) + f" z{i}") for i in range(8)]
    both = odd.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = substrings.remove_repeats(both, 20, most=most)
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got.collect()) == without_repeats(odd_rows + rows, 20)


def test_kept_text(spark, odd, none):
    got = substrings.remove_repeats(odd, 50)
    assert set(odd.columns) <= set(got.columns)
    texts = {r["doc_id"]: r["text"] for r in got.collect() if r["doc_id"]}
    assert texts[8] == "other words, then\nand   more" and texts[1] is None and texts[2] == "" and texts[7].startswith("before p0")
    assert substrings.remove_repeats(none, 50).count() == 0


# -- quality ------------------------------------------------------------------


def measures(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    places = defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i : i + 5])].append(i)
    repeated = len({j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + 5)})
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), repeated


def test_quality(spark, odd, odd_rows, near, none):
    rows = odd_rows + [(i + 2000, t) for i, t in near[0]] + [(900, "a b c d e " * 9), (901, "the %%% of### and*** with$$$ " * 2 + "one two three four five six seven"), (902, "l\nl\nm\n \nl")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = Counter()
    for i, t in rows:
        n = measures(t)
        failed = n[0] < 10 or 100 * n[4] > 20 * n[0]
        text = quality_rules.Text((t or "").encode(), (t or "").encode().split(), n[2], n[1])
        want[(i, *n, failed, not failed and not any(rule(text) for rule in quality_rules.RULES.values()))] += 1
    assert Counter(map(tuple, quality_rules.quality_rules(frame).collect())) == want
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {i for (i, *_, k) in want if k and (i or 0) < 500}
    assert quality_rules.quality_rules(none).count() == 0 and quality_rules.keep_good(none).count() == 0


def test_order_of_rules(spark):
    frame = spark.createDataFrame([(f"word{i} " * 1 + "and % # * other | words & so < on > here $ it is",) for i in range(30)], "text string")
    assert quality_rules.rule_order(frame)[0] == "symbols"


def test_one_word_counts_all_words():
    words = b" ".join(b"id_%d spam x_%d spam spam" % (i, i) for i in range(20)).split()
    text = quality_rules.Text(b" ".join(words), words, 0, sum(map(len, words)))
    assert quality_rules.RULES["one_word"](text)
    assert not quality_rules.RULES["one_word"](quality_rules.Text(b"", [b"a", b"b"] * 10, 0, 20))


def test_repeated_words_of_any_size():
    texts = [b"", b"a a a a a a a", b"a b c d e a b c d e f", b"x y"]
    for size in (2, 5):
        words = [t.split() for t in texts]
        want = []
        for w in words:
            seen = Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
            want.append(len({j for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for j in range(i, i + size)}))
        assert textstats.repeated_words(words, size).tolist() == want


# -- mixing -------------------------------------------------------------------


def test_targets():
    assert [float(t) for t in mixing.capped_targets([100, 10, 10], [1, 2, 3])] == [60, 30, 30]
    assert mixing.capped_targets([0, 0], [1, 2]) == [0, 0] and mixing.capped_targets([], []) == []


def test_flow_prefers_first_uses():
    flows = mixing.min_cost_flow([100, 10, 50], [[0], [1], [0, 1]], [120, 80])
    assert sum(flows[0].values()) == 100 and sum(f.get(0, 0) for f in flows) == 120
    assert sum(f.get(1, 0) for f in flows) == 80 and sum(flows[2].values()) <= 150


def test_mixing(spark, odd, odd_rows, none):
    rnd = random.Random(6)
    rows = [(i, " ".join(["w"] * rnd.randrange(0, 60)), rnd.choice(["a", "a", "a", "b", "ß", None])) for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix_by_source(frame).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix_by_source(frame.repartition(5)).collect()))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(names, map(float, mixing.capped_targets([sizes[s] for s in names], [1, 2, 3, 1]))))
    taken, source = Counter(), {i: s for i, _, s in rows}
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - targets[s]) < 1e-6 and r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= 2 for s in names)
    assert mixing.mix_by_source(odd).count() == len(odd_rows) and mixing.mix_by_source(none).count() == 0


def test_overlapping_sources(spark):
    rows = [(i, 1 + i % 9, [["a"], ["b"], ["a", "b"]][i % 3]) for i in range(300)]
    mixed, plan = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, n bigint, s array<string>"), F.col("s"), F.col("n"), weights=(1, 3))
    assert abs(sum(r["taken"] for r in mixed.collect()) - sum(p[2] for p in plan.values())) <= 3


# -- pipeline -----------------------------------------------------------------


def test_pipeline_stages(spark, near, odd):
    rnd = random.Random(9)
    vocabulary = [f"word{i}" for i in range(3000)]
    passage = " ".join(rnd.choices(vocabulary, k=70))
    text = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    rows = [(i, text(80), "en", f"s{i % 3}", 1) for i in range(30)]
    rows += [(100 + i, rows[i][1], "en", "s0", 1) for i in range(5)]  # exact copies
    rows += [(200 + i, f"{text(60)} {passage} {text(20)}", "en", "s1", 1) for i in range(4)]
    rows += [(300, "a b c d e " * 9, "en", "s2", 1), (301, "short", "en", "s2", 1), (302, None, "en", None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    steps, now = [], docs
    for name, stage in stages.STAGES[:4]:
        now = spark.createDataFrame(stage(spark, now, "").collect(), docs.schema)
        assert now.columns == docs.columns
        steps.append({r["doc_id"]: r["text"] for r in now.collect()})
    good = {i for i, *_ in rows if i < 300}
    assert set(steps[0]) == good and set(steps[1]) == {i for i in good if not 100 <= i < 200}
    assert passage in steps[2][200] and all(passage not in steps[2][i] and steps[2][i] for i in (201, 202, 203))
    assert set(steps[3]) <= set(steps[2])
    packed = stages.STAGES[4][1](spark, now, "").toPandas()
    assert set(packed.doc_id) == set(steps[3]) and packed.groupby("sequence_id").length.sum().max() <= 2048
    for _, stage in stages.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0
