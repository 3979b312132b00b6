import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from millrace.llm import chat_repair, queries
from millrace.llm.chat_repair import coded, damaged, edits, placed, repair_report, repaired_turns

LEGAL = re.compile(r"(s?(ua)+)?")
INK = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """Least cost and ASCII-least audit of (role, text, fault) rows by best-first search over (place, state), with the repaired turns."""
    moves = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    heap, done = [(0, "", 0, "", ())], {}
    while heap:
        cost, audit, i, state, turns = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done[i, state] = True
        if i == len(rows) and state in ("", "a"):
            return cost, audit, turns
        for initial, name in (("u", "user"), ("a", "assistant")):
            if initial in moves[state]:
                heapq.heappush(heap, (cost + 2, audit + "I", i, initial, (*turns, (name, ""))))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, turns))
        if fault in ("blank", "duplicate"):
            continue
        more = 1 if fault == "truncated" else 0
        if role[:1] in moves[state]:
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*turns, (role, text))))
        for initial, name in (("u", "user"), ("a", "assistant")):
            if initial in moves[state]:
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, initial, (*turns, (name, text))))


def brute(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        own = by[conv]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        own += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, marked, counts = set(), [], dict(blank=0, duplicate=0, truncated=0)
        for turn, role, text in own:
            ink = INK.findall(text)
            fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else None
            seen.add((role, text))
            marked.append((role, text, fault))
            if fault:
                counts[fault] += 1
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        cost, audit, repaired = cheapest(marked)
        assert LEGAL.fullmatch("".join(r[0] for r, _ in repaired))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, sha)
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found(df):
    rows = df.select("conv_id", *COLUMNS).collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


def test_query_equals_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.QUERIES["op12_conversation_repair"](spark, folder)) == brute(rows)


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def made(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "agent"])
            text = rng.choice(["Yes.", "No!", "so", "", " \t", None, "a.b ", f"t{turn}?", f"w{turn}"])
            rows.append((conv, turn if rng.random() < 0.9 else turn + 5, role, text))
    seen = {}
    return [r for r in rows if seen.setdefault(r[:2], r) is r]


@pytest.mark.parametrize("chunk", [1, 3, chat_repair.CHUNK])
def test_many_conversations_in_chunks_of_any_size(spark, monkeypatch, chunk):
    monkeypatch.setattr(chat_repair, "CHUNK", chunk)
    rows = made(5, 60, 40)
    assert found(repair_report(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_nulls_repeated_rows_long_texts_and_clashing_columns(spark):
    rows = [
        (None, 0, "user", "Hi."), (None, 1, "assistant", "Yes."), (None, None, "system", "Be good."), (3, None, None, None), (4, 2, "user", "x." * 200_000), (4, 3, "assistant", "y" * 300_000),
        (5, 1, "user", "Same."), (5, 1, "user", "Same."), (5, 2, "assistant", "Ok."), (5, 7, "assistant", "Ok."), (6, None, "user", " "), (7, 10**15, "user", "a\0b."), (7, -5, "s", " ?"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    wide = df.selectExpr("*", "1 as conv", "2 as at", "'z' as code", "3 as part", "4 as block", "'q' as kind", "5 as entry", "6 as audit", "7 as key", "8 as head", "9 as cost")
    assert found(repair_report(wide)) == brute(rows)
    assert repair_report(df.limit(0)).collect() == []


def test_conversation_whose_rows_all_go(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = found(repair_report(spark.createDataFrame([(conv, 0, "user", "Hi.")], SCHEMA)))
    assert got == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_repaired_turns_give_the_digest(spark, monkeypatch):
    monkeypatch.setattr(chat_repair, "CHUNK", 4)
    df = spark.createDataFrame(made(9, 20, 30), SCHEMA)
    rows = placed(damaged(df))
    turns = defaultdict(list)
    for r in sorted(repaired_turns(rows, edits(coded(rows))).collect(), key=lambda r: (r["part"], r["block"], r["place"])):
        turns[r["conv"]].append(f"{r['role']}:{r['text']}")
    report = found(repair_report(df))
    for conv, values in report.items():
        assert hashlib.sha256("\n".join(turns[conv]).encode()).hexdigest() == values[-1]


def test_checkpoints_hold_at_every_length():
    rng = random.Random(2)
    walker = chat_repair.Walker()
    for n in (1, 2, 3, 4, 5, 8, 9, 10, 50, 101):
        codes = bytes(rng.randrange(16) for _ in range(n))
        after = chat_repair.END
        for code in reversed(codes):
            after = chat_repair.values(code, after)
        m = chat_repair.transfer(codes)
        for state in range(4):
            letters, last, cost = walker.walk(codes, chat_repair.END, state)
            assert cost + chat_repair.END[last] == after[state] == min(m[state, t] + chat_repair.END[t] for t in range(4))
            assert sum(x != "I" for x in letters) == n
