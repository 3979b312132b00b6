r"""Conversation repair: the cheapest edits to a legal order of roles, by a checkpointed dynamic program.

A repaired conversation has role initials ``(s?(ua)+)?``. Its states are 0 (no
turn yet), 1 (after s), 2 (after u), 3 (after a); every state has one next role,
so the letters of the edits fix the repaired turns.

A conversation is cut into chunks of rows. Going backward, a vector of the four
states' remaining costs is stored at chunk ends only (a chunk's rows compose to
one matrix of least costs), and inside a chunk at every square root of its
rows. Going forward, one such block after the other is recomputed, and of the
edits that keep to the least cost (the tight ones) the ASCII-least is emitted. A
chunk is walked from each state it may be entered in; which one it is follows
from the exits of the chunks before. So no task needs a conversation's rows as
a whole; only the digest of a repaired conversation, a sequential hash, is
streamed by one task.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import written

# Costs of the edits and the blanks of the contract.
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
BLANKS = " \t\n\x0b\x0c\r"

#: Rows of a conversation that form a chunk.
CHUNK = 16_384

NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
END = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 40
BLANK_ROW, DUPLICATE_ROW, TRUNCATED_ROW = 1, 2, 3

#: A row's place: its partition and its number there share a long.
PLACE_BITS = 33


def row_edits(state: int, code: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state afterwards) of the edits that use up a row, in ASCII order.

    ``code`` is four times the row's fault plus its initial (s, u, a, other).
    """
    fault, initial = divmod(code, 4)
    out = [("D", DELETE, state)]
    if fault in (BLANK_ROW, DUPLICATE_ROW):
        return out
    more = TRUNCATED if fault == TRUNCATED_ROW else 0
    if (initial == 0 and state == 0) or (initial in (1, 2) and NEXT[state] == initial + 1):
        out.append(("K", more, initial + 1))
    out.append(("R", REROLE + more, NEXT[state]))
    return out


def values(code: int, after: tuple) -> tuple:
    """Least remaining cost of each state before a row, from those behind it."""
    v = [min(cost + after[t] for _, cost, t in row_edits(s, code)) for s in range(4)]
    for _ in range(3):
        v = [min(v[s], INSERT + v[NEXT[s]]) for s in range(4)]
    return tuple(v)


def emit(state: int, code: int, after: tuple) -> tuple[str, int, int]:
    """The ASCII-least tight letters up to and including the row's own, the state behind it and their cost."""
    v, letters, paid = values(code, after), "", 0
    while True:
        tight = {letter: (cost, t) for letter, cost, t in row_edits(state, code) if cost + after[t] == v[state]}
        if "D" not in tight and INSERT + v[NEXT[state]] == v[state]:
            letters, paid, state = letters + "I", paid + INSERT, NEXT[state]
            continue
        letter = min(tight)
        cost, t = tight[letter]
        return letters + letter, t, paid + cost


class Walker:
    """Backward values and forward walks with remembered steps; costs are kept relative to their least."""

    def __init__(self):
        self._back, self._out = {}, {}

    def back(self, code: int, after: tuple) -> tuple:
        """Values before a row, less their least."""
        got = self._back.get((code, after))
        if got is None:
            v = values(code, after)
            self._back[code, after] = got = tuple(x - min(v) for x in v)
        return got

    def walk(self, codes: bytes, after: tuple, state: int) -> tuple[str, int, int]:
        """Letters of all rows, the state behind them and the cost; ``after``: values behind the last row."""
        n = len(codes)
        step = max(1, isqrt(n))
        least = min(after)
        now = tuple(x - least for x in after)
        checkpoints = {}
        for i in range(n - 1, -1, -1):
            if (i + 1) % step == 0 or i == n - 1:
                checkpoints[i // step] = now
            now = self.back(codes[i], now)
        out, paid = [], 0
        for block in range(-(-n // step)):
            rows = codes[block * step : (block + 1) * step]
            behind = [checkpoints[block]]
            for code in rows[:0:-1]:
                behind.append(self.back(code, behind[-1]))
            for code in rows:
                key = (state, code, behind.pop())
                got = self._out.get(key)
                if got is None:
                    self._out[key] = got = emit(*key)
                letters, state, cost = got
                out.append(letters)
                paid += cost
        return "".join(out), state, paid


def _least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least-cost products of matrices (n, 4, 4)."""
    return (a[:, :, :, None] + b[:, None, :, :]).min(2)


def _steps() -> np.ndarray:
    """For each code the least cost from each state before a row to each one behind it."""
    out = np.full((16, 4, 4), FAR, np.int64)
    for code in range(16):
        for start in range(4):
            state, paid = start, 0
            for _ in range(4):
                for _, cost, t in row_edits(state, code):
                    out[code, start, t] = min(out[code, start, t], paid + cost)
                state, paid = NEXT[state], paid + INSERT
    return out


STEPS = _steps()


def transfer(codes: bytes) -> np.ndarray:
    """Least cost from each state before the rows to each one behind them; products are taken in pairs."""
    m = STEPS[np.frombuffer(codes, np.uint8)]
    while len(m) > 1:
        odd = m[len(m) & ~1 :]
        m = np.concatenate([_least(m[: len(m) & ~1 : 2], m[1::2]), odd])
    return np.minimum(m[0], FAR)


def damaged(df: DataFrame) -> DataFrame:
    """(conv, turn, role, text): rows of (conv_id, turn, role, text) damaged by a hash of their ids.

    By ``crc32("conv_id:turn") % 20``, a null id being one space: 0 goes, 1 has
    an empty text, 2 loses its ``.!?``, 3 comes twice, 4 gets the role user.
    Null roles and texts are one space.
    """
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", word("conv_id"), word("turn")).cast("binary")) % 20
    rows = df.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), word("role").alias("role"), word("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("kind <> 0").select("conv", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time")).drop("time")


def placed(rows: DataFrame) -> DataFrame:
    """The rows in order, written, each with its place ``at`` (partition and number).

    Order: conversation, turn (nulls first), role, text up to 64 letters, hash of
    the text. The ranges are cut behind these by a random number too, so neither
    a long conversation nor many equal rows need one task.
    """
    keys = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("head"), F.asc("sign"), F.asc("salt")]
    wide = rows.withColumns({"head": F.left("text", F.lit(64)), "sign": F.xxhash64("text"), "salt": F.rand(7)})
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = wide.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return written(cut.select("conv", "turn", "role", "text").withColumn("at", F.monotonically_increasing_id()), "turns")


def coded(rows: DataFrame) -> DataFrame:
    """(conv, at, code) of placed rows: first fault (blank, duplicate, truncated) and initial.

    A row is a duplicate if an earlier one of its conversation has its role and
    text. Only texts that come more than once are joined back.
    """
    trimmed = F.rtrim("text", F.lit(BLANKS))
    slim = rows.select(
        "conv", "at", F.md5(F.concat_ws("\0", F.coalesce(F.col("conv").cast("string"), F.lit(" ")), F.char_length("role").cast("string"), "role", "text").cast("binary")).alias("key"),
        F.expr("array_position(array('s', 'u', 'a'), left(role, 1))").alias("initial"), F.right(trimmed, F.lit(1)).alias("last"),
    )
    initial = F.when(F.col("initial") == 0, 3).otherwise(F.col("initial") - 1)
    firsts = written(slim.groupBy("key").agg(F.count("*").alias("n"), F.min("at").alias("first")).where("n > 1").select("key", "first"), "turn-firsts")
    fault = F.when(F.col("last") == "", BLANK_ROW).when(F.col("at") > F.col("first"), DUPLICATE_ROW).when(~F.col("last").isin(".", "!", "?"), TRUNCATED_ROW).otherwise(0)
    return slim.join(firsts, "key", "left").select("conv", "at", (fault * 4 + initial).cast("int").alias("code"))


def _with_chunk(rows: DataFrame) -> DataFrame:
    place = F.col("at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return rows.withColumns({"part": F.shiftright("at", PLACE_BITS), "block": F.floor(place / CHUNK)})


def _streamed(df: DataFrame, order: list, step, columns: str) -> DataFrame:
    """``step(rows, state) -> list of output rows`` over batches that come by conversation in the given order."""
    names = [c.split()[0] for c in columns.split(", ")]
    schema = pa.schema([(n, _ARROW[c.split()[1]]) for n, c in zip(names, columns.split(", "))])

    def run(batches):
        state: dict = {}
        for batch in batches:
            out = step(batch.to_pylist(), state)
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], schema)
        out = step(None, state)
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], schema)

    return df.repartition("conv").sortWithinPartitions(F.asc_nulls_first("conv"), *order).mapInArrow(run, columns)


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def edits(codes: DataFrame) -> DataFrame:
    """(conv, part, block, codes, audit, cost): the cheapest, ASCII-least edits of every chunk of :func:`coded` rows."""
    rows = _with_chunk(codes).groupBy("conv", "part", "block").agg(F.sort_array(F.collect_list(F.struct("at", "code"))).alias("rows"))
    packed = rows.select("conv", "part", "block", F.col("rows.code").cast("array<int>").alias("codes"))

    def measure(batches):
        for batch in batches:
            codes = [bytes(c) for c in batch.column("codes").to_pylist()]
            matrix = [transfer(c).ravel().tolist() for c in codes]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(codes, pa.binary()), pa.array(matrix, pa.list_(pa.int64()))], ["conv", "part", "block", "codes", "matrix"])

    chunks = written(packed.mapInArrow(measure, "conv bigint, part bigint, block bigint, codes binary, matrix array<bigint>"), "turn-chunks")

    def backward(rows, state):
        out = []
        for r in rows or ():
            if "conv" not in state or state["conv"] != r["conv"]:
                state["conv"], after, last = r["conv"], END, True
            else:
                after, last = state["now"], False
            out.append((r["conv"], r["part"], r["block"], list(after), last))
            m = r["matrix"]
            state["now"] = tuple(min(m[4 * s + t] + after[t] for t in range(4)) for s in range(4))
        return out

    ends = _streamed(chunks.select("conv", "part", "block", "matrix"), [F.desc("part"), F.desc("block")], backward, "conv bigint, part bigint, block bigint, after array<bigint>, last boolean")
    same = F.expr("c.part = e.part and c.block = e.block and c.conv <=> e.conv")
    joined = chunks.drop("matrix").alias("c").join(ends.alias("e"), same).select("c.conv", "c.part", "c.block", "codes", "after", "last")

    def forward(batches):
        walker = Walker()
        for batch in batches:
            audits, exits, costs = [], [], []
            for code, after, last in zip(batch.column("codes").to_pylist(), batch.column("after").to_pylist(), batch.column("last").to_pylist()):
                got = []
                for state in range(4):
                    letters, t, cost = walker.walk(code, tuple(after), state)
                    if last:
                        letters, cost = letters + "I" * (END[t] // INSERT), cost + END[t]
                    got.append((letters, t, cost))
                for out, one in zip((audits, exits, costs), zip(*got)):
                    out.append(list(one))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), pa.array(audits, pa.list_(pa.string())), pa.array(exits, pa.list_(pa.int64())), pa.array(costs, pa.list_(pa.int64()))],
                ["conv", "part", "block", "codes", "audits", "exits", "costs"],
            )

    walked = joined.mapInArrow(forward, "conv bigint, part bigint, block bigint, codes binary, audits array<string>, exits array<bigint>, costs array<bigint>")

    def choose(rows, state):
        out = []
        for r in rows or ():
            if "conv" not in state or state["conv"] != r["conv"]:
                state["conv"], state["at"] = r["conv"], 0
            s = state["at"]
            out.append((r["conv"], r["part"], r["block"], r["codes"], s, r["audits"][s], r["costs"][s]))
            state["at"] = r["exits"][s]
        return out

    chosen = _streamed(walked, [F.asc("part"), F.asc("block")], choose, "conv bigint, part bigint, block bigint, codes binary, entry bigint, audit string, cost bigint")
    return written(chosen, "turn-edits")


def _applied(chunk: dict, rows) -> list[tuple[str, str]]:
    """Repaired (role, text) of a chunk; ``rows`` gives its turns in order."""
    out, state, rows = [], chunk["entry"], iter(rows)
    for letter in chunk["audit"]:
        if letter == "I":
            state = NEXT[state]
            out.append((ROLE[state], ""))
            continue
        role, text = next(rows)
        if letter == "K":
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
            out.append((role, text))
        elif letter == "R":
            state = NEXT[state]
            out.append((ROLE[state], text))
    return out


def _together(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """Chunks' edits (kind 1) and their rows (kind 2) as one table."""
    a = changes.select("conv", "part", "block", F.lit(1).cast("bigint").alias("kind"), "codes", "entry", "audit", "cost")
    b = _with_chunk(rows).withColumn("kind", F.lit(2).cast("bigint"))
    return a.unionByName(b, allowMissingColumns=True)


def repaired_turns(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """(conv, part, block, place, role, text): repaired turns of :func:`placed` rows, in that order.

    A task needs one chunk's rows only.
    """
    schema = pa.schema([(n, pa.int64()) for n in ("conv", "part", "block", "place")] + [("role", pa.string()), ("text", pa.string())])

    def run(batches):
        chunk, held = None, []

        def closed():
            return [dict(conv=chunk["conv"], part=chunk["part"], block=chunk["block"], place=i, role=r, text=t) for i, (r, t) in enumerate(_applied(chunk, held))] if chunk else []

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["kind"] == 1:
                    out += closed()
                    chunk, held = r, []
                else:
                    held.append((r["role"], r["text"]))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if chunk:
            yield pa.RecordBatch.from_pylist(closed(), schema)

    both = _together(rows, changes).repartition("conv", "part", "block").sortWithinPartitions(F.asc_nulls_first("conv"), "part", "block", "kind", "at")
    return both.select("conv", "part", "block", "kind", "entry", "audit", "role", "text").mapInArrow(run, "conv bigint, part bigint, block bigint, place bigint, role string, text string")


def repair_report(df: DataFrame) -> DataFrame:
    """Per conv_id the faults after the damage, the cheapest edits and a digest of the repaired turns.

    (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) for every conv_id of the rows (conv_id, turn, role, text), a
    null one too. Null roles and texts are one space; rows with equal turns come
    by role and text (see :func:`placed`); equal rows are duplicates of the first
    of them. A role's first letter counts: s, u, a, or any other, which cannot be
    kept. Conversations without rows after the damage have zeros, an empty audit
    and the digest of an empty text. An empty table gives no rows. Other columns
    are not read. A task streams each conversation's sorted rows and holds the
    rows of one batch and the audit.
    """
    rows = placed(damaged(df))
    changes = edits(coded(rows))
    first = df.select(F.col("conv_id").cast("long").alias("conv")).distinct().withColumn("kind", F.lit(0).cast("bigint")).withColumns({"part": F.lit(-1).cast("bigint"), "block": F.lit(-1).cast("bigint")})
    stream = _together(rows, changes).unionByName(first, allowMissingColumns=True)

    def closed(s):
        return s["conv"], s["gaps"], *s["faults"], s["illegal"], s["cost"], "".join(s["audit"]), s["sha"].hexdigest()

    def add(s, role, text):
        s["sha"].update((("\n" if s["any"] else "") + f"{role}:{text}").encode())
        s["any"] = True

    def inserts(s):
        while s["left"][s["next"] : s["next"] + 1] == "I":
            s["role"], s["next"] = NEXT[s["role"]], s["next"] + 1
            add(s, ROLE[s["role"]], "")

    def step(batch, s):
        out = []
        if batch is None:
            return [closed(s)] if s else []
        for r in batch:
            if r["kind"] == 0:
                if s:
                    out.append(closed(s))
                s.clear()
                s.update(conv=r["conv"], gaps=0, faults=[0, 0, 0], illegal=0, cost=0, audit=[], sha=hashlib.sha256(), any=False, before=None, low=None, high=None, turns=0, left="", next=0, role=0)
            elif r["kind"] == 1:
                codes = np.frombuffer(r["codes"], np.uint8)
                for k in range(3):
                    s["faults"][k] += int((codes // 4 == k + 1).sum())
                initials = codes % 4 if s["before"] is None else np.concatenate([[s["before"]], codes % 4])
                pairs = initials[:-1].astype(int) * 4 + initials[1:]
                s["illegal"] += int((~np.isin(pairs, (1, 6, 9))).sum())
                s["before"] = int(codes[-1] % 4)
                s["cost"] += r["cost"]
                s["audit"].append(r["audit"])
                s["left"], s["next"], s["role"] = r["audit"], 0, r["entry"]
                inserts(s)
            else:
                turn = r["turn"]
                if turn is not None and turn != s["high"]:
                    s["low"] = turn if s["low"] is None else s["low"]
                    s["high"], s["turns"] = turn, s["turns"] + 1
                    s["gaps"] = s["high"] - s["low"] + 1 - s["turns"]
                letter = s["left"][s["next"]]
                s["next"] += 1
                if letter == "K":
                    s["role"] = {"s": 1, "u": 2, "a": 3}[r["role"][0]]
                    add(s, r["role"], r["text"])
                elif letter == "R":
                    s["role"] = NEXT[s["role"]]
                    add(s, ROLE[s["role"]], r["text"])
                inserts(s)
        return out

    done = _streamed(stream.select("conv", "part", "block", "kind", "at", "codes", "entry", "audit", "cost", "turn", "role", "text"), [F.asc("part"), F.asc("block"), F.asc("kind"), F.asc("at")], step, "conv bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string")
    return done.withColumnRenamed("conv", "conv_id")
