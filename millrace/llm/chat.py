r"""Chat formatting by a grammar round trip.

    conversation = { turn }
    turn         = "### " role ": " text "</turn>" LF

Inside a role or a text a backslash escapes what follows if that is a control
string (``### ``, ``</turn>``, ``: `` in a role) or a backslash. A turn is first
rendered as it is and parsed again; if that does not give back role and text,
its control strings and backslashes are escaped, which always does.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import written

OPEN, END, COLON, ESCAPE = "### ", "</turn>", ": ", "\\"


class Malformed(ValueError):
    """The text is not of the grammar."""


def _escaped(text: str, controls: tuple[str, ...]) -> str:
    for c in (ESCAPE, *controls):
        text = text.replace(c, ESCAPE + c)
    return text


def _stops(*controls: str) -> re.Pattern:
    """The escape sign or a control string, whichever comes first."""
    return re.compile("|".join(map(re.escape, (ESCAPE, *controls))))


_IN_ROLE, _IN_TEXT = _stops(OPEN, END, COLON), _stops(OPEN, END)


def _field(text: str, at: int, end: str, stops: re.Pattern) -> tuple[str, int]:
    """The unescaped text up to ``end``, and the place behind it; every sign is looked at once."""
    out = []
    while stop := stops.search(text, at):
        out.append(text[at : stop.start()])
        if stop[0] == ESCAPE:
            known = stops.match(text, stop.end())
            out.append(known[0] if known else ESCAPE)
            at = known.end() if known else stop.end()
        elif stop[0] == end:
            return "".join(out), stop.end()
        else:
            raise Malformed(f"a control string inside a field at {stop.start()}")
    raise Malformed(f"no {end!r}")


def parse(text: str) -> list[tuple[str, str]]:
    """Turns (role, text) of a rendered conversation."""
    out, at = [], 0
    while at < len(text):
        if not text.startswith(OPEN, at):
            raise Malformed(f"no turn at {at}")
        role, at = _field(text, at + len(OPEN), COLON, _IN_ROLE)
        said, at = _field(text, at, END, _IN_TEXT)
        if text[at : at + 1] != "\n":
            raise Malformed(f"no line end at {at}")
        out.append((role, said))
        at += 1
    return out


def render(role: str, text: str) -> str:
    """One turn; escaped only where parsing it would not give it back."""
    plain = f"{OPEN}{role}{COLON}{text}{END}\n"
    try:
        if parse(plain) == [(role, text)]:
            return plain
    except Malformed:
        pass
    made = f"{OPEN}{_escaped(role, (OPEN, END, COLON))}{COLON}{_escaped(text, (OPEN, END))}{END}\n"
    if parse(made) != [(role, text)]:
        raise AssertionError("an escaped turn does not parse back")
    return made


def format_chats(df: DataFrame) -> DataFrame:
    """(conv_id, turn, formatted): a rendered turn per row of (conv_id, turn, role, text).

    The rows of a conversation by (turn, formatted), nulls first, joined without
    anything between them, are its text. Null roles and texts are empty. Rows
    with equal turns all stay. Other columns are not read.
    """

    def run(batches):
        for batch in batches:
            turns = [render(r or "", t or "") for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("turn"), pa.array(turns, pa.string())], ["conv_id", "turn", "formatted"])

    slim = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), "text")
    return slim.mapInArrow(run, "conv_id bigint, turn bigint, formatted string")


def read_chats(formatted: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Conversations parsed from formatted turns, with digests of turns and of the text under the loss mask.

    A task streams the sorted turns of its conversations; it holds one turn and
    two running digests, however long a conversation is.
    """
    columns = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches):
        now, state, done = None, None, []

        def closed(conv):
            n, turns, chars, loss, size = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), size

        for batch in batches:
            for conv, text in zip(batch.column("conv_id").to_pylist(), batch.column("formatted").to_pylist()):
                if state is None or conv != now:
                    if state is not None:
                        done.append(closed(now))
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                    if role == loss_role:
                        state[2] += len(said)
                        state[3].update(said.encode())
                state[4] += len(text)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in done], SCHEMA)
                done = []
        if state is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, closed(now)))], SCHEMA)

    ordered = formatted.select("conv_id", "turn", "formatted").repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "formatted")
    return ordered.select("conv_id", "formatted").mapInArrow(run, columns)


SCHEMA = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def chat_round_trip(df: DataFrame) -> DataFrame:
    """Format, write to the shared folder, read back and parse."""
    return read_chats(written(format_chats(df), "chats"))
