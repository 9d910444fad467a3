r"""Chat formatting with a grammar that reads its own output back.

    conversation = turn*
    turn         = "[INST] " body " [/INST]"            a user's
                 | " " body " </s>"                     an assistant's, under the loss mask
                 | "[ROLE=" name "] " body " [/ROLE]"   any other role's; the name is percent-encoded

A control string inside a body stands behind an odd number of backslashes: n of them before a control
string become 2n + 1. All else in a body is itself. No control string can begin inside another or
inside a turn's marks, so the parser needs no guess.

Each turn is rendered as it is, parsed, and compared with its source; only if they differ are its
control strings escaped and the comparison made again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table

CONTROLS = ("[INST]", "[/INST]", "</s>", "[ROLE=", "[/ROLE]")
_CONTROL = re.compile(r"(\\*)(" + "|".join(map(re.escape, CONTROLS)) + ")")
#: Code points of a formatted segment, from which on the next turn begins another row.
SEGMENT = 65_536


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[1] * 2 + "\\" + m[2], text)


def unescape(body: str) -> str:
    return _CONTROL.sub(lambda m: m[1][: len(m[1]) // 2] + m[2], body)


def _marks(role: str) -> tuple[str, str]:
    if role == "user":
        return "[INST] ", " [/INST]"
    return (" ", " </s>") if role == "assistant" else (f"[ROLE={quote(role, safe='')}] ", " [/ROLE]")


class ParseError(ValueError):
    """The text is not of the grammar."""


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """role, text, and where the body starts and ends, of every turn."""
    out, at = [], 0
    while at < len(text):
        if text.startswith("[INST] ", at):
            role, start, close = "user", at + 7, "[/INST]"
        elif text.startswith("[ROLE=", at) and (stop := text.find("] ", at)) > 0:
            role, start, close = unquote(text[at + 6 : stop]), stop + 2, "[/ROLE]"
        elif text[at] == " ":
            role, start, close = "assistant", at + 1, "</s>"
        else:
            raise ParseError(f"no turn begins at {at}")
        end = next((m for m in _CONTROL.finditer(text, start) if len(m[1]) % 2 == 0), None)
        if end is None or end[0] != close or end.start() <= start - 1 or text[end.start() - 1] != " " or end.start() - 1 < start:
            raise ParseError(f"the turn at {at} does not end with its mark")
        out.append((role, unescape(text[start : end.start() - 1]), start, end.start() - 1))
        at = end.end()
    return out


def render(role: str, text: str) -> str:
    """One turn, escaped only if it would not be read back as it is."""
    before, after = _marks(role)
    for body in (text, escape(text)):
        turn = before + body + after
        try:
            if [x[:2] for x in parse(turn)] == [(role, text)]:
                return turn
        except ParseError:
            pass
    raise ValueError("a turn cannot be read back")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, part, segment, formatted: the rendered turns of each conversation in order.

    Turns come in the order of (turn, role, text), nulls first; a null role or text is empty, null
    conv_ids are one conversation, repeated rows repeated turns. All turns are dealt by ranges of
    (conv_id, turn, role), so a conversation of very many turns is rendered by many tasks: its segments are
    ordered by (part, segment). A segment ends after a turn once it has SEGMENT code points, so neither
    rows nor a task's memory grow with a conversation; a longer text is a turn, and a segment, of its own.
    An empty table gives no rows; columns but conv_id, turn, role and text are not read.
    """
    d = conversations.select(F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    d = d.repartitionByRange("conv_id", "turn", "role").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text", F.spark_partition_id().alias("part"))
    names = ["conv_id", "part", "segment", "formatted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, part, segment, size, turns, rows = None, 0, -1, 0, [], []
        types = (pa.int64(), pa.int32(), pa.int64(), pa.string())
        flush = lambda: pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)
        for b in batches:
            for conv, role, text, part in zip(*(b.column(i).to_pylist() for i in range(4))):
                if segment < 0 or conv != key or size >= SEGMENT:
                    if turns:
                        rows.append((key, part, segment, "".join(turns)))
                    segment = segment + 1 if segment >= 0 and conv == key else 0
                    key, size, turns = conv, 0, []
                turns.append(render(role, text))
                size += len(turns[-1])
            if rows:
                yield flush()
                rows = []
        if turns:
            rows.append((key, part, segment, "".join(turns)))
            yield flush()

    return d.mapInArrow(run, "conv_id long, part int, segment long, formatted string")


def parsed(formatted: DataFrame) -> DataFrame:
    """conv_id, part, segment, n_turns, turns and loss (bytes to digest), loss_chars and chars of each segment,
    as the parser finds them."""
    names = ["conv_id", "part", "segment", "n_turns", "turns", "loss", "loss_chars", "chars"]

    def one(text: str) -> tuple:
        found = parse(text)
        loss = "".join(body for role, body, _, _ in found if role == "assistant")
        return len(found), "".join(f"{role}\n{body}\n" for role, body, _, _ in found).encode(), loss.encode(), len(loss), len(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
        for b in batches:
            for at in range(0, b.num_rows, 64):
                own = b.slice(at, 64)
                found = [one(t) for t in own.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays([*own.columns[:3], *(pa.array([x[i] for x in found], t) for i, t in enumerate(types))], names)

    schema = "conv_id long, part int, segment long, n_turns long, turns binary, loss binary, loss_chars long, chars long"
    return formatted.select("conv_id", "part", "segment", "formatted").mapInArrow(run, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the parser finds in formatted conversations, one row each.

    Segments are parsed where they lie; only their bytes then pass through a conversation's digests, one
    segment after another. Null conv_ids are one conversation; no segments, no rows.
    """
    d = parsed(formatted).repartition("conv_id").sortWithinPartitions("conv_id", "part", "segment")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, done = None, []

        def close() -> None:
            key, n, turns, loss, chars, total = state
            done.append((key, n, turns.hexdigest(), chars, loss.hexdigest(), total))

        def flush() -> pa.RecordBatch:
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate(types)], names)
            done.clear()
            return out

        for b in batches:
            for conv, _, _, n, turns, loss, loss_chars, chars in zip(*(b.column(i).to_pylist() for i in range(8))):
                if state is None or conv != state[0]:
                    if state:
                        close()
                    state = [conv, 0, hashlib.sha256(), hashlib.sha256(), 0, 0]
                state[1] += n
                state[2].update(turns)
                state[3].update(loss)
                state[4] += loss_chars
                state[5] += chars
            if done:
                yield flush()
        if state:
            close()
            yield flush()

    return d.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def round_trip(conversations: DataFrame) -> DataFrame:
    """Formats, writes the output to the shared folder, and reads it back; odd inputs as in those two."""
    return read_back(table(format_conversations(conversations), "chat"))
