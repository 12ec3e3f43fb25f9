"""Chat formatting with a grammar round trip.

    conversation := turn*
    turn := "[INST] " text " [/INST]"                     (user)
          | "<s>" text "</s>"                             (assistant)
          | "<<SYS>> " text " <</SYS>>"                   (system)
          | "[ROLE]" role "[TEXT]" text "[/ROLE]"         (any other role, also none)

No text may contain a control string. Where one does, or where it holds
something that looks like an escaped one, a backslash goes behind its first
character; reading takes one backslash away. Each turn is rendered plain, read
back by the parser, and escaped only if what was read differs.

Rows are dealt by conversation and sorted by turn, then streamed: a task holds
one turn at a time, however long its conversation is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The marks of the template.
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>> ", " <</SYS>>")}
OTHER_OPEN, OTHER_MIDDLE, OTHER_CLOSE = "[ROLE]", "[TEXT]", "[/ROLE]"
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\]|</?SYS>>|/?ROLE\]|TEXT\])"

_ANY = re.compile(CONTROL)
_BARE = re.compile(CONTROL.replace(r"(\\*)", "()"))
_ESCAPED = re.compile(CONTROL.replace(r"(\\*)", r"\\(\\*)"))

PIECES = "conv_id long, turn long, role string, rendered string, text_from int, text_to int, escaped boolean"
READ_BACK = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long")


class GrammarError(ValueError):
    """The text does not follow the grammar."""


def escape(text: str) -> str:
    return _ANY.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def parse_turn(source: str, at: int = 0) -> tuple[str, str, int, int, int]:
    """Read one turn: (role, raw text, where the text starts, where it ends, where the turn ends)."""
    def take(close: str, start: int) -> tuple[int, int]:
        m = _BARE.search(source, start)
        if m is None:
            raise GrammarError(f"no {close!r} after {start}")
        end = m.start() - (len(close) - len(close.lstrip()))
        if end < start or not source.startswith(close, end):
            raise GrammarError(f"{m[0]!r} inside a text at {m.start()}")
        return end, end + len(close)

    for role, (opening, close) in MARKS.items():
        if source.startswith(opening, at):
            start = at + len(opening)
            end, after = take(close, start)
            return role, unescape(source[start:end]), start, end, after
    if not source.startswith(OTHER_OPEN, at):
        raise GrammarError(f"no turn starts at {at}")
    name_end, start = take(OTHER_MIDDLE, at + len(OTHER_OPEN))
    end, after = take(OTHER_CLOSE, start)
    return unescape(source[at + len(OTHER_OPEN):name_end]), unescape(source[start:end]), start, end, after


def parse(source: str) -> Iterator[tuple[str, str, int, int]]:
    """All turns of a rendered conversation: role, text, and the span of the text in ``source``."""
    at = 0
    while at < len(source):
        role, text, start, end, at = parse_turn(source, at)
        yield role, text, start, end


def render_turn(role: str, text: str) -> tuple[str, int, int, bool]:
    """Rendered turn, the span of its text, and whether something had to be escaped."""
    for change in (str, escape):
        name, body = change(role), change(text)
        opening, close = MARKS.get(role, (f"{OTHER_OPEN}{name}{OTHER_MIDDLE}", OTHER_CLOSE))
        rendered = f"{opening}{body}{close}"
        try:
            got = parse_turn(rendered)
        except GrammarError:
            continue
        if got[0] == role and got[1] == text and got[4] == len(rendered):
            return rendered, got[2], got[3], change is escape
    raise GrammarError(f"cannot render a turn of {len(text)} characters")


def _pieces(batches):
    for b in batches:
        conv, turn, roles, texts = (b.column(i).to_pylist() for i in range(4))
        done = [render_turn(r, t) for r, t in zip(roles, texts)]
        yield pa.RecordBatch.from_arrays([
            pa.array(conv, pa.int64()), pa.array(turn, pa.int64()), pa.array(roles, pa.string()),
            pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int32()),
            pa.array([d[2] for d in done], pa.int32()), pa.array([d[3] for d in done], pa.bool_())],
            names=["conv_id", "turn", "role", "rendered", "text_from", "text_to", "escaped"])


def format_chats(rows: DataFrame) -> DataFrame:
    """One row per turn, in order within its partition: the rendered piece and the span of its text.

    A conversation's formatted text is its pieces one after the other; the loss
    mask is the span of every assistant piece. Turns go by number, then role, then
    text, nulls first. Null role and text are empty; rows with a null conv_id are
    one conversation; repeated rows are turns of their own. Extra columns are
    ignored; an empty table gives no rows.
    """
    turns = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
                 .mapInArrow(_pieces, PIECES))


def _digests(batches):
    now, state, out = object(), None, []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(
            (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    def close():
        if state:
            n, turns, chars, loss, size = state
            out.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), size))

    for b in batches:
        for conv, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if conv != now:
                close()
                now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text, _, _ in parse(source):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if role == "assistant":
                    state[2] += len(text)
                    state[3].update(text.encode())
            state[4] += len(source)
        if len(out) >= 5000:
            yield batch()
            out = []
    close()
    yield batch()


def read_back(pieces: DataFrame) -> DataFrame:
    """What a reader of the formatted text finds, per conversation; ``pieces`` must keep the order of format_chats."""
    return pieces.select("conv_id", "rendered").mapInArrow(_digests, READ_BACK)
