"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a text.  Its output is
rendered for successive turn prefixes; what a prefix adds to the one before is the
turn's span, and an output that does not begin with the one before shows a template
that rewrites history.  Rendering a turn once more with an empty text locates the text
inside its span.  Prefixes are whole at every length: of a black-box template a task holds
one conversation, and its work grows with the square of the turns.  Only an ``Additive``
template, whose output is by construction one piece per turn, is rendered over the last
``CONTEXT`` to ``2 * CONTEXT`` turns: the same rows, with bounded memory and work.

Rows are shuffled by conversation, sorted by turn and streamed.  Definitions: null roles and texts count as empty; rows of one turn go
by role, then text; repeated rows are turns of their own; a null turn comes first;
rows without ``conv_id`` form one conversation.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from typing import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
CONTEXT = 64
#: Marks that stand for control characters inside texts (fixed values of the template).
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"), ("]", "&rsqb;"))


def escape(text: str) -> str:
    for plain, mark in ESCAPES:
        text = text.replace(plain, mark)
    return text


def unescape(text: str) -> str:
    for plain, mark in reversed(ESCAPES):
        text = text.replace(mark, plain)
    return text


@dataclass(frozen=True)
class Additive:
    """A template that is ``start``, then ``piece`` of each turn, which sees that turn alone:
    no piece can depend on other turns, on their number or on the turn's place."""

    start: str
    piece: Callable[[str, str], str]

    def __call__(self, turns: list[Turn]) -> str:
        return self.start + "".join(self.piece(role, text) for role, text in turns)


def turn_piece(role: str, text: str) -> str:
    return f"[{escape(role)}]\n{escape(text)}</s>\n"


#: ``<s>``, then per turn ``[role]``, a line break, the escaped text and ``</s>``.
template = Additive("<s>", turn_piece)


_TURN = re.compile(r"(?:<s>)?\[([^\[\]<]*)\]\n([^\[\]<]*)</s>\n")


def _agree(a: str, b: str) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    low, high = 0, n
    if a[:n] == b[:n]:
        return n
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


def turn_span(render: Callable[[list[Turn]], str], before: list[Turn], out: str, turn: Turn):
    """(new output, start of the span, start and end of the text in it, whether the
    output begins with the one before)."""
    after = render([*before, turn])
    kept = _agree(out, after)
    empty = render([*before, (turn[0], "")])
    head = max(_agree(empty, after), kept)
    tail = min(_agree(empty[::-1][:len(empty) - head], after[::-1][:len(after) - head]), len(after) - head)
    return after, kept, head, len(after) - tail, kept == len(out)


_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("piece", pa.string()),
    ("text_start", pa.int64()), ("text_end", pa.int64()), ("stable", pa.bool_())])
SCHEMA = ("conv_id long, turn long, role string, piece string, text_start long, text_end long, stable boolean")


def format_turns(conversations: DataFrame, render: Callable[[list[Turn]], str] = template) -> DataFrame:
    """One row per turn in order: the piece of the formatted conversation that it adds,
    the place of its text in that piece, and whether the template left what stood
    before as it was (else ``piece`` begins where the outputs part)."""
    bounded = type(render) is Additive  # not a subclass, which may render otherwise

    def run(batches):
        conv, turns, out, number = object(), [], "", 0
        for b in batches:
            rows = {f.name: [] for f in _ARROW}
            for c, role, text in zip(*(b.column(x).to_pylist() for x in ("conv_id", "role", "text"))):
                if c != conv:
                    conv, turns, out, number = c, [], "", 0
                if bounded and len(turns) >= 2 * CONTEXT:
                    turns = turns[-CONTEXT:]
                    out = render(turns)
                turn = (role or "", text or "")
                after, start, a, z, stable = turn_span(render, turns, out, turn)
                for name, value in (("conv_id", c), ("turn", number), ("role", turn[0]), ("piece", after[start:]),
                                    ("text_start", a - start), ("text_end", z - start), ("stable", stable)):
                    rows[name].append(value)
                turns.append(turn)
                out, number = after, number + 1
            yield pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in _ARROW], schema=_ARROW)

    ordered = (conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))
    return ordered.mapInArrow(run, SCHEMA)


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests per conversation, parsed from the formatted pieces alone: the turns from
    the template's marks, the trained text from the loss mask (assistant texts)."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches):
        conv, state = object(), None
        for b in batches:
            rows: list[tuple] = []
            for c, piece, a, z in zip(*(b.column(x).to_pylist() for x in ("conv_id", "piece", "text_start", "text_end"))):
                if state is None or c != conv:
                    if state is not None:
                        rows.append(done(conv, state))
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                m = _TURN.fullmatch(piece)
                role, text = unescape(m[1]), unescape(m[2])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if role == "assistant":
                    loss = unescape(piece[a:z])
                    state[2] += len(loss)
                    state[3].update(loss.encode())
                state[4] += len(piece)
            yield made(rows)
        if state is not None:
            yield made([done(conv, state)])

    def done(conv, s):
        return conv, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]

    def made(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return pieces.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                  "loss_sha256 string, formatted_chars long")
