"""Chat formatting with a grammar round trip.

Template: `<|im_start|>ROLE\\nTEXT\\n<|im_end|>\\n` for each turn.  A turn is
first rendered as it is and parsed again by the grammar below; if the parser
doesn't give back the same role and text, content that conflicts is escaped
and the turn is rendered again, until source and parse are identical.

Grammar: a control string with no backslash before it is markup; with
backslashes, it is text and one of them belongs to the escape.  In a role the
line end, the control strings' first letters and % stand as %XX.

Turns stream through the tasks in order, one piece of text per turn, so a
conversation of any length needs the memory of one turn.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import small_batches

#: Control strings of common chat templates.
CONTROLS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LOSS_ROLES = ("assistant",)
_ANY = "|".join(map(re.escape, CONTROLS))
_WITH_SLASHES = re.compile(rf"(\\*)({_ANY})")
_START = "<|im_start|>"
_END = "\n<|im_end|>\n"


class GrammarError(ValueError):
    """The text isn't a sequence of turns."""


def escape(text: str) -> str:
    """One more backslash before every control string."""
    return _WITH_SLASHES.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return _WITH_SLASHES.sub(lambda m: m[0][1:] if m[1] else m[0], text)


def _role_in(role: str) -> str:
    return re.sub(r"[%\n<\[\\]", lambda m: f"%{ord(m[0]):02X}", role)


def _role_out(role: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), role)


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; start:end is the turn's (escaped) text in `rendered`."""
    turns, at = [], 0
    while at < len(rendered):
        if not rendered.startswith(_START, at):
            raise GrammarError(f"a turn must start at {at}")
        line = rendered.find("\n", at)
        if line < 0:
            raise GrammarError("a role has no end")
        body, look, end = line + 1, line + 1, -1
        # The first control string without a backslash must be the end of the turn.
        for m in _WITH_SLASHES.finditer(rendered, look):
            if not m[1]:
                end = m.start()
                break
        stop = end - 1
        if stop < body or not rendered.startswith(_END, stop):
            raise GrammarError(f"no end of turn at {end}")
        turns.append((_role_out(rendered[at + len(_START):line]), unescape(rendered[body:stop]), body, stop))
        at = stop + len(_END)
    return turns


def render_turn(role: str, text: str) -> str:
    """The turn's rendering whose parse is the turn itself: plain if that holds, else with conflicts escaped."""
    plain_role, body = role, text
    for _ in range(3):
        rendered = f"{_START}{plain_role}\n{body}{_END}"
        try:
            if [t[:2] for t in parse(rendered)] == [(role, text)]:
                return rendered
        except GrammarError:
            pass
        plain_role, body = _role_in(role), escape(text)
    raise GrammarError("the turn can't be written")


def format_chats(talks: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", loss_roles=LOSS_ROLES) -> DataFrame:
    """(conv_id, nth, piece, char_start, loss_start, loss_end): the formatted conversations, one piece per turn.

    A conversation's text is its pieces in order of nth; char_start is where a
    piece begins in it and loss_start:loss_end the trained part of it (null for
    other roles), all in code points.  Turns stand by turn (null first), then
    role, then text; null role and text count as empty; rows that repeat a
    turn are turns of their own; null is a conversation id like any other.
    """
    small_batches(talks.sparkSession)
    rows = talks.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["conv"].dataType.simpleString()
    rows = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")

    def run(batches):
        now, nth, at = object(), 0, 0
        for batch in batches:
            out = {k: [] for k in ("nth", "piece", "char_start", "loss_start", "loss_end")}
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if conv != now:
                    now, nth, at = conv, 0, 0
                piece = render_turn(role, text)
                _, _, start, end = parse(piece)[0]
                loss = role in loss_roles
                for k, v in zip(out, (nth, piece, at, at + start if loss else None, at + end if loss else None)):
                    out[k].append(v)
                nth, at = nth + 1, at + len(piece)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, pa.string() if k == "piece" else pa.int64()) for k, v in out.items())],
                ["conv", *out])

    out = rows.mapInArrow(run, f"conv {kind}, nth long, piece string, char_start long, loss_start long, loss_end long")
    return out.withColumnRenamed("conv", conv_col)


class _Digest:
    """What is read back of one conversation."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, piece: str, char_start: int, loss_start: int | None, loss_end: int | None) -> None:
        if char_start != self.chars:
            raise GrammarError("pieces are missing or out of order")
        for role, text, _, _ in parse(piece):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        if loss_start is not None:
            masked = unescape(piece[loss_start - char_start:loss_end - char_start])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())
        self.chars += len(piece)


def read_back(pieces: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation, from the output of format_chats alone: turns and loss text are parsed and unescaped."""
    kind = pieces.schema[conv_col].dataType.simpleString()
    # format_chats has the pieces in this order already; a stored table may not.
    rows = pieces.select(F.col(conv_col).alias("conv"), "nth", "piece", "char_start", "loss_start", "loss_end")
    rows = rows.repartition("conv").sortWithinPartitions("conv", "nth")

    def run(batches):
        now, digest, done = None, None, []

        def rows_out():
            cols = list(zip(*done)) if done else [[] for _ in range(6)]
            done.clear()
            return cols

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5))):
                if digest is None or row[0] != now:
                    if digest is not None:
                        done.append((now, digest.n, digest.turns.hexdigest(), digest.loss_chars, digest.loss.hexdigest(), digest.chars))
                    now, digest = row[0], _Digest()
                digest.add(*row[1:])
            if done:
                yield _digest_batch(rows_out(), batch.schema.field(0).type)
        if digest is not None:
            done.append((now, digest.n, digest.turns.hexdigest(), digest.loss_chars, digest.loss.hexdigest(), digest.chars))
            yield _digest_batch(rows_out(), batch.schema.field(0).type)

    out = rows.mapInArrow(run, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return out.withColumnRenamed("conv", conv_col)


def _digest_batch(cols, kind):
    types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names)
