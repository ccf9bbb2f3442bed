"""Operator 4: chat formatting in budgeted windows.

Turns are written as ``<|role|>`` + escaped text + ``</s>`` + newline; a control string
inside a role or text is broken up by a backslash escape that is undone on
reading: ``\\`` becomes ``\\\\``, ``<`` becomes ``\\l`` and ``[`` becomes ``\\b``.
No text can then hold a control string of the template or of another one.

A conversation is cut into windows of about ``budget`` tokens.  Prefix sums
of turn tokens choose turn-aligned spans: from a window's first new turn, the
longest run of turns that fits beside the system turn and the repeated
history (the turns just before, at most ``history`` tokens).  The system turn (the first
turn, if its role is ``system``) opens every window.  A turn larger than the room
left makes a window of its own; no text is cut.  The loss mask covers the texts of
assistant turns, but not those of repeated turns, so each assistant text is a
target once.

Tokens of a turn are its characters over ``chars_per_token``, rounded up, and
at least one.

A conversation's turns meet in one task and stream through it, sorted, so the
task holds one window's turns and the turns that may be repeated.

Defined cases: null text is empty and null role is the empty role; rows with
equal (conv_id, turn) follow by role, then text; a null turn comes first;
rows of a null conv_id are one conversation; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.llm.common import stored, table

WINDOW_SCHEMA = ("conv_id long, window_id int, text string, n_tokens long, "
                 "turns array<struct<role:string,repeated:boolean,from:long,to:long,loss:boolean>>")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\l").replace("[", "\\b")


def unescape(text: str) -> str:
    out, at = [], 0
    while (k := text.find("\\", at)) >= 0:
        out += [text[at:k], {"\\": "\\", "l": "<", "b": "["}[text[k + 1]]]
        at = k + 2
    return "".join([*out, text[at:]])


class Windows:
    """Windows of one conversation, made while its turns arrive in order."""

    def __init__(self, budget: int, history: int, chars_per_token: int):
        self.budget, self.history, self.chars = budget, history, chars_per_token
        self.system: tuple | None = None
        self.first = True
        self.shown: list[tuple] = []   # turns already given out that may be repeated
        self.fresh: list[tuple] = []   # new turns of the open window
        self.upto = [0]                # prefix sums of the tokens of ``fresh``
        self.number = 0

    def tokens(self, text: str) -> int:
        return max(1, -(-len(text) // self.chars))

    def _repeated(self) -> list[tuple]:
        room, out = self.history, []
        for turn in reversed(self.shown):
            if turn[2] > room:
                break
            room -= turn[2]
            out.append(turn)
        return out[::-1]

    def add(self, role: str, text: str) -> Iterator[tuple]:
        turn = (role, text, self.tokens(text))
        if self.first and role == "system":
            self.system, self.first = turn, False
            return
        self.first = False
        fixed = (self.system[2] if self.system else 0) + sum(t[2] for t in self._repeated())
        if self.fresh and fixed + self.upto[-1] + turn[2] > self.budget:
            yield self._close()
        self.fresh.append(turn)
        self.upto.append(self.upto[-1] + turn[2])

    def _close(self) -> tuple:
        head = [(self.system, self.number > 0)] if self.system else []
        turns = head + [(t, True) for t in self._repeated()] + [(t, False) for t in self.fresh]
        parts, marks, at = [], [], 0
        for (role, text, _), again in turns:
            opening = f"<|{escape(role)}|>"
            body = escape(text)
            parts += [opening, body, "</s>\n"]
            start = at + len(opening)
            marks.append({"role": role, "repeated": again, "from": start, "to": start + len(body),
                          "loss": role == "assistant" and not again})
            at = start + len(body) + 5
        out = (self.number, "".join(parts), sum(t[0][2] for t in turns), marks)
        self.shown += self.fresh
        self.shown, self.fresh, self.upto = self._repeated(), [], [0]
        self.number += 1
        return out

    def end(self) -> Iterator[tuple]:
        if self.fresh or (self.system and not self.number):
            yield self._close()


def format_chats(turns: DataFrame, *, budget: int = 512, history: int = 128, chars_per_token: int = 4) -> DataFrame:
    """One row per window: conv_id, window_id, text, n_tokens, turns (role, repeated, text span, loss)."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        now, conv = ("",), None

        def batch_of() -> pa.RecordBatch:
            kinds = pa.list_(pa.struct([("role", pa.string()), ("repeated", pa.bool_()), ("from", pa.int64()),
                                        ("to", pa.int64()), ("loss", pa.bool_())]))
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in
                 enumerate((pa.int64(), pa.int32(), pa.string(), pa.int64(), kinds))],
                ["conv_id", "window_id", "text", "n_tokens", "turns"])

        for batch in batches:
            for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (conv_id,) != now:
                    if conv:
                        rows += [(now[0], *w) for w in conv.end()]
                    now, conv = (conv_id,), Windows(budget, history, chars_per_token)
                made = [(conv_id, *w) for w in conv.add(role, text)]
                rows += made
                size += len(text)
                if size > 8 << 20:
                    yield batch_of()
                    rows, size = [], 0
        if conv:
            rows += [(now[0], *w) for w in conv.end()]
        yield batch_of()

    clean = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                         F.coalesce("text", F.lit("")).alias("text"))
    return (clean.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(windows, WINDOW_SCHEMA))


def parse_window(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn written in a window."""
    out = []
    for turn in text.split("</s>\n")[:-1]:
        role, _, body = turn[2:].partition("|>")
        out.append((unescape(role), unescape(body)))
    return out


def read_back(windows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), parsed from the
    windows' texts and loss spans."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now, state = ("",), None

        def done():
            out.append((now[0], state["n"], state["all"].hexdigest(), state["chars"], state["loss"].hexdigest(),
                        state["size"]))

        for batch in batches:
            for conv_id, text, marks in zip(*(c.to_pylist() for c in batch.columns)):
                if (conv_id,) != now:
                    if state:
                        done()
                    now = (conv_id,)
                    state = {"n": 0, "chars": 0, "size": 0, "all": hashlib.sha256(), "loss": hashlib.sha256()}
                state["size"] += len(text)
                for (role, body), mark in zip(parse_window(text), marks, strict=True):
                    if not mark["repeated"]:
                        state["n"] += 1
                        state["all"].update(f"{role}\n{body}\n".encode())
                    if mark["loss"]:
                        target = unescape(text[mark["from"]:mark["to"]])
                        state["chars"] += len(target)
                        state["loss"].update(target.encode())
        if state:
            done()
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)],
                                         ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                          "formatted_chars"])

    return (windows.repartition("conv_id").sortWithinPartitions("conv_id", "window_id")
            .select("conv_id", "text", "turns").mapInArrow(
                digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                         "formatted_chars long"))


def op4_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(stored(format_chats(turns), "chat-windows"))
