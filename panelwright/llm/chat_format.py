"""Chat formatting in budgeted windows with a loss mask.

Prefix sums of turn tokens choose spans that start and end at turns.  Every
window opens with the conversation's system turn and a limited run of turns
from the window before; both are context.  Each turn is new in one window
only, and only new assistant texts lie under the loss mask.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from panelwright.llm.chunks import library_encoder
from panelwright.llm.common import col, fresh, steps

#: Fixed value: the template's control strings; all start with one of the two bracket signs.
START = "<s>"
OPEN = {"system": "<<SYS>>", "user": "[INST] ", "assistant": " "}
CLOSE = {"system": "<</SYS>>", "user": " [/INST]", "assistant": " </s>"}
OTHER = ("[ROLE]", "[TEXT]", "[/ROLE]")
TURN = re.compile(r"<<SYS>>(?P<system>.*?)<</SYS>>|\[INST\] (?P<user>.*?) \[/INST\]|\[ROLE\](?P<role>.*?)\[TEXT\](?P<text>.*?)\[/ROLE\]| (?P<assistant>.*?) </s>", re.DOTALL)

#: Tokens of a window, of repeated history, and counted for a turn's own marks.
BUDGET, HISTORY, MARKS = 2048, 256, 8


def escape(text: str) -> str:
    """A backslash after every bracket sign, so no control string can stand in a text; reversible."""
    return text.replace("[", "[\\").replace("<", "<\\")


def unescape(text: str) -> str:
    return re.sub(r"([\[<])\\", r"\1", text)


def mark(role: str, text: str) -> tuple[str, int, int]:
    """A turn's marked text and where its escaped text lies in it."""
    head, tail = (OPEN[role], CLOSE[role]) if role in OPEN else (OTHER[0] + escape(role) + OTHER[1], OTHER[2])
    body = escape(text)
    return head + body + tail, len(head), len(head) + len(body)


def read_turns(marked: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each marked turn."""
    at = 0
    while at < len(marked):
        m = TURN.match(marked, at)
        if m is None:
            raise ValueError("not a marked turn")
        if m["role"] is not None:
            yield unescape(m["role"]), unescape(m["text"])
        else:
            yield m.lastgroup, unescape(m[m.lastgroup])
        at = m.end()


class WindowBuilder:
    """Windows of one conversation as its turns come; holds one window's turns at most."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.total = 0  # prefix sum of turn tokens
        self.system: tuple | None = None
        self.past: deque = deque()  # (prefix sum before, turn) of the latest turns
        self.new: list = []
        self.number = 0
        self._open()

    def _open(self) -> None:
        self.new, self.begin = [], self.total
        while self.past and self.total - self.past[0][0] > self.history:
            self.past.popleft()
        self.context = [t for _, t in self.past]
        if self.system and not any(t is self.system for t in self.context):
            self.context.insert(0, self.system)
        self.room = self.budget - sum(t[2] for t in self.context)

    def add(self, role: str, text: str, tokens: int) -> dict | None:
        """Take a turn; returns the finished window if it does not fit any more."""
        made = None
        if self.new and self.total + tokens - self.begin > self.room:
            made = self.close()
            self._open()
        turn = (role, text, tokens)
        self.new.append(turn)
        self.past.append((self.total, turn))
        self.total += tokens
        while self.past[0][0] < self.total - tokens - self.history:  # no later window repeats it
            self.past.popleft()
        if role == "system":
            self.system = turn
        return made

    def close(self) -> dict:
        parts, at, loss, begin = [START], len(START), [], 0
        for k, (role, text, _) in enumerate([*self.context, *self.new]):
            if k == len(self.context):
                begin = at
            marked, a, b = mark(role, text)
            if k >= len(self.context) and role == "assistant":
                loss.append({"begin": at + a, "end": at + b})
            parts.append(marked)
            at += len(marked)
        self.number += 1
        return {"window": self.number - 1, "formatted": "".join(parts), "new_from": begin, "loss": loss, "n_new": len(self.new), "n_tokens": sum(t[2] for t in [*self.context, *self.new])}


WINDOW = "window long, formatted string, new_from long, loss array<struct<begin: long, end: long>>, n_new long, n_tokens long"
WINDOW_TYPE = pa.schema([("conv_id", pa.int64()), ("window", pa.int64()), ("formatted", pa.string()), ("new_from", pa.int64()), ("loss", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), ("n_new", pa.int64()), ("n_tokens", pa.int64())])


def format_conversations(df: DataFrame, path: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, window, formatted, new_from, loss, n_new, n_tokens.

    ``new_from`` is the code point where the turns that were not in an earlier
    window begin; ``loss`` holds the code-point spans of the new assistant
    texts (escaped).  Turns follow ``turn`` (nulls first), then role and text,
    repeated rows included.  Null text and null role count as empty; rows
    without a conv_id form one conversation.  A turn longer than the budget
    has a window of its own, whole.  Tokens are counted where the rows lie,
    before the one shuffle by conversation, so a conversation with very many
    turns costs one task only the walk over its windows; a task holds one
    window, however long a conversation is.  Very long texts are encoded a few
    at a time.  A conv_id must be a number or read as one.  An empty table
    gives no row; other columns are not read.
    """
    src = df.select(col("conv_id").cast("long").alias("conv_id"), col("turn").alias("turn"), F.coalesce(col("role"), F.lit("")).alias("role"), F.coalesce(col("text"), F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        encoder = library_encoder(path)
        for batch in batches:
            for part in steps(batch, 3):
                tokens = [len(x) // 4 + MARKS for x in encoder.encode([escape(t) for t in part.column(3).to_pylist()])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(tokens, pa.int64())], counted.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, builder = None, None
        for batch in batches:
            made = []
            for conv, role, text, n in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if builder is None or conv != now:
                    if builder is not None:
                        made.append({"conv_id": now, **builder.close()})
                    now, builder = conv, WindowBuilder(budget, history)
                done = builder.add(role, text, n)
                if done:
                    made.append({"conv_id": now, **done})
            yield pa.RecordBatch.from_pylist(made, WINDOW_TYPE)
        if builder is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": now, **builder.close()}], WINDOW_TYPE)

    counted = StructType([*src.schema.fields, StructField("tokens", LongType())])
    turns = src.mapInArrow(count, counted).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return turns.mapInArrow(run, f"conv_id long, {WINDOW}")
