"""Chat formatting with a grammar round trip.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. Every written turn is read back by the
deterministic ``Reader``; while what it recovers differs from the source, the conflicting field is
escaped and the turn is written anew. The reader always takes one level of escapes away, so a text
stays as it is unless it holds a control string or something that looks escaped.

Written turns are a prefix code: a conversation is their concatenation, and reading it back gives the
same turns. So turns are written row by row without a shuffle, and a conversation of any length is
read back as a stream in one sorted partition, one turn in memory at a time.

Null texts and roles are empty. Turns are ordered by ``turn`` (nulls first), then role, then text;
repeated rows are repeated turns. A null conv_id is one conversation of its own. An empty table gives
no rows. Columns besides the four are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The template's control strings.
START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"


def escape(text: str) -> str:
    """One more backslash in every ``<``, backslashes, ``|``."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """A role ends at the line end, so that is escaped too."""
    return escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\([\\n])", lambda m: "\n" if m[1] == "n" else "\\", role))


class Reader:
    """Reads turns back from written text, which may come in chunks cut anywhere.

    A control string inside a role or a text is not part of the grammar: reading stops before it.
    """

    def __init__(self) -> None:
        self.rest = ""

    def turn_at(self, at: int) -> tuple[int, int, int] | None:
        """Where the text of the turn begins and ends, and where the turn does."""
        s = self.rest
        line = s.find("\n", at)
        end = s.find(END, line + 1)
        after = end + len(END) + 1
        if not s.startswith(START, at) or line < 0 or end < 0 or s[after - 1:after] != "\n":
            return None
        if s.find(START, at + 1, end) >= 0 or s.find(END, at, line) >= 0:
            return None
        return line + 1, end, after

    def feed(self, chunk: str) -> Iterator[tuple[str, str, tuple[int, int]]]:
        """Role, text and the span of the written text in what was left, for each turn that ends."""
        self.rest += chunk
        at = 0
        while found := self.turn_at(at):
            begin, end, after = found
            yield unescape_role(self.rest[at + len(START):begin - 1]), unescape(self.rest[begin:end]), (begin, end)
            at = after
        self.rest = self.rest[at:]


def read_back(written: str) -> list[tuple[str, str]] | None:
    """The turns of ``written``; None if it doesn't follow the grammar."""
    reader = Reader()
    turns = [turn[:2] for turn in reader.feed(written)]
    return None if reader.rest else turns


def write_turn(role: str, text: str) -> str:
    """The turn in the template, escaped no more than its round trip needs."""
    as_role, as_text = role, text
    while True:
        written = f"{START}{as_role}\n{as_text}{END}\n"
        turns = read_back(written)
        if turns == [(role, text)]:
            return written
        if as_text == text and (START in text or END in text or unescape(text) != text):
            as_text = escape(text)
        elif as_role == role:
            as_role = escape_role(role)
        else:
            raise AssertionError(f"no round trip for {role!r}, {text!r}")


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``written``, the turn in the template; no shuffle."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            written = pa.array([write_turn(r, t) for r, t in zip(roles, texts)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, written], [*batch.schema.names, "written"])

    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(write, "conv_id long, turn long, role string, text string, written string")


class Digest:
    """What is read back of one conversation, as its written turns stream by."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.n_turns, self.loss_chars, self.formatted_chars = conv_id, 0, 0, 0
        self.turns, self.loss, self.reader = hashlib.sha256(), hashlib.sha256(), Reader()

    def add(self, written: str) -> None:
        self.formatted_chars += len(written)
        unread = self.reader.rest + written
        for role, text, (start, end) in self.reader.feed(written):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            if role == LEARNED_ROLE:
                # the loss mask covers the written text of the turn
                learned = unescape(unread[start:end])
                self.loss_chars += len(learned)
                self.loss.update(learned.encode())

    def row(self) -> tuple:
        if self.reader.rest:
            raise ValueError(f"conversation {self.conv_id} doesn't end with a turn")
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(),
                self.formatted_chars)


def read_digests(rows: DataFrame) -> DataFrame:
    """One row per conversation, read back from the ``written`` turns of ``formatted``."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for batch in batches:
            done = []
            for conv_id, written in zip(batch.column("conv_id").to_pylist(), batch.column("written").to_pylist()):
                if current is None or current.conv_id != conv_id:
                    if current:
                        done.append(current.row())
                    current = Digest(conv_id)
                current.add(written)
            yield rows_batch(done, schema)
        if current:
            yield rows_batch([current.row()], schema)

    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "written")
            .mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                              "loss_sha256 string, formatted_chars long"))


def rows_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
