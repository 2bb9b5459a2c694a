"""Packing token ids into sequences: shortest-pack-first over the length histogram.

Documents are encoded, closed with an end id and cut into pieces of the sequence length and a rest.
The histogram of piece lengths has at most one bin for each length, so it is small at any number of
documents. ``plan`` places its lengths longest first, each into the shortest pack that exists (the one
with the most room), in bulk: it splits pattern counts instead of moving documents.

Patterns meet documents by rank: the r-th piece of a length takes the r-th slot of that length in the
patterns. A piece is ranked by its place among the task's pieces of its length plus the number of such
pieces in earlier tasks, so no length gathers in one task, however many documents share it.

Null texts are empty and hold the end id alone. Repeated rows are packed as documents of their own.
An empty table gives no rows. The result has no columns of the input other than doc_id.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastria.llm.common import slices, written

LENGTH = 2048
END_ID = 1


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizers file, run by tiktoken: same vocabulary, ranks and pattern."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["normalizer"] or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False,
                                                       "trim_offsets": True, "use_regex": True}:
        raise ValueError("not a plain byte-level BPE")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    # printable stand-ins of bytes: those that are printable stand for themselves, the rest follow from 256
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    ranks = {bytes(byte[c] for c in token): rank for token, rank in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding(
        "from-file", mergeable_ranks=ranks, special_tokens=special,
        # fixed value: how byte-level BPE splits a text
        pat_str=r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def encode(coder: tiktoken.Encoding, text: str) -> np.ndarray:
    """The ids of a text and the end id; special strings in the text are special ids, as the library has it."""
    special = any(x in text for x in coder.special_tokens_set)
    ids = coder.encode_to_numpy(text, allowed_special="all") if special else coder.encode_to_numpy(text, disallowed_special=())
    return np.append(ids, np.uint32(END_ID)).astype("<u4")


PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("task", pa.int32()), ("at", pa.int64())])


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """The pieces of all documents; ``at`` counts the pieces of a length within ``task``."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task = encoding(tokenizer), TaskContext.get().partitionId()
        seen = [0] * (length + 1)
        for batch in slices(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encode(coder, text)
                for start in range(0, len(ids), length):
                    piece = ids[start:start + length]
                    n = len(piece)
                    rows.append((doc_id, start, n, zlib.crc32(piece.tobytes()), len(ids), task, seen[n]))
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PIECES)], schema=PIECES)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task int, at long")


def plan(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[list[int], int]]:
    """Patterns of piece lengths and how many sequences follow each.

    ``open_packs`` has, by room, patterns and counts. A length takes the pack with the most room: the
    shortest pack. If even that has too little room, the length opens new packs.
    """
    open_packs: dict[int, list[tuple[list[int], int]]] = {}
    for size in range(length, 0, -1):
        left = histogram.get(size, 0)
        while left:
            room = max((r for r, packs in open_packs.items() if packs), default=0)
            if room < size:
                open_packs.setdefault(length - size, []).append(([size], left))
                break
            pattern, count = open_packs[room].pop()
            placed = min(left, count)
            if count > placed:
                open_packs[room].append((pattern, count - placed))
            open_packs.setdefault(room - size, []).append(([*pattern, size], placed))
            left -= placed
    return [pack for packs in open_packs.values() for pack in packs]


class Slots:
    """The plan as ranges of ranks: for each length, which sequence and offset the r-th piece has."""

    def __init__(self, patterns: list[tuple[list[int], int]], length: int = LENGTH) -> None:
        ranges: dict[int, list[tuple[int, int, int]]] = {}
        ranks = [0] * (length + 1)
        sequence = 0
        for sizes, count in patterns:
            offset = 0
            for size in sizes:
                ranges.setdefault(size, []).append((ranks[size], sequence, offset))
                ranks[size] += count
                offset += size
            sequence += count
        self.of = {size: tuple(np.array(x, np.int64) for x in zip(*rows)) for size, rows in ranges.items()}

    def find(self, size: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, sequence, offset = self.of[size]
        at = np.searchsorted(first, rank, side="right") - 1
        return sequence[at] + rank - first[at], offset[at]


def packed(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece."""
    cut = written(pieces(docs, tokenizer, length), "pieces")
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    # at most ``length`` rows
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = Slots(plan(histogram, length), length)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    ranked = (cut.join(offsets, ["length", "task"])
              .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("at") + F.col("earlier")).alias("rank")))
    sent = docs.sparkSession.sparkContext.broadcast(slots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ranks = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                sequence[rows], offset[rows] = sent.value.find(int(size), ranks[rows])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                [*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                    "sequence_id long, offset long")
