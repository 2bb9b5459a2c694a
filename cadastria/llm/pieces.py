"""SentencePiece encoding and decoding with a table of distinct chunks.

Where no piece of the model has a whitespace marker behind another character, merges never cross
into a marker, so a text falls into chunks (markers, then what follows them) that are segmented on
their own. Each distinct chunk is segmented once, its ids go into a table, and the ids of a text are
the table's entries joined by position. The table lives in the task and is started anew beyond
``TABLE_ENTRIES``, so memory is bounded; chunks over ``LONGEST`` characters are not kept in it.

Null texts are empty and have only the begin and end ids. Repeated rows give repeated rows. Only
doc_id and text are read; the results have no other columns of the input.
"""

from __future__ import annotations

import hashlib
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastria.llm.common import slices

MARKER = "\u2581"
CHUNK = re.compile(f"{MARKER}+[^{MARKER}]*")
CROSSING = re.compile(f"[^{MARKER}]{MARKER}")
TABLE_ENTRIES = 600_000
LONGEST = 64


@lru_cache(maxsize=2)
def processor(model: str) -> sentencepiece.SentencePieceProcessor:
    """The model, checked for what the chunk table relies on."""
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    crossing = [p for p in pieces if CROSSING.search(p)]
    plain = "  \uff21\u00a0a\u0301 \ufb01 "
    if crossing or sp.encode(" ", out_type=str) != [MARKER * 2] or sp.decode(sp.encode(plain)) != plain:
        raise ValueError("chunks can't be segmented on their own with this model")
    return sp


def chunks_of(text: str) -> list[str]:
    """The chunks of a text, each without the marker it begins with."""
    if not text:
        return []
    marked = MARKER + text.replace(" ", MARKER)
    if MARKER * 2 in marked:
        return [c[1:] for c in CHUNK.findall(marked)]
    return marked.split(MARKER)[1:]


class ChunkTable:
    """Native-endian 32-bit ids of distinct chunks."""

    def __init__(self, model: str) -> None:
        if sys.byteorder != "little":
            raise RuntimeError("ids are kept in little-endian order")
        self.sp = processor(model)
        self.clear()

    def clear(self) -> None:
        # a lone marker: without its marker the chunk is the empty text
        self.ids = {"": array("I", [self.sp.piece_to_id(MARKER)]).tobytes()}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, with begin and end."""
        begin, end = (array("I", [x]).tobytes() for x in (self.sp.bos_id(), self.sp.eos_id()))
        if len(self.ids) > TABLE_ENTRIES:
            self.clear()
        chunked = [chunks_of(t) for t in texts]
        new = list({c for chunks in chunked for c in chunks if c not in self.ids})
        self.ids.update(zip(new, [array("I", x).tobytes() for x in self.sp.encode(new, num_threads=1)]))
        joined = [b"".join([begin, *map(self.ids.__getitem__, chunks), end]) for chunks in chunked]
        for c in new:
            if len(c) > LONGEST:
                del self.ids[c]
        return joined


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and ``ids`` (binary, little-endian 32-bit) of every text."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = ChunkTable(model)
        for batch in slices(batches, "text"):
            ids = chunks.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return rows_of(docs).mapInArrow(encode, "doc_id long, ids binary")


def decoded(ids: DataFrame, model: str) -> DataFrame:
    """doc_id, ``ids`` and ``text``, the library's decoding."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(model)
        for batch in slices(batches, "ids"):
            texts = [sp.decode(np.frombuffer(x, "<u4").tolist()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return ids.mapInArrow(decode, "doc_id long, ids binary, text string")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ``ids`` and the decoded ``text`` in one Python pass."""
    return decoded(encoded(docs, model), model)


def rows_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
