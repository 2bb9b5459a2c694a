"""Fill-in-middle transformation by displacement scatter.

A text is cut into lines; two cuts drawn from the document's id give a prefix, a middle and a suffix.
Every byte keeps its order inside its part, so a part is moved by one displacement. For a whole batch
the cuts are scanned at once, the changes of displacement from part to part are added into a difference
array over the input bytes, its cumulative sum is each byte's displacement, and one scatter writes all
outputs. Reading back is the inverse: the marks of the output give a difference array over the bytes of the
restored texts, and one gather fetches them.

Forms are ``psm`` (``<P>`` prefix ``<S>`` suffix ``<M>`` middle), ``spm`` (``<S>`` suffix ``<P>`` prefix
``<M>`` middle) and ``plain``, the text itself. Texts that are empty or hold a mark stay plain, so every mark of a
psm or spm output was written here: none can arise across an edge, as ``<`` occurs in a mark only first.

No row meets another one: nothing is shuffled. Null texts are empty. A null doc_id draws as the empty
string does. Repeated rows give repeated rows, an empty table none. A text of any length is worked on as a
whole, with a few arrays as long as itself. Other columns of the input are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastria.llm.common import slices
from cadastria.llm.hashing import utf8

#: The marks before prefix, suffix and middle.
MARKS = (b"<P>", b"<S>", b"<M>")
PREFIX, SUFFIX, MIDDLE = range(3)
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: In an output, the order of the parts by form.
ORDER = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}
WIDTH = 3


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers that follow from ``seed`` and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def marks_in(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, kind and text of all marks that lie in one text."""
    found = []
    for kind, mark in enumerate(MARKS):
        a, b, c = mark
        at = np.flatnonzero((data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c)) if len(data) > 2 else np.zeros(0, np.int64)
        found.append((at, np.full(len(at), kind)))
    at, kind = (np.concatenate(x) for x in zip(*found))
    text = np.searchsorted(offsets, at, side="right") - 1
    inside = at + WIDTH <= offsets[text + 1]
    return at[inside], kind[inside], text[inside]


def displaced(positions: np.ndarray, shifts: np.ndarray, size: int) -> np.ndarray:
    """The displacement of each of ``size`` bytes, given where parts begin, in order, and what theirs are."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, positions, np.diff(shifts, prepend=0))
    return np.cumsum(change[:-1])


class Cuts:
    """Where the texts of a batch are cut and what form each takes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, h: list[np.ndarray], rate: int, spm_rate: int) -> None:
        start, end = offsets[:-1], offsets[1:]
        breaks = np.flatnonzero(data == 10)
        before = np.searchsorted(breaks, offsets)
        whole_lines = np.diff(before)
        open_line = (end > start) & (data[np.maximum(end - 1, 0)] != 10) if len(data) else np.zeros(len(start), bool)
        self.n = whole_lines + open_line
        marked = np.zeros(len(start), bool)
        marked[marks_in(data, offsets)[2]] = True
        plain = (end == start) | marked | (h[2] % 100 >= rate)
        self.form = np.where(plain, PLAIN, np.where(h[3] % 100 < spm_rate, SPM, PSM))

        def after(units: np.ndarray) -> np.ndarray:
            line_end = breaks[np.clip(before[:-1] + units - 1, 0, max(len(breaks) - 1, 0))] + 1 if len(breaks) else end
            return np.where(units == 0, start, np.where(units <= whole_lines, line_end, end))

        drawn = [x % (self.n + 1) for x in h[:2]]
        self.first = np.where(plain, end, after(np.minimum(*drawn)))
        self.second = np.where(plain, end, after(np.maximum(*drawn)))


def scattered(data: np.ndarray, offsets: np.ndarray, cuts: Cuts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the outputs."""
    start, end = offsets[:-1], offsets[1:]
    cut = cuts.form != PLAIN
    out_offsets = np.r_[0, np.cumsum(end - start + len(MARKS) * WIDTH * cut)]
    # by part: where it begins in the input, its length, where it begins in the output
    begin = np.stack([start, cuts.second, cuts.first])
    length = np.stack([cuts.first - start, end - cuts.second, cuts.second - cuts.first])
    place = np.broadcast_to(out_offsets[:-1], begin.shape).copy()
    out = np.empty(out_offsets[-1], np.uint8)
    for form, order in ORDER.items():
        rows = np.flatnonzero(cuts.form == form)
        at = out_offsets[rows]
        for part in order:
            for k, byte in enumerate(MARKS[part]):
                out[at + k] = byte
            place[part, rows] = at + WIDTH
            at = at + WIDTH + length[part, rows]
    in_order = [PREFIX, MIDDLE, SUFFIX]
    shift = displaced(begin[in_order].T.ravel(), (place - begin)[in_order].T.ravel(), len(data))
    out[np.arange(len(data)) + shift] = data
    return out, out_offsets


def gathered(data: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts that outputs were made from."""
    start, end = offsets[:-1], offsets[1:]
    cut = form != PLAIN
    at, kind, text = marks_in(data, offsets)
    written = cut[text]
    mark = np.full((len(MARKS), len(form)), -1)
    mark[kind[written], text[written]] = at[written]
    if written.sum() != len(MARKS) * cut.sum() or (mark[:, cut] < 0).any():
        raise ValueError("an output has to hold each mark once")
    size = end - start - len(MARKS) * WIDTH * cut
    back_offsets = np.r_[0, np.cumsum(size)]
    begin, length = np.broadcast_to(start, mark.shape).copy(), np.zeros(mark.shape, np.int64)
    length[PREFIX] = size
    for name, order in ORDER.items():
        rows = np.flatnonzero(form == name)
        stops = [*(mark[part, rows] for part in order[1:]), end[rows]]
        for part, stop in zip(order, stops):
            begin[part, rows] = mark[part, rows] + WIDTH
            length[part, rows] = stop - begin[part, rows]
    in_order = [PREFIX, MIDDLE, SUFFIX]
    place = back_offsets[:-1] + np.cumsum(length[in_order], axis=0) - length[in_order]
    shift = displaced(place.T.ravel(), (begin[in_order] - place).T.ravel(), back_offsets[-1])
    return data[np.arange(back_offsets[-1]) + shift], back_offsets


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def transformed(docs: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars (code points, null if plain) and output of every document.

    ``rate`` percent of the texts are cut, and of those ``spm_rate`` percent take the form spm.
    """
    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            cuts = Cuts(data, offsets, [batch.column(f"h{k}").to_numpy() for k in range(1, 5)], rate, spm_rate)
            chars = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
            plain = cuts.form == PLAIN
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(cuts.n, pa.int64()), pa.array(cuts.form, pa.string()),
                 pa.array(chars[cuts.first] - chars[offsets[:-1]], pa.int64(), mask=plain),
                 pa.array(chars[cuts.second] - chars[cuts.first], pa.int64(), mask=plain),
                 strings(*scattered(data, offsets, cuts))],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       *draws(F.col("doc_id"), seed))
    return rows.mapInArrow(transform, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(rows: DataFrame) -> DataFrame:
    """``rows`` with the text that ``output`` was made from, told by ``output`` and ``form`` alone, as ``text``."""
    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "output"):
            form = batch.column("form").to_numpy(zero_copy_only=False).astype(str)
            texts = strings(*gathered(*utf8(batch.column("output")), form))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "text"])

    kept = rows.drop("text")
    return kept.mapInArrow(restore, ", ".join(f"`{n}` {t}" for n, t in kept.dtypes) + ", text string")
