"""Document fingerprints: invertible Bloom lookup tables over hashed paragraphs.

A text's paragraphs (lines, cut after sentence ends) become 64-bit digests; a digest is numbered when
it repeats, so the fingerprint is of the multiset. A table of ``cells`` adds each digest to one cell
in each of three parts. Two tables of one size subtract cell by cell, what both texts share cancels,
and peeling cells that hold a single digest recovers the digests of either side. If a cell is left
over the tables were too small: both are built again with twice the cells, until peeling succeeds.

The likeness of two texts is the number of shared digests over the number of all, 1 for two empty
texts. The fingerprint is the table of the smallest size as text, with the digest count, so equal
texts have equal fingerprints. Null texts are empty: no paragraphs, an empty table.

Rows are compared with the next row by descending doc_id, ties by text; null ids come last and the
first row follows the last. A single row follows itself. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastria.llm.common import slices

#: Cells of the smallest table, in PARTS equal parts of a power of two; a digest has one cell in each part.
CELLS = 12
PARTS = 3
CELL = np.dtype([("n", "<i4"), ("key", "<u8"), ("check", "<u8")])
DIFFERENCE = (T.StructType().add("first", T.ArrayType(T.LongType())).add("second", T.ArrayType(T.LongType()))
              .add("likeness", T.DoubleType()))
#: Bytes of text that are compared at once, besides a single longer text.
COMPARED_BYTES = 1 << 20
PARAGRAPH_END = re.compile(r"(?<=[.!?])\s+|\n+")


def paragraphs(text: str) -> list[str]:
    return [p for p in PARAGRAPH_END.split(text) if p]


def digests(text: str) -> np.ndarray:
    """A 64-bit digest for each paragraph; the n-th copy of one has a digest of its own."""
    out = []
    for paragraph, n in Counter(paragraphs(text)).items():
        key = paragraph.encode()
        out += [hashlib.blake2b(key, digest_size=8, salt=b"%d" % k).digest() for k in range(n)]
    return np.frombuffer(b"".join(out), "<u8")


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(0x9E3779B97F4A7C15 * salt % (1 << 64))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(29))


def part_cells(digest_count: np.ndarray) -> np.ndarray:
    """Cells of one of the PARTS parts: CELLS / PARTS doubled until a table has a cell for every digest."""
    smallest = CELLS // PARTS
    need = np.maximum(np.asarray(digest_count, np.float64) / CELLS, 1.0)
    return smallest << np.ceil(np.log2(need)).astype(np.int64)


class Sketches:
    """Lookup tables, one for each text or pair, of any mix of sizes: digest counts, sums of digests and of checks.

    ``each`` is the number of cells in a part of each table, a power of two. A digest's cell in a small table is its
    cell in a large one modulo the small part, so a table folds down to any smaller size without its digests.
    """

    def __init__(self, each: np.ndarray) -> None:
        self.each = np.asarray(each, np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.each * PARTS)])
        self.count = np.zeros(self.start[-1], np.int64)
        self.keys, self.checks = (np.zeros(self.start[-1], np.uint64) for _ in range(2))

    @classmethod
    def of(cls, lists: list[np.ndarray], each: np.ndarray) -> "Sketches":
        tables = cls(each)
        if lists:
            tables.add(np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.concatenate(lists))
        return tables

    def add(self, row: np.ndarray, key: np.ndarray, sign: np.ndarray | int = 1) -> None:
        sign = np.broadcast_to(np.asarray(sign, np.int64), key.shape)
        each, start = self.each[row], self.start[row]
        for part in range(PARTS):
            at = start + part * each + (mixed(key, part + 1) & (each - 1).astype(np.uint64)).astype(np.int64)
            np.add.at(self.count, at, sign)
            np.add.at(self.keys, at, key * sign.astype(np.uint64))
            np.add.at(self.checks, at, mixed(key, 0) * sign.astype(np.uint64))

    def folded(self, rows: np.ndarray, each: np.ndarray) -> "Sketches":
        """The tables of ``rows``, each brought down to ``each`` cells a part."""
        out = Sketches(each)
        wide = self.each[rows]
        sizes = wide * PARTS
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        part, spot = np.divmod(place, np.repeat(wide, sizes))
        narrow = np.repeat(out.each, sizes)
        source = np.repeat(self.start[rows], sizes) + place
        target = np.repeat(out.start[:-1], sizes) + part * narrow + spot % narrow
        for mine, theirs in ((out.count, self.count), (out.keys, self.keys), (out.checks, self.checks)):
            np.add.at(mine, target, theirs[source])
        return out

    def subtract(self, other: "Sketches") -> None:
        self.count -= other.count
        self.keys -= other.keys
        self.checks -= other.checks

    def rows(self, cell: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, cell, "right") - 1

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, digest and side (1: first table, -1: second) of what is recovered; rows with a rest."""
        found: list[tuple] = []
        while True:
            lone = np.flatnonzero(np.abs(self.count) == 1)
            sign = self.count[lone]
            key = self.keys[lone] * sign.astype(np.uint64)
            sure = mixed(key, 0) * sign.astype(np.uint64) == self.checks[lone]
            row, key, sign = self.rows(lone[sure]), key[sure], sign[sure]
            if not len(row):
                break
            # a digest may be alone in several cells at once
            order = np.lexsort((key, row))
            row, key, sign = row[order], key[order], sign[order]
            first = np.r_[True, (row[1:] != row[:-1]) | (key[1:] != key[:-1])]
            row, key, sign = row[first], key[first], sign[first]
            self.add(row, key, -sign)
            found.append((row, key, sign))
        rest = self.rows(np.flatnonzero((self.count != 0) | (self.keys != 0) | (self.checks != 0)))
        row, key, sign = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        return row, key, sign, np.unique(rest)

    def recovered(self) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Peels: for each table the digests of the first and of the second text, None if some are left over."""
        row, key, sign, rest = self.peel()
        order = np.argsort(row, kind="stable")
        row, key, sign = row[order], key[order], sign[order]
        ends = np.searchsorted(row, np.arange(len(self.each) + 1))
        out: list = []
        for lo, hi in zip(ends[:-1], ends[1:]):
            k, s = key[lo:hi], sign[lo:hi]
            out.append((k[s == 1], k[s == -1]))
        for i in rest:
            out[i] = None
        return out

    def texts(self, sizes: list[int]) -> list[str]:
        """The tables as text, with the number of digests in front."""
        packed = np.zeros(len(self.count), CELL)
        packed["n"], packed["key"], packed["check"] = self.count, self.keys, self.checks
        return [f"{n}:{base64.b64encode(packed[lo:hi].tobytes()).decode()}"
                for n, lo, hi in zip(sizes, self.start[:-1], self.start[1:])]

    @classmethod
    def read(cls, texts: list[str]) -> tuple["Sketches", list[int]]:
        """Tables and numbers of digests back from their text."""
        split = [t.split(":", 1) for t in texts]
        cells = [np.frombuffer(base64.b64decode(body), CELL) for _, body in split]
        tables = cls(np.array([len(c) // PARTS for c in cells], np.int64))
        if cells:
            packed = np.concatenate(cells)
            tables.count, tables.keys, tables.checks = (packed[f].astype(t) for f, t in (
                ("n", np.int64), ("key", np.uint64), ("check", np.uint64)))
        return tables, [int(n) for n, _ in split]


def between(a: Sketches, i: np.ndarray, b: Sketches, j: np.ndarray) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """Tables ``i`` of a minus tables ``j`` of b, the larger of two folded to the smaller, peeled."""
    each = np.minimum(a.each[i], b.each[j])
    first = a.folded(i, each)
    first.subtract(b.folded(j, each))
    return first.recovered()


def differing(a: list[np.ndarray], b: list[np.ndarray],
              tables: tuple[Sketches, Sketches] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pair of digest lists, the digests only in one and only in the other.

    The fingerprints of the lists (``tables``, a table for each list) are subtracted first. Pairs whose tables can't
    be peeled try again with twice the cells; the others are done.
    """
    first, second = tables or (fingerprints(a), fingerprints(b))
    every = np.arange(len(a))
    out = between(first, every, second, every)
    each = np.minimum(first.each, second.each)
    while len(left := np.array([i for i in every if out[i] is None], np.int64)):
        each[left] *= 2
        again = Sketches.of([a[i] for i in left], each[left])
        again.subtract(Sketches.of([b[i] for i in left], each[left]))
        for i, found in zip(left, again.recovered()):
            out[i] = found
    return out


def shared_part(count: int, only_x: np.ndarray, only_y: np.ndarray) -> float:
    """Shared digests over all digests of a pair whose first text has ``count``."""
    total = count + len(only_y)
    return (count - len(only_x)) / total if total else 1.0


def likeness(a: list[np.ndarray], b: list[np.ndarray], tables: tuple[Sketches, Sketches] | None = None) -> list[float]:
    """Shared digests over all digests of each pair."""
    return [shared_part(len(x), *found) for x, found in zip(a, differing(a, b, tables))]


def fingerprints(lists: list[np.ndarray]) -> Sketches:
    """A table for each digest list, sized by the number of its digests."""
    return Sketches.of(lists, part_cells(np.array([len(x) for x in lists], np.int64)))


@F.pandas_udf(DIFFERENCE)
def stored_difference(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """What two stored fingerprints tell without their texts: digests only in one, only in the other, likeness.

    All three are null if a fingerprint is null or the texts differ in more digests than the smaller table recovers;
    then larger tables have to be made from the texts (``differing``).
    """
    out: list[tuple] = [(None, None, None)] * len(a)
    known = np.flatnonzero(a.notna() & b.notna())
    (x, counts), (y, _) = Sketches.read(list(a.iloc[known])), Sketches.read(list(b.iloc[known]))
    every = np.arange(len(known))
    for at, n, found in zip(known, counts, between(x, every, y, every)):
        if found is not None:
            out[at] = (found[0].view(np.int64), found[1].view(np.int64), shared_part(n, *found))
    return pd.DataFrame(out, columns=["first", "second", "likeness"])


def edit(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the following text's first, or all."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def beside_next(docs: DataFrame) -> DataFrame:
    """Rows in stretches of descending doc_id, each with the row after it as its ``ahead`` row.

    doc_id is cut at quantiles into as many stretches as there are shuffle partitions. Only the first
    id of each stretch reaches the driver. A stretch ends with a copy of the next one's first row, the
    last with a copy of the very first. Adds ``__part`` and ``__ahead``; each stretch has a partition of its
    own, where hashing would put several in one. Only rows without an id may share one with the first stretch.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    quantiles = docs.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.2 / parts) if parts > 1 else []
    splits = [-math.inf, *(sorted(set(quantiles)) or [0.0]), math.inf]
    cut = Bucketizer(splits=splits, inputCol="__id", outputCol="__cut", handleInvalid="keep")
    # stretch 1 has the largest ids; null ids come after all others
    last = len(splits)
    placed = (cut.transform(docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0))))
              .withColumn("__part", F.when(F.col("doc_id").isNull(), last).otherwise(last - 1 - F.col("__cut").cast("int")))
              .drop("__id", "__cut"))
    # a row for each stretch: ordered here, as a sort in Spark takes two more rounds of tasks
    heads = sorted(placed.groupBy("__part").agg(F.max("doc_id").alias("first")).collect(), key=lambda head: head["__part"])
    firsts: list = [None] * last
    before: list = [None] * last
    for i, head in enumerate(heads):
        firsts[head["__part"] - 1] = head["first"]
        before[head["__part"] - 1] = heads[i - 1]["__part"]  # the first follows the last
    at = lambda values, kind: F.element_at(F.lit(values).cast(f"array<{kind}>"), F.col("__part"))
    ahead = F.when(F.col("doc_id").eqNullSafe(at(firsts, "bigint")), at(before, "int"))
    spots = F.array(F.struct(F.col("__part").alias("p"), F.lit(0).alias("a")),
                    F.struct(ahead.alias("p"), F.lit(1).alias("a")))
    spread = placed.withColumn("__spot", F.explode(F.filter(spots, lambda s: s["p"].isNotNull())))
    spread = spread.withColumn("__part", F.col("__spot.p")).withColumn("__ahead", F.col("__spot.a")).drop("__spot")
    return spread.repartitionById(parts, "__part").sortWithinPartitions(
        "__part", "__ahead", F.desc_nulls_last("doc_id"), "text")


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def compared(rows: list[tuple[int, str, str]]) -> pa.RecordBatch:
    """doc_id, text and following text to result rows."""
    own = [digests(text) for _, text, _ in rows]
    edits = [edit(text, following) for _, text, following in rows]
    edited = [digests(x) for x in edits]
    # the following text is the next row's, but at the end of a batch or a stretch
    new = [i for i in range(len(rows)) if i + 1 == len(rows) or rows[i][2] is not rows[i + 1][1]]
    listed = own + [digests(rows[i][2]) for i in new]
    after = np.arange(1, len(rows) + 1)
    after[new] = np.arange(len(rows), len(listed))
    tables, edited_tables = fingerprints(listed), fingerprints(edited)
    own_tables = tables.folded(np.arange(len(rows)), tables.each[:len(rows)])
    following_tables = tables.folded(after, tables.each[after])
    columns = [[r[0] for r in rows], [len(r[1]) for r in rows],
               [hashlib.sha256(x.encode()).hexdigest() for x in edits], own_tables.texts([len(x) for x in own]),
               edited_tables.texts([len(x) for x in edited]), likeness(own, edited, (own_tables, edited_tables)),
               likeness(own, [listed[i] for i in after], (own_tables, following_tables))]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA)], schema=SCHEMA)


def edited_and_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likenesses."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row of its stretch so far: the row after it is still to come
        for batch in slices(batches, "text", COMPARED_BYTES):
            ready = []
            for doc_id, text, part, ahead in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "part", "ahead"))):
                if held and held[2] == part:
                    ready.append((held[0], held[1], text))
                # of rows ahead only the first is the next row
                held = None if ahead else (doc_id, text, part)
            if ready:
                yield compared(ready)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return (beside_next(rows).select("doc_id", "text", F.col("__part").alias("part"), F.col("__ahead").alias("ahead"))
            .mapInArrow(compare, ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'double' if f.type == pa.float64() else 'string'}" for f in SCHEMA)))
