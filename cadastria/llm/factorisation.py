"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text is a sparse vector: its words hashed into ``BUCKETS`` (log counts, scaled to length one), a few
statistics of its structure, and its length as metadata. The score is the logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2],

which takes time linear in the number of features. Weights are learned by AdaGrad on at most
``SAMPLE`` labelled rows outside the held-out fold, those with the smallest hash of their id; every row
is scored. The sample's sparse vectors, not its texts, reach the driver, which fits the model; it goes
to all tasks as one broadcast of fixed size.

Null and empty texts have the empty vector and a score too. Labels that are null don't count; without
any usable label every score is 1/2. Repeated rows get equal scores. Other columns of the input are
neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastria.llm.common import slices
from cadastria.llm.hashing import IS_WHITE, utf8, word_hashes

BUCKETS = 1 << 16
#: Statistics of structure and metadata, which have features of their own behind the buckets.
STATISTICS = ["length", "word_length", "white", "digits", "upper", "symbols", "marks", "lines", "new_words", "repeats", "other"]
FEATURES = BUCKETS + len(STATISTICS)
FACTORS = 8
SAMPLE = 8_000
EPOCHS = 8
FOLDS = 5
THRESHOLD = 0.3

#: Characters that count as symbols and as sentence marks.
SYMBOLS, MARKS = b"#*$%&|<>{}[]=_~^\\/@+", b"!?.,;:"
CLASS = np.zeros((256, 5), np.uint8)
CLASS[:, 0] = IS_WHITE
CLASS[48:58, 1] = 1
CLASS[65:91, 2] = 1
CLASS[list(SYMBOLS), 3] = 1
CLASS[list(MARKS), 4] = 1


@dataclass
class Vectors:
    """Sparse rows: the entries of row i are those from first[i] to first[i + 1]."""

    index: np.ndarray
    value: np.ndarray
    first: np.ndarray

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def vectors(column: pa.Array) -> Vectors:
    """The features of every text of a column without nulls."""
    data, offsets = utf8(column)
    words, first = word_hashes(column)
    n, n_words = np.diff(offsets), np.diff(first)
    doc = np.repeat(np.arange(len(n)), n_words)
    # distinct words of each text with their counts
    order = np.lexsort((words, doc))
    ordered, owner = words[order], doc[order]
    new = np.flatnonzero(np.r_[len(ordered) > 0, (ordered[1:] != ordered[:-1]) | (owner[1:] != owner[:-1])][:len(ordered)])
    times = np.diff(np.r_[new, len(ordered)])
    index, row = (ordered[new] >> np.uint64(64 - 16)).astype(np.int64) % BUCKETS, owner[new]
    value = np.log1p(times)
    norm = np.sqrt(np.bincount(row, value ** 2, minlength=len(n)))
    value = value / norm[row]

    def share(sums: np.ndarray, total: np.ndarray) -> np.ndarray:
        return sums / np.maximum(total, 1)

    counts = np.stack([np.r_[0, np.cumsum(CLASS[data, k], dtype=np.int64)] for k in range(5)], axis=1)
    counts = counts[offsets[1:]] - counts[offsets[:-1]]
    line_ends = np.r_[0, np.cumsum(data == 10)]
    lines = 1 + line_ends[offsets[1:]] - line_ends[offsets[:-1]]
    repeats = np.zeros(len(words), bool)
    repeats[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    distinct = np.bincount(row, minlength=len(n))
    high = np.r_[0, np.cumsum(data > 127)]
    statistics = np.stack([
        np.log1p(n) / 10, share(n - counts[:, 0], n_words) / 10, share(counts[:, 0], n), share(counts[:, 1], n) * 5,
        share(counts[:, 2], n) * 5, share(counts[:, 3], n_words), share(counts[:, 4], n_words), share(lines, n_words) * 10,
        share(distinct, n_words), share(np.bincount(doc, repeats, minlength=len(n)), n_words),
        share(high[offsets[1:]] - high[offsets[:-1]], n)], axis=1)
    statistics = np.minimum(statistics, 3.0)
    # the statistics follow the words of their text
    k = len(STATISTICS)
    index = np.concatenate([index, np.tile(BUCKETS + np.arange(k), len(n))])
    value = np.concatenate([value, statistics.ravel()])
    row = np.concatenate([row, np.repeat(np.arange(len(n)), k)])
    order = np.argsort(row, kind="stable")
    return Vectors(index[order], value[order].astype(np.float32), np.searchsorted(row[order], np.arange(len(n) + 1)))


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, x: Vectors) -> np.ndarray:
        row, n = x.rows(), len(x.first) - 1
        linear = np.bincount(row, self.weights[x.index] * x.value, minlength=n)
        pairs = np.zeros(n)
        for f in range(self.factors.shape[1]):
            part = self.factors[x.index, f] * x.value
            pairs += np.bincount(row, part, minlength=n) ** 2 - np.bincount(row, part ** 2, minlength=n)
        return self.bias + linear + pairs / 2

    def scores(self, x: Vectors) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def learned(x: Vectors, labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.1, ridge: float = 1e-5, batch: int = 64) -> Machine:
    """Weights by AdaGrad on the logistic loss, classes weighted alike."""
    random = np.random.default_rng(7)
    machine = Machine(0.0, np.zeros(FEATURES), random.normal(0, 0.01, (FEATURES, FACTORS)))
    positive = labels.mean() if len(labels) else 0.5
    if not 0 < positive < 1:
        return machine
    weight = np.where(labels == 1, 0.5 / positive, 0.5 / (1 - positive))
    squares, factor_squares, bias_square = np.full(FEATURES, 1e-2), np.full((FEATURES, FACTORS), 1e-2), 1e-2
    for _ in range(epochs):
        order = random.permutation(len(labels))
        for at in range(0, len(order), batch):
            chosen = order[at:at + batch]
            lengths = x.first[chosen + 1] - x.first[chosen]
            row = np.repeat(np.arange(len(chosen)), lengths)
            entry = np.repeat(x.first[chosen] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
            index, value = x.index[entry], x.value[entry].astype(float)
            sums = np.zeros((len(chosen), FACTORS))
            part = machine.factors[index] * value[:, None]
            np.add.at(sums, row, part)
            squared = np.zeros((len(chosen), FACTORS))
            np.add.at(squared, row, part ** 2)
            margin = machine.bias + np.bincount(row, machine.weights[index] * value, minlength=len(chosen)) + (sums ** 2 - squared).sum(axis=1) / 2
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[chosen]) * weight[chosen] / len(chosen)
            touched, place = np.unique(index, return_inverse=True)
            step = np.bincount(place, slope[row] * value, minlength=len(touched)) + ridge * machine.weights[touched]
            squares[touched] += step ** 2
            machine.weights[touched] -= rate * step / np.sqrt(squares[touched])
            step = np.zeros((len(touched), FACTORS))
            np.add.at(step, place, (slope[row] * value)[:, None] * (sums[row] - part))
            step += ridge * machine.factors[touched]
            factor_squares[touched] += step ** 2
            machine.factors[touched] -= rate * step / np.sqrt(factor_squares[touched])
            step = slope.sum()
            bias_square += step ** 2
            machine.bias -= rate * step / np.sqrt(bias_square)
    return machine


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """A machine for ``labels.quality`` from at most ``sample`` labelled rows that aren't held out."""
    chosen = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
              .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .filter(~held_out(F.col("doc_id"))).dropDuplicates(["doc_id"])
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # at most ``sample`` ids: a bounded broadcast
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = vectors(batch.column("text"))
            split = lambda v, t: [v[a:b].astype(t).tobytes() for a, b in zip(x.first[:-1], x.first[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(split(x.index, "<i4"), pa.binary()),
                                              pa.array(split(x.value, "<f4"), pa.binary())], ["doc_id", "quality", "index", "value"])

    got = rows.mapInArrow(read, "doc_id long, quality int, index binary, value binary").collect()
    # the order of rows, and with it the model, doesn't depend on how the table is split
    got = sorted(got, key=lambda r: (r["doc_id"], r["index"], r["value"]))
    index = [np.frombuffer(r["index"], "<i4") for r in got]
    x = Vectors(np.concatenate([np.zeros(0, np.int64), *index]).astype(np.int64),
                np.concatenate([np.zeros(0, np.float32), *[np.frombuffer(r["value"], "<f4") for r in got]]),
                np.r_[0, np.cumsum([len(i) for i in index])].astype(np.int64))
    return learned(x, np.array([r["quality"] for r in got], float))


def scored(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sent.value.scores(vectors(batch.column("text"))))],
                                             ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(score, "doc_id long, score double").select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
