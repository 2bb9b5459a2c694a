"""Prefix trie of conversations: member intervals of a sorted array, found by range minima over shared depths.

A conversation is the sequence of its turns; a turn is 16 bytes of a SHA-256 digest of role and text, and 4 bytes that
hold the text's code points. Equal sequences are gathered before anything else: a task joins those of its stretch of
ids, so a group of copies of any size travels as few rows. The distinct sequences are then sorted by range over all
partitions.

In a chunk of the sorted array a sparse table answers the least shared depth of neighbours over any stretch. A candidate
prefix is a sequence and a depth; its left and its right extent are each found by a binary search of their own, no
candidate waits for another one and none is kept on a stack. The candidate that is the left end of its interval stands
for the node. Counts, smallest ids, children, leaves and sums over the subtree follow from the interval by differences of prefix
sums and by range minima.

Nodes that reach over the edge of a chunk are known by the depth that its neighbours share with it. Each chunk counts its own part
and takes off what the chunk before counts too, so parts of a node are simply added up. There are at most two paths of them a chunk.

Turns are ordered by ``turn`` (nulls first), ties by the digest. Null roles and texts are empty. Rows without a conv_id belong to no
conversation and are left out; repeated rows are repeated turns. No conversation gives no node. Texts are read for their digests
only, whatever their length. Other columns are left out. The digests of one conversation, 20 bytes a turn, are one row; the first and
the last sequence of every partition are seen by the driver.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastria.llm.common import written
from cadastria.llm.hashing import utf8
from cadastria.session import checkpointed

DIGEST, ITEM = 16, 20
#: Bytes of sequences, and sequences, that a task holds at once.
CHUNK_BYTES, CHUNK_ROWS = 4 << 20, 1 << 16
#: No neighbour: not even the root is shared.
ALONE = -1


def turns(conversations: DataFrame, stride: int) -> DataFrame:
    """conv_id, its block of ``stride`` ids and the bytes of every turn, in order within the partitions of blocks."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.encode(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), "UTF-8"), 256))
    size = F.unhex(F.lpad(F.hex(F.char_length(text)), 2 * (ITEM - DIGEST), "0"))
    conv_id = F.col("conv_id").cast("long")
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        conv_id.alias("conv_id"), (conv_id - F.pmod(conv_id, F.lit(stride))).alias("block"), "turn",
        F.concat(F.substring(digest, 1, DIGEST), size).alias("item"))
    return (rows.repartitionByRange("block").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "item")
            .select("conv_id", "block", "item"))


class Copies:
    """Sequences with the ids that have them, as rows of a batch."""

    def __init__(self) -> None:
        self.ids: dict[bytes, list[int]] = {}
        self.rows = self.size = 0

    def add(self, conv_id: int, key: bytes) -> None:
        if key not in self.ids:
            self.ids[key] = []
            self.size += len(key)
        self.ids[key].append(conv_id)
        self.rows += 1

    def full(self) -> bool:
        return self.rows >= CHUNK_ROWS or self.size >= CHUNK_BYTES

    def batch(self) -> pa.RecordBatch:
        ids = list(self.ids.values())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(self.ids), pa.binary()), pa.array([i[0] for i in ids], pa.int64()), pa.array([len(i) for i in ids], pa.int64()),
             pa.array([",".join(map(str, i)) for i in ids], pa.string())], ["key", "first_id", "n", "ids"])


def rebuilt(conversations: DataFrame, stride: int = 100, most: int = 5) -> DataFrame:
    """Distinct sequences of a stretch of ids (key), the smallest id (first_id), how many there are (n) and all, ascending (ids).

    The first h turns of a conversation are those of the first one of its block of ``stride`` ids, h = crc32(id) modulo ``most`` + 1. With
    ``most`` = 0 all stay as they are.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Copies()
        current, block, own, head, head_block = None, None, [], b"", None

        def close() -> None:
            nonlocal head, head_block
            key = b"".join(own)
            if current == block:
                head, head_block = key[:most * ITEM], block
            h = zlib.crc32(str(current).encode()) % (most + 1) * ITEM
            out.add(current, (head if head_block == block else b"")[:h] + key[h:])

        for batch in batches:
            if not len(batch):
                continue
            ids = batch.column("conv_id").to_numpy()
            data = utf8(batch.column("item"))[0].tobytes()
            starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
                if ids[a] != current:
                    if current is not None:
                        close()
                        if out.full():
                            yield out.batch()
                            out = Copies()
                    current, block, own = int(ids[a]), batch.column("block")[a].as_py(), []
                own.append(data[a * ITEM:b * ITEM])
        if current is not None:
            close()
            yield out.batch()

    return turns(conversations, stride).mapInArrow(read, "key binary, first_id long, n long, ids string")


def items(key: bytes) -> np.ndarray:
    return np.frombuffer(key, np.uint8).reshape(-1, ITEM)


def shared_depth(a: bytes, b: bytes) -> int:
    """How many turns two sequences begin with together."""
    n = min(len(a), len(b))
    different = (items(a[:n]) != items(b[:n])).any(axis=1)
    return int(different.argmax()) if different.any() else n // ITEM


class RangeMinimum:
    """Sparse table: the least value of any stretch from two overlapping ones of a power of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        span = 1
        while 2 * span <= len(values):
            last = self.levels[-1]
            self.levels.append(np.r_[np.minimum(last[:-span], last[span:]), last[len(last) - span:]])
            span *= 2
        self.levels = np.stack(self.levels)

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minima over ``low`` to ``high``, both included."""
        level = np.frexp((high - low + 1).astype(float))[1] - 1
        return np.minimum(self.levels[level, low], self.levels[level, high - (1 << level) + 1])


def extents(shared: RangeMinimum, row: np.ndarray, depth: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the neighbours that share ``depth`` turns with ``row``, each by its own binary search."""
    low, high = np.zeros_like(row), row.copy()
    while (low < high).any():
        middle = (low + high) // 2
        good = shared(np.minimum(middle + 1, row), row) >= depth
        good |= middle == row
        low, high = np.where(good, low, middle + 1), np.where(good, middle, high)
    left = low
    low, high = row.copy(), np.full_like(row, n - 1)
    while (low < high).any():
        middle = (low + high + 1) // 2
        good = shared(np.minimum(row + 1, middle), middle) >= depth
        good |= middle == row
        low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
    return left, low


NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string, node string, parent string")


def path_ids(key: bytes, depth: int) -> list[str]:
    """Names of the nodes on the path of a sequence, down to ``depth``."""
    digest, out = hashlib.sha256(), []
    for d in range(depth + 1):
        digest.update(key[(d - 1) * ITEM:d * ITEM] if d else b"")
        out.append(digest.copy().hexdigest()[:32])
    return out


def chunk_nodes(keys: list[bytes], first_id: np.ndarray, n: np.ndarray, ends: list[str], before: int, continues: bool, after: int) -> pa.RecordBatch:
    """The nodes of a chunk of sorted distinct sequences.

    ``before`` and ``after`` are the depths shared with the neighbours of the chunk; ``continues`` tells that the first sequence goes on where the
    one before ends.
    """
    size = len(keys)
    length = np.array([len(k) // ITEM for k in keys])
    start = np.cumsum(length) - length
    data = items(b"".join(keys))
    chars = np.ascontiguousarray(data[:, DIGEST:]).view(">u4").ravel().astype(np.int64)
    total = np.r_[0, np.cumsum(chars)]

    # shared depth with the sequence before, from the first turn that differs
    least = np.r_[0, np.minimum(length[1:], length[:-1])]
    row = np.repeat(np.arange(size), least)
    turn = np.arange(len(row)) - np.repeat(np.cumsum(least) - least, least)
    same = (data[start[row] + turn] == data[start[row - 1] + turn]).all(axis=1)
    depth_shared = least.copy()
    np.minimum.at(depth_shared, row[~same], turn[~same])
    depth_shared[0] = ALONE

    # every sequence and each of its depths is a candidate
    row = np.repeat(np.arange(size), length + 1)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(length + 1) - length - 1, length + 1)
    left, right = extents(RangeMinimum(depth_shared), row, depth, size)
    node_of = np.flatnonzero(left == row)
    left, right, depth = left[node_of], right[node_of], depth[node_of]

    def over(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        sums = np.r_[0, np.cumsum(values)]
        return sums[high + 1] - sums[low]

    above = total[start[left] + np.maximum(depth - 1, 0)] - total[start[left]]
    sums = total[start + length] - total[start]
    n_convs = over(n, left, right)
    # code points of all members from this depth on, less those of each node once
    of_members = over(n * sums, left, right) - n_convs * above
    fresh = sums - (total[start + np.maximum(depth_shared, 0)] - total[start])
    once = sums[left] - above + over(fresh, left, right) - fresh[left]
    saved = of_members - once

    order = np.sort(depth_shared * (size + 1) + np.arange(size))
    splits = np.searchsorted(order, depth * (size + 1) + right, side="right") - np.searchsorted(order, depth * (size + 1) + left, side="right")
    here = length[left] == depth
    children = splits + 1 - here
    leaf = np.r_[depth_shared[1:] < length[:-1], True]
    leaves = over(leaf, left, right)
    smallest = RangeMinimum(first_id)(left, right)

    # what the chunk before counts too
    shared = (left == 0) & (depth <= before)
    saved += np.where(shared, total[max(before, 0)] - above, 0)
    children -= shared & (depth < before)
    leaves = leaves - (shared & continues)

    # the parent is the node one turn up that holds the same sequence: its place among the candidates of its left end
    up = np.maximum(depth - 1, 0)
    parent_left, parent_right = extents(RangeMinimum(depth_shared), left, up, size)
    parent = RangeMinimum(first_id)(parent_left, parent_right)
    open_ = shared | ((right == size - 1) & (depth <= after))
    parent_open = (depth > 0) & (((parent_left == 0) & (up <= before)) | ((parent_right == size - 1) & (up <= after)))

    firsts, lasts = path_ids(keys[0], before), path_ids(keys[-1], after)

    def name(of_first: bool, d: int) -> str:
        return firsts[d] if of_first and d < len(firsts) else lasts[d]

    names = [None] * len(depth)
    parents = [None] * len(depth)
    for i in np.flatnonzero(open_).tolist():
        names[i] = name(left[i] == 0, depth[i])
    for i in np.flatnonzero(parent_open).tolist():
        parents[i] = name(parent_left[i] == 0, up[i])
    known = np.array(ends, object)[left]
    known[~here] = None
    columns = [smallest, depth, pa.array(parent, pa.int64(), mask=parent_open | (depth == 0)), n_convs, children, leaves, saved,
               pa.array(known, pa.string()), pa.array(names, pa.string()), pa.array(parents, pa.string())]
    fields = [f.split() for f in NODES.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], [f[0] for f in fields])


def edges(ordered: DataFrame) -> dict[int, tuple[int, bool, int]]:
    """By partition, what ``chunk_nodes`` has to know of the neighbours of its first and its last sequence."""
    rows = ordered.groupBy(F.spark_partition_id().alias("part")).agg(F.min("key").alias("low"), F.max("key").alias("high")).collect()
    rows = sorted(rows, key=lambda r: r["part"])
    out, before, continues = {}, ALONE, False
    for row, following in zip(rows, [*rows[1:], None]):
        after = shared_depth(bytes(row["high"]), bytes(following["low"])) if following else ALONE
        out[row["part"]] = (before, continues, after)
        before, continues = after, after * ITEM == len(row["high"])
    return out


def nodes(copies: DataFrame) -> DataFrame:
    """The trie's nodes, from what ``rebuilt`` returns."""
    ordered = checkpointed(copies.repartitionByRange("key").sortWithinPartitions("key", "first_id"))
    at_edges = edges(ordered)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, continues, last = at_edges.get(TaskContext.get().partitionId(), (ALONE, False, ALONE))
        keys, ids, counts, ends, size = [], [], [], [], 0
        for batch in batches:
            for key, first_id, n, text in zip(*(batch.column(c).to_pylist() for c in ("key", "first_id", "n", "ids"))):
                if keys and key == keys[-1]:
                    ids[-1], counts[-1] = min(ids[-1], first_id), counts[-1] + n
                    ends[-1].update(b"," + text.encode())
                    continue
                if size >= CHUNK_BYTES or len(keys) >= CHUNK_ROWS:
                    after = shared_depth(keys[-1], key)
                    yield chunk_nodes(keys, np.array(ids), np.array(counts), [e.hexdigest() for e in ends], before, continues, after)
                    before, continues = after, after * ITEM == len(keys[-1])
                    keys, ids, counts, ends, size = [], [], [], [], 0
                keys.append(key)
                ids.append(first_id)
                counts.append(n)
                ends.append(hashlib.sha256(text.encode()))
                size += len(key) + ITEM
        if keys:
            yield chunk_nodes(keys, np.array(ids), np.array(counts), [e.hexdigest() for e in ends], before, continues, last)

    walked = written(ordered.mapInArrow(walk, NODES), "trie")
    parts = walked.filter(F.col("node").isNotNull()).groupBy("node", "depth", "parent").agg(
        F.min("conv_id").alias("conv_id"), F.lit(None).cast("long").alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("ends_sha256").alias("ends_sha256"))
    joined = written(parts, "trie-edges")
    every = walked.filter(F.col("node").isNull()).unionByName(joined)
    over = joined.select(F.col("node").alias("parent"), F.col("conv_id").alias("over"))
    return every.join(over, "parent", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "over").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
