"""Removal of long repeated byte strings with a logarithmic family of suffix arrays.

Every ``LENGTH``-byte string of a text has an anchor: the place, among those where ``HEAD`` bytes of it
begin, whose head hashes smallest (the first such). Equal strings have their anchors at the same
offset with equal heads. The starts that share an anchor are neighbours; the bytes they cover are the
anchor's region, and there is about one region in fifty bytes.

Regions that repeat within a batch of texts are settled there, and one of them goes on for all, so what is common is
thinned out before the shuffle. The others are dealt by head and sorted by head and region, and read head by head:

* A region that some other place has too repeats as a whole: all its bytes go.
* A region whose head is nowhere else holds no repeated string.
* The rest share a head but not the region. Their bytes are fetched for the index family.

To the family the regions come sorted by head. Each incoming batch gets a suffix array: the starts of all its
``LENGTH``-byte strings in the order of their bytes. It is merge-scanned against the arrays of all levels; neighbours that match in
all ``LENGTH`` bytes repeat. Then it becomes a level, and levels of like size merge, so there are logarithmically many and each
suffix is merged logarithmically often. A level lives as long as the head it belongs to may go on; what is finished is released, so
memory is bounded by a batch and one head's regions.

A head that very many places share, as at the edges of a passage between differing neighbours, is no single task's work: a
sample finds such heads, their regions are dealt by region, and those left are cut into strings, thinned out by batch and dealt by
string. Which heads are taken for such (``SAMPLED``, ``HOT``), the size of batches (``STRETCH``, ``CUT_BYTES``, ``RUN_ROWS``, ``ARRAY_BYTES``) and
of levels change cost and places of work, never what is found.

Strings in the family are compared by their bytes. Equal regions are told by two hashes, of head and of region, 126 bits for two that differ in
their heads; strings with hot heads by three. Texts are told by 128 bits of SHA-256. Texts that occur more than once go as a whole if they
are long enough; a task indexes such a text once. Texts of any length are indexed in overlapping stretches.

Null texts are empty. Shorter texts have nothing removed. Repeated rows are texts that occur more than
once. An empty table gives no rows. Other columns of the input are left out.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastria.llm.common import slices, written
from cadastria.llm.hashing import mix, prefix_hashes, quick_hashes, span_hashes, utf8

LENGTH = 200
HEAD = 100
#: Bytes that name a text.
ID = 16
#: Starts of a text that are indexed at once.
STRETCH = 1 << 20
#: A head is hot if so many of its suffixes are in a sample of one in ``SAMPLED``.
SAMPLED, HOT = 64, 16
#: Bytes of regions with hot heads that are cut into strings at once.
CUT_BYTES = 1 << 18
#: Sorted rows that are judged at once, besides the run they end in.
RUN_ROWS = 1 << 15
#: Bytes of regions that get a suffix array at once.
ARRAY_BYTES = 1 << 18
#: A suffix whose region is known to repeat, one with a shared head, what it is compared with; one to
#: be judged, and one to be judged for others only, as its region repeats within its batch.
SETTLED, OPEN, PARTNER, FRESH, KNOWN = range(5)


class IndexFamily:
    """Suffix arrays at geometric levels; tells which strings occur twice or more.

    Strings come in batches that are sorted by ``group``: equal strings are of one group. A level keeps strings of the last group only,
    since an earlier one does not come again.
    """

    def __init__(self) -> None:
        self.group = None
        #: by level: distinct strings in order, the place of each, and whether it is known to repeat
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, strings: np.ndarray, groups: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Places of strings, of this batch and of earlier ones, that are now first known to repeat."""
        if not len(strings):
            return places
        if groups[0] != self.group:
            self.levels = []
        self.group = groups[-1]
        order = np.argsort(strings, kind="stable")
        array, groups, places = strings[order], groups[order], places[order]
        same = array[1:] == array[:-1]
        again = np.r_[False, same] | np.r_[same, False]
        hits = []
        for level, known, seen in self.levels:
            at = np.minimum(np.searchsorted(level, array), len(level) - 1)
            met = level[at] == array
            again |= met
            fresh = np.unique(at[met])
            fresh = fresh[~seen[fresh]]
            hits.append(known[fresh])
            seen[fresh] = True
        hits.append(places[again])
        keep = np.r_[True, ~same] & (groups == self.group)
        if keep.any():
            self.levels.append((array[keep], places[keep], again[keep]))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            (a, *x), (b, *y) = self.levels.pop(), self.levels.pop()
            joined = np.concatenate([b, a])
            order = np.argsort(joined, kind="stable")
            one = order[np.r_[True, joined[order][1:] != joined[order][:-1]]]
            # of a string that two levels have both rows are known to repeat
            self.levels.append((joined[one], *(np.concatenate([v, u])[one] for u, v in zip(x, y))))
        return np.concatenate(hits)


def anchored(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Head hash, region hash, first start and end of the last string, of every anchor of a stretch."""
    heads = quick_hashes(data, HEAD)
    at = np.arange(len(heads))
    # the smallest hash, and its place in the lower half; the first of equal ones
    least = (heads & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    width, span = LENGTH - HEAD + 1, 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cuts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1], True])
    first, end = cuts[:-1], cuts[1:] - 1 + LENGTH
    place = anchor[first]
    region = mix(span_hashes(prefix_hashes(data), first, end) + (place - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return heads[place], region, first, end


def text_id(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)), 1, ID)


def with_ids(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_id(text).alias("text_id"), text.alias("text"))


def first_in_task(batch: pa.RecordBatch, met: set[bytes]) -> list[tuple[bytes, bytes]]:
    """Ids and bytes of the texts of a batch that are long enough and new to the task."""
    out = []
    for text_id, text in zip(batch.column("text_id").to_pylist(), batch.column("text").to_pylist()):
        data = text.encode()
        if len(data) >= LENGTH and text_id not in met:
            met.add(text_id)
            out.append((text_id, data))
    return out


def batch_of(schema: str, columns: list) -> pa.RecordBatch:
    """A batch from arrays in the order of ``schema``; rows of ``ID`` bytes are ids."""
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]

    def array(column, kind: str) -> pa.Array:
        if isinstance(column, pa.Array):
            return column
        if isinstance(column, np.ndarray) and column.ndim == 2:
            ids = pa.FixedSizeBinaryArray.from_buffers(pa.binary(ID), len(column), [None, pa.py_buffer(np.ascontiguousarray(column))])
            return ids.cast(pa.binary())
        if isinstance(column, np.ndarray) and column.dtype == np.uint64:
            column = column.view(np.int64)
        return pa.array(column, types[kind])

    return pa.RecordBatch.from_arrays([array(c, kind) for c, (_, kind) in zip(columns, fields)], [name for name, _ in fields])


def ids_of(column: pa.Array) -> np.ndarray:
    """Ids as rows of two numbers."""
    return utf8(column)[0].copy().view(np.uint64).reshape(-1, 2)


SUFFIX = "kind int, head long, region long, text_id binary, first int, end int"


def suffixes(rows: DataFrame) -> DataFrame:
    """The anchored suffixes of all texts, thinned out by batch."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in slices(batches, "text"):
            parts = []
            new = first_in_task(batch, met)
            for i, (_, text) in enumerate(new):
                data = np.frombuffer(text, np.uint8)
                for low in range(0, len(data) - LENGTH + 1, STRETCH):
                    head, region, first, end = anchored(data[low:low + STRETCH + LENGTH - 1])
                    parts.append((head, region, np.full(len(head), i), first + low, end + low))
            if parts:
                head, region, text, first, end = map(np.concatenate, zip(*parts))
                _, one, which, times = np.unique(region, return_index=True, return_inverse=True, return_counts=True)
                again = np.flatnonzero(times[which] > 1)
                chosen = np.concatenate([one, again])
                kind = np.concatenate([np.where(times > 1, KNOWN, FRESH), np.full(len(again), SETTLED)])
                ids = np.frombuffer(b"".join(i for i, _ in new), np.uint64).reshape(-1, 2)
                yield batch_of(SUFFIX, [kind, head[chosen], region[chosen], ids[text[chosen]], first[chosen], end[chosen]])

    return written(rows.select("text_id", "text").mapInArrow(read, SUFFIX), "suffixes")


def starts_of_runs(*keys: np.ndarray) -> np.ndarray:
    new = np.zeros(max(len(keys[0]) - 1, 0), bool)
    for key in keys:
        new |= key[1:] != key[:-1]
    return np.flatnonzero(np.r_[True, new])


class Sorted:
    """Whole runs of sorted rows from batches: rows are held until the run they may belong to is over."""

    def __init__(self, names: list[str], most: int) -> None:
        self.names, self.most, self.held, self.rows = names, most, [], 0

    def add(self, batch: pa.RecordBatch) -> dict[str, np.ndarray] | None:
        columns = [ids_of(batch.column(c)) if c == "text_id" else batch.column(c).to_numpy(zero_copy_only=False) for c in self.names]
        self.held.append(columns)
        self.rows += len(batch)
        return self.all() if self.rows >= self.most else None

    def all(self) -> dict[str, np.ndarray] | None:
        """Everything that is held; the rows from some place on can be put back."""
        if not self.rows:
            return None
        columns = dict(zip(self.names, map(np.concatenate, zip(*self.held))))
        self.held, self.rows = [], 0
        return columns

    def put_back(self, columns: dict[str, np.ndarray], rows: np.ndarray | slice) -> None:
        self.held = [[columns[c][rows] for c in self.names]]
        self.rows = len(self.held[0][0])


JUDGED = "kind int, head long, text_id binary, first int, end int, hot boolean"


def judged(found: DataFrame) -> DataFrame:
    """Suffixes whose region repeats (SETTLED), whose head does (OPEN), and what the latter are compared with (PARTNER)."""
    names = ["head", "region", "text_id", "first", "end", "kind", "hot"]

    def verdicts(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        head, region, hot, known = rows["head"], rows["region"], rows["hot"], rows["kind"] == KNOWN
        begin = starts_of_runs(head, region)
        length = np.diff(np.r_[begin, len(head)])
        whole = (length > 1) | np.logical_or.reduceat(known, begin)
        by_head = starts_of_runs(head[begin])
        regions = np.diff(np.r_[by_head, len(begin)])
        # a hot head is shared, if not here
        shared = np.repeat(regions > 1, regions) | hot[begin]
        open_ = shared & ~whole
        beside = whole & (hot[begin] | np.repeat(np.logical_or.reduceat(open_, by_head), regions))
        settled = np.flatnonzero(np.repeat(whole, length) & ~known)
        chosen = np.concatenate([settled, begin[open_], begin[beside]])
        kind = np.repeat([SETTLED, OPEN, PARTNER], [len(settled), open_.sum(), beside.sum()])
        return batch_of(JUDGED, [kind, *(rows[c][chosen] for c in ("head", "text_id", "first", "end", "hot"))])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Sorted(names, RUN_ROWS)
        for batch in batches:
            rows = runs.add(batch)
            if rows is None:
                continue
            # the last run may go on: of a hot head one region, else all of one head
            keys = (rows["head"], rows["region"]) if rows["hot"][-1] else (rows["head"],)
            last = starts_of_runs(*keys)[-1]
            if last:
                yield verdicts({c: x[:last] for c, x in rows.items()})
                runs.put_back(rows, slice(last, None))
            elif rows["hot"][-1]:
                # one region throughout: all repeat, and one goes on to tell the others so
                settled = np.flatnonzero(rows["kind"] != KNOWN)
                yield batch_of(JUDGED, [np.full(len(settled), SETTLED), *(rows[c][settled] for c in ("head", "text_id", "first", "end", "hot"))])
                rows["kind"][0] = KNOWN
                runs.put_back(rows, slice(0, 1))
            else:
                runs.put_back(rows, slice(0, None))
        rows = runs.all()
        if rows is not None:
            yield verdicts(rows)

    fresh = found.filter(F.col("kind") != SETTLED)
    dealt = (fresh.join(hot_heads(fresh), "head", "left").withColumn("hot", F.coalesce("hot", F.lit(False))).select(*names)
             .repartition(F.when(F.col("hot"), F.col("region")).otherwise(F.col("head"))).sortWithinPartitions("hot", "head", "region"))
    late = written(dealt.mapInArrow(judge, JUDGED), "judged")
    return late.unionByName(found.filter(F.col("kind") == SETTLED).drop("region").withColumn("hot", F.lit(False)))


def hot_heads(fresh: DataFrame) -> DataFrame:
    """The heads of very many suffixes. Which ones they are decides where rows meet, not what is found."""
    sample = fresh.filter(F.pmod(F.xxhash64("text_id", "first"), F.lit(SAMPLED)) == 0)
    return written(sample.groupBy("head").count().filter(F.col("count") >= HOT).select("head", F.lit(True).alias("hot")), "heads")


def packed(rows: DataFrame) -> DataFrame:
    """text_id and the compressed bytes of texts, once a task."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in slices(batches, "text"):
            new = first_in_task(batch, met)
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in new], pa.binary()),
                                              pa.array([zlib.compress(x, 1) for _, x in new], pa.binary())], ["text_id", "data"])

    return rows.select("text_id", "text").mapInArrow(read, "text_id binary, data binary")


def strings_in(regions: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes; of each string of ``regions`` its region, its offset there and where it begins in the bytes."""
    lengths = np.array([len(x) for x in regions])
    data = np.frombuffer(b"".join(regions), np.uint8)
    n = lengths - LENGTH + 1
    row = np.repeat(np.arange(len(regions)), n)
    shift = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return data, np.stack([row, shift]), (np.cumsum(lengths) - lengths)[row] + shift


def runs_of(ids: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Id, first and end of the runs of neighbouring starts."""
    order = np.lexsort((first, ids[:, 1], ids[:, 0]))
    ids, first = ids[order], first[order]
    new = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]).any(axis=1) | (first[1:] > first[:-1] + 1)])
    last = np.r_[new[1:] - 1, len(first) - 1]
    return [ids[new], first[new], first[last] + LENGTH]


COMPARED = "kind int, key long, more long, text_id binary, first int, end int, bytes binary"


def to_compare(texts: DataFrame, sorted_out: DataFrame) -> DataFrame:
    """What is compared, by ``key``: regions (OPEN, by head), strings (FRESH, or KNOWN to repeat, by two hashes) and runs that do (SETTLED)."""
    places = (sorted_out.filter(F.col("kind") != SETTLED).groupBy("text_id")
              .agg(F.collect_list(F.struct("head", "first", "end", "hot")).alias("places")))

    def rows_of(kind: int | np.ndarray, key: np.ndarray, more: np.ndarray, ids: np.ndarray, first: np.ndarray, end: np.ndarray, data: list | None) -> pa.RecordBatch:
        n = len(key)
        return batch_of(COMPARED, [np.broadcast_to(kind, n), key, more, ids, first, end, data if data is not None else [None] * n])

    def cut(regions: list[tuple[int, bytes, int, bytes]]) -> Iterator[pa.RecordBatch]:
        heads, ids, firsts, parts = zip(*regions)
        data, (row, shift), at = strings_in(list(parts))
        string = span_hashes(prefix_hashes(data), at, at + LENGTH)
        # a second hash by other values, and the head
        other = mix(quick_hashes(data, LENGTH)[at] ^ np.array(heads, np.int64).view(np.uint64)[row])
        ids = np.frombuffer(b"".join(ids), np.uint64).reshape(-1, 2)[row]
        first = np.array(firsts, np.int64)[row] + shift
        order = np.lexsort((other, string))
        begin = starts_of_runs(string[order], other[order])
        length = np.diff(np.r_[begin, len(order)])
        one = order[begin]
        yield rows_of(np.where(length > 1, KNOWN, FRESH), string[one], other[one], ids[one], first[one], first[one] + LENGTH, None)
        again = order[np.repeat(length > 1, length)]
        if len(again):
            found, low, high = runs_of(ids[again], first[again])
            yield rows_of(SETTLED, found[:, 0], found[:, 1], found, low, high, None)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data", 1 << 20):
            few, hot, size = [], [], 0
            for text_id, data, places in zip(*(batch.column(c).to_pylist() for c in ("text_id", "data", "places"))):
                text = zlib.decompress(data)
                for p in places:
                    region = text[p["first"]:p["end"]]
                    if not p["hot"]:
                        few.append((p["head"], text_id, p["first"], p["end"], region))
                        continue
                    hot.append((p["head"], text_id, p["first"], region))
                    size += len(region)
                    if size > CUT_BYTES:
                        yield from cut(hot)
                        hot, size = [], 0
            if hot:
                yield from cut(hot)
            if few:
                head, ids, first, end, data = zip(*few)
                yield rows_of(OPEN, np.array(head), np.zeros(len(head), np.int64), np.frombuffer(b"".join(ids), np.uint64).reshape(-1, 2),
                              np.array(first), np.array(end), list(data))

    return texts.join(places, "text_id").mapInArrow(fetch, COMPARED)


SPANS = "text_id binary, first int, end int"


def repeated_strings(texts: DataFrame, sorted_out: DataFrame) -> DataFrame:
    """text_id, first and end of repeated bytes in the regions that are not settled."""
    names = ["key", "more", "text_id", "first", "kind"]

    def of_regions(family: IndexFamily, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, (row, shift), at = strings_in(batch.column("bytes").to_pylist())
        strings = np.ndarray(len(data) - LENGTH + 1, f"S{LENGTH}", data, strides=(1,))[at]
        ids, first = ids_of(batch.column("text_id"))[row], batch.column("first").to_numpy()[row] + shift
        places = np.empty(len(row), [("id", np.uint64, 2), ("first", np.int64)])
        places["id"], places["first"] = ids, first
        found = family.add(strings, batch.column("key").to_numpy()[row], places)
        if len(found):
            yield batch_of(SPANS, runs_of(found["id"], found["first"]))

    def of_strings(runs: Sorted, rows: dict[str, np.ndarray] | None, over: bool) -> Iterator[pa.RecordBatch]:
        if rows is None:
            return
        begin = starts_of_runs(rows["key"], rows["more"])
        known = rows["kind"] == KNOWN
        length = np.diff(np.r_[begin, len(known)])
        whole = (length > 1) | np.logical_or.reduceat(known, begin)
        # what is known is in a run already, and the last run may go on
        again = np.repeat(whole, length) & ~known
        if not over:
            rows["kind"][begin[-1]] = KNOWN if whole[-1] else rows["kind"][begin[-1]]
            runs.put_back(rows, slice(begin[-1], begin[-1] + 1))
        if again.any():
            yield batch_of(SPANS, runs_of(rows["text_id"][again], rows["first"][again]))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, runs = IndexFamily(), Sorted(names, RUN_ROWS)
        for batch in slices(batches, "bytes", ARRAY_BYTES):
            kind = batch.column("kind").to_numpy()
            settled, regions, strings = (batch.filter(pa.array(x)) for x in (kind == SETTLED, kind == OPEN, kind >= FRESH))
            if len(settled):
                yield settled.select(["text_id", "first", "end"])
            if len(regions):
                yield from of_regions(family, regions)
            if len(strings):
                yield from of_strings(runs, runs.add(strings), False)
        yield from of_strings(runs, runs.all(), True)

    order = F.least(F.col("kind"), F.lit(FRESH))
    return (to_compare(texts, sorted_out).repartition("key").sortWithinPartitions(order, "key", "more")
            .mapInArrow(compare, SPANS))


def merged(spans: pa.ListScalar) -> list[tuple[int, int]]:
    """The spans of a text in order, with those that meet as one."""
    first, end = (spans.values.field(c).to_numpy() for c in ("first", "end"))
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.r_[True, first[1:] > reach[:-1]])
    last = np.r_[new[1:] - 1, len(first) - 1]
    return list(zip(first[new].tolist(), reach[last].tolist()))


def repeats(docs: DataFrame, copied: DataFrame) -> tuple[DataFrame, DataFrame]:
    """text_id and spans of texts with repeated bytes that are not ``copied``, and text_id and compressed bytes of all texts."""
    rows = with_ids(docs)
    sorted_out = judged(suffixes(rows))
    texts = packed(rows)
    spans = (sorted_out.filter(F.col("kind") == SETTLED).select("text_id", "first", "end")
             .unionByName(repeated_strings(texts, sorted_out)))
    # copied texts go as a whole, and each task has spans for them
    once = spans.join(copied, "text_id", "left_anti")
    return once.groupBy("text_id").agg(F.collect_list(F.struct("first", "end")).alias("spans")), texts


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, the text's digest (whole) and its text_id, for every row."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
                       F.sha2(F.encode(text, "UTF-8"), 256).alias("whole"))
    return rows.withColumn("text_id", F.unhex(F.substring("whole", 1, 2 * ID)))


def copied_texts(rows: DataFrame) -> DataFrame:
    """text_id of the texts that are long enough and that more rows than one have."""
    return written(rows.filter(F.col("n_bytes") >= LENGTH).groupBy("text_id").count().filter("count > 1").select("text_id"), "copied")


def kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for first, end in spans:
        out.append(data[at:first])
        at = end
    return b"".join([*out, data[at:]])


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    rows = digests(docs)
    copied = copied_texts(rows)
    by_text, texts = repeats(docs, copied)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data"):
            out = []
            for text_id, data, spans in zip(*(batch.column(c).to_pylist() for c in ("text_id", "data")), batch.column("spans")):
                runs = merged(spans)
                rest = kept(zlib.decompress(data), runs)
                out.append((text_id, sum(b - a for a, b in runs), len(runs), hashlib.sha256(rest).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out), (pa.binary(), pa.int64(), pa.int64(), pa.string()))],
                ["text_id", "n_removed", "n_spans", "kept_sha256"])

    cuts = texts.join(by_text, "text_id").mapInArrow(cut, "text_id binary, n_removed long, n_spans long, kept_sha256 string")
    gone = copied.select("text_id", F.lit(None).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
                         F.sha2(F.lit("").cast("binary"), 256).alias("kept_sha256"))
    return rows.join(cuts.unionByName(gone), "text_id", "left").select(
        "doc_id", "n_bytes",
        F.when(F.col("n_spans").isNull(), 0).otherwise(F.coalesce("n_removed", "n_bytes")).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"))


def whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that leave out characters of which they hold some bytes only."""
    out = []
    for first, end in spans:
        while first < end and data[first] & 0xC0 == 0x80:
            first += 1
        while end > first and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        if end > first:
            out.append((first, end))
    return out


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the repeated bytes taken out of ``text`` and ``n_chars`` counted anew.

    Characters that are repeated only in part stay. Texts left empty stay as empty texts.
    """
    copied = copied_texts(digests(docs))
    by_text, _ = repeats(docs, copied)
    gone = copied.select("text_id", F.array().cast(by_text.schema["spans"].dataType).alias("spans"))
    changed = by_text.unionByName(gone).withColumnRenamed("text_id", "__text")
    names = docs.columns
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), text.alias("text"), text_id(text).alias("id"))
    met = rows.join(changed, F.col("id") == F.col("__text"), "left").select("row", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            columns = dict(zip(names, batch.column("row").flatten()))
            texts = columns["text"].to_pylist()
            sizes = columns["n_chars"].to_pylist() if "n_chars" in columns else None
            for i, (text, spans) in enumerate(zip(texts, batch.column("spans"))):
                if not spans.is_valid:
                    continue
                data = text.encode()
                # a copied text has no spans: it goes as a whole
                runs = merged(spans) if len(spans) else [(0, len(data))]
                texts[i] = kept(data, whole_characters(data, runs)).decode()
                if sizes:
                    sizes[i] = len(texts[i])
            columns["text"] = pa.array(texts, pa.string())
            if sizes is not None:
                columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return met.mapInArrow(cut, docs.schema)
