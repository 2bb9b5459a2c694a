"""Secret scan through a trigram inverted index.

From the parse tree of every rule's pattern a Boolean query over trigrams is derived that each text with a
match fulfils: literals that follow each other give trigrams that are all needed, branches give
alternatives, classes and repetitions of open size give none. Documents are indexed in segments, one
batch of whole texts each: the postings of a trigram are the sorted numbers of the segment's texts that hold it,
kept for the trigrams that some query names. A rule's query is answered by intersecting and joining postings, and
only the texts that are left are read by the regular expression. A pattern without a needed trigram, such as a run
of hex digits, reads all texts of the segment.

Segments live where their texts are, so no posting or text is shuffled and memory is bounded by a batch; a lost task
builds its segments again. Trigrams are over UTF-8 bytes with A-Z in lower case, the same for queries; that makes
more candidates, never fewer.

Spans are code points, end exclusive, leftmost and non-overlapping per kind; a match whose value is too short is
dropped without another try. Null texts are empty, empty texts have no spans. Repeated rows give repeated rows,
an empty table none. Texts of any length are indexed and read whole. Other columns of the input are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from re import _constants as ops
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastria.llm.common import slices
from cadastria.llm.hashing import LOWER, utf8


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and how long the value in ``group`` (0: the whole match) must be."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


#: The kinds that are always looked for. A run of 24 or more hex digits is one match of ``[0-9a-f]+``.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Published shapes of credentials.
SHAPES = (
    Rule("git", r"gh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("chat", r"xox[abposr]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("signed", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("key_file", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("login", r"(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x00-\x20/:@]+:[^\x00-\x20/:@]+@[A-Za-z0-9.-]+"),
    Rule("bearer", r"[Bb]earer\x20+[A-Za-z0-9._~+/-]{20,}=*"),
)
RULES = BASE + SHAPES

#: A set of strings that is kept while a query is derived, and a class that is taken for its characters, have so many at most.
STRINGS, CLASS = 32, 8

#: A query: alternatives, each a set of trigrams that are all needed. No alternative: nothing can match; one without trigrams: anything may.
Query = frozenset[frozenset[str]]
ANYTHING: Query = frozenset([frozenset()])


def least(alternatives: Iterable[frozenset[str]]) -> Query:
    """Without alternatives that ask for more than another one does."""
    kept: list[frozenset[str]] = []
    for one in sorted(set(alternatives), key=len):
        if not any(other <= one for other in kept):
            kept.append(one)
    return frozenset(kept)


def both(a: Query, b: Query) -> Query:
    """Texts that fulfil both; of many alternatives the shorter query alone will do, as it leaves more texts."""
    if len(a) * len(b) > STRINGS:
        return min(a, b, key=len)
    return least(x | y for x in a for y in b)


def holding(strings: Iterable[str]) -> Query:
    """Texts that hold one of ``strings``."""
    return least(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings)


@dataclass(frozen=True)
class Facts:
    """What is known of all strings a part of a pattern matches, lower-cased.

    ``exact`` are all of them, or None if they are many; otherwise each begins with one of ``first``, ends with one of ``last`` and
    fulfils ``query``.
    """

    exact: frozenset[str] | None
    first: frozenset[str]
    last: frozenset[str]
    query: Query

    @classmethod
    def of(cls, strings: Iterable[str]) -> "Facts":
        strings = frozenset(strings)
        return cls(strings, frozenset(s[:2] for s in strings), frozenset(s[-2:] for s in strings), holding(strings))

    @classmethod
    def open(cls, first: frozenset[str] = frozenset([""]), last: frozenset[str] = frozenset([""]), query: Query = ANYTHING) -> "Facts":
        return cls(None, first, last, query)


NOTHING = Facts.of([""])
UNKNOWN = Facts.open()


def product(a: frozenset[str], b: frozenset[str]) -> frozenset[str] | None:
    return frozenset(x + y for x in a for y in b) if len(a) * len(b) <= STRINGS else None


def followed(a: Facts, b: Facts) -> Facts:
    if a.exact is not None and b.exact is not None and (joined := product(a.exact, b.exact)) is not None:
        return Facts.of(joined)
    seam = product(a.exact or a.last, b.exact or b.first)
    query = both(both(a.query, b.query), holding(seam) if seam is not None else ANYTHING)
    first = product(a.exact, b.first) if a.exact is not None else a.first
    last = product(a.last, b.exact) if b.exact is not None else b.last
    return Facts.open(frozenset(s[:2] for s in (first if first is not None else a.first)),
                      frozenset(s[-2:] for s in (last if last is not None else b.last)), query)


def either(a: Facts, b: Facts) -> Facts:
    if a.exact is not None and b.exact is not None and len(a.exact | b.exact) <= STRINGS:
        return Facts.of(a.exact | b.exact)
    return Facts.open(a.first | b.first, a.last | b.last, least(a.query | b.query))


def one_of(members: list) -> Facts:
    """A character of a class."""
    chars: set[int] = set()
    for op, value in members:
        if op is ops.LITERAL:
            chars.add(value)
        elif op is ops.RANGE and value[1] - value[0] < 2 * CLASS:
            chars.update(range(value[0], value[1] + 1))
        else:
            return UNKNOWN
    folded = {chr(c).lower() for c in chars}
    return Facts.of(folded) if len(folded) <= CLASS and max(chars) < 128 else UNKNOWN


def facts(tree: Iterable) -> Facts:
    """What is known of a parse tree; of what has no rule here, nothing is."""
    known = NOTHING
    for op, value in tree:
        if op is ops.LITERAL:
            part = Facts.of([chr(value).lower()]) if value < 128 else UNKNOWN
        elif op is ops.IN:
            part = one_of(value)
        elif op is ops.SUBPATTERN:
            part = facts(value[3])
        elif op is ops.BRANCH:
            part, *rest = map(facts, value[1])
            for other in rest:
                part = either(part, other)
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT):
            part = repeated(*value)
        elif op in (ops.AT, ops.ASSERT, ops.ASSERT_NOT):
            part = NOTHING
        else:
            part = UNKNOWN
        known = followed(known, part)
    return known


def repeated(low: int, high: int, tree: Iterable) -> Facts:
    once = facts(tree)
    if (low, high) == (0, 1):
        return either(once, NOTHING)
    if low == 0:
        return UNKNOWN
    known = once
    for _ in range(min(low, 3) - 1):
        known = followed(known, once)
    if low == high <= 3:
        return known
    # more of the same may follow: only what begins and ends the first and the last one stays known
    return Facts.open(known.first, known.last, known.query)


def query_of(rule: Rule) -> Query:
    """The trigrams that texts with a match of ``rule`` hold; ANYTHING if the pattern needs none."""
    return facts(parser.parse(rule.pattern, re.ASCII)).query


class Index:
    """Inverted index of segments for the trigrams that ``queries`` name.

    The bytes that occur in those trigrams are numbered from 1, all others are 0, so that a table of all triples is small.
    """

    def __init__(self, queries: Iterable[Query]) -> None:
        self.terms = sorted({t for q in queries for one in q for t in one})
        used = sorted({b for t in self.terms for b in t.encode()})
        number = np.zeros(256, np.int32)
        number[used] = np.arange(1, len(used) + 1)
        self.number, self.base = number[LOWER], len(used) + 1
        self.term_of = np.full(self.base ** 3, -1, np.int32)
        for i, term in enumerate(self.terms):
            a, b, c = number[list(term.encode())]
            self.term_of[(a * self.base + b) * self.base + c] = i

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
        """For each trigram the sorted numbers of the texts that hold it."""
        if len(data) < 3 or not self.terms:
            return {}
        x = self.number[data]
        term = self.term_of[(x[:-2] * self.base + x[1:-1]) * self.base + x[2:]]
        at = np.flatnonzero(term >= 0)
        text = np.searchsorted(offsets, at, side="right") - 1
        inside = at + 3 <= offsets[text + 1]
        n = len(offsets) - 1
        pairs = np.unique(term[at[inside]].astype(np.int64) * n + text[inside])
        edges = np.searchsorted(pairs, np.arange(len(self.terms) + 1) * n)
        return {t: pairs[a:b] - i * n for i, (t, a, b) in enumerate(zip(self.terms, edges[:-1], edges[1:])) if b > a}


def candidates(query: Query, postings: dict[str, np.ndarray], n: int) -> np.ndarray:
    """The texts that fulfil ``query``: postings are intersected, shortest first, and alternatives joined."""
    if query == ANYTHING:
        return np.arange(n)
    none = np.zeros(0, np.int64)
    found = none
    for needed in query:
        lists = sorted((postings.get(t, none) for t in needed), key=len)
        left = lists[0]
        for other in lists[1:]:
            if not len(left):
                break
            left = np.intersect1d(left, other, assume_unique=True)
        found = np.union1d(found, left)
    return found


SPAN = "struct<kind:int,start:long,end:long>"


def with_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and ``spans`` (kind as a number in ``rules``, start, end) of every document, by start, then kind."""
    span_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [query_of(r) for r in rules]
        patterns = [r.compiled() for r in rules]
        index = Index(queries)
        for batch in slices(batches, "text"):
            column = batch.column("text")
            postings = index.postings(*utf8(column))
            spans: list[list[tuple[int, int, int]]] = [[] for _ in range(len(batch))]
            for kind, (rule, query, pattern) in enumerate(zip(rules, queries, patterns)):
                chosen = candidates(query, postings, len(batch))
                for i, text in zip(chosen.tolist(), column.take(pa.array(chosen)).to_pylist()):
                    spans[i] += [(m.start(), kind, m.end()) for m in pattern.finditer(text)
                                 if m.end(rule.group) - m.start(rule.group) >= rule.least]
            rows = [[{"kind": k, "start": a, "end": b} for a, k, b in sorted(found)] for found in spans]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, span_type)], ["doc_id", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(scan, f"doc_id long, spans array<{SPAN}>")


def as_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
