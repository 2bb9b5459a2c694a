"""Quality rules: counts of a text and a threshold table over their ratios, as one Spark projection.

A threshold table is a list of ``Rule`` rows (numerator, denominator, least, most). It is compiled
into Column expressions on integer counts, so the whole check is built-in expressions in one
projection over the scan: no shuffle, no user function, and one pass over the text.

Null and empty texts have no words and fail. Repeated rows are judged one by one. Columns of the
input other than the text pass through ``with_verdict`` untouched unless they carry an output name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastria.llm.common import NOT_WHITE, let, words_of

#: Characters that count as symbols, and function words of four languages.
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "the of and to a in is that it for was on with as be this by are at from "
    "de la le et les des en du un que pour une est qui dans par sur au pas avec "
    "der die und den das von zu mit sich auf für nicht dem ist im ein eine als "
    "el y los las del se no por con su para es al lo"
).split()
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """``least <= 100 * part / whole <= most`` on two counts; a bound of None is open."""

    part: str
    whole: str
    least: int | None = None
    most: int | None = None

    def column(self) -> Column:
        part, whole = 100 * F.col(self.part), F.col(self.whole)
        ok = F.lit(True)
        if self.least is not None:
            ok = ok & (part >= self.least * whole)
        if self.most is not None:
            ok = ok & (part <= self.most * whole)
        return ok


#: Percentages: mean word length, symbols and function words per word, repeated lines per line.
RULES = [
    Rule("word_chars", "n_words", least=200, most=1500),
    Rule("n_symbols", "n_words", most=30),
    Rule("n_stop_words", "n_words", least=6),
    Rule("n_dup_lines", "n_lines", most=60),
]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words"]


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more among ``words``.

    Most texts repeat no window: then the windows' hashes all differ and nothing is sorted. Else the
    windows are sorted by hash, words and position, so equal ones are neighbours, and compared word by word.
    """
    def hashes(w: Column) -> Column:
        # the last two are of fewer words and are left out
        return F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))), F.lit(1), F.size(w) - 2)

    def ordered(w: Column, h: Column) -> Column:
        n = F.size(w) - 2
        parts = [F.slice(w, F.lit(k + 1), n).alias(name) for k, name in enumerate("abc")]
        return F.sort_array(F.arrays_zip(h.alias("h"), *parts, F.sequence(F.lit(0), n - 1).alias("at")))

    def covered(s: Column) -> Column:
        def places(x: Column, i: Column) -> Column:
            y = F.get(s, i + 1)
            equal = (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
            return F.when(equal, F.array(*[p["at"] + d for p in (x, y) for d in range(3)]))

        return F.size(F.array_distinct(F.flatten(F.filter(F.transform(s, places), F.isnotnull))))

    def counted(w: Column) -> Column:
        return let(hashes(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0)
                   .otherwise(let(ordered(w, h), covered)))

    # a text without a fourth word has one window at most
    return F.when(F.size(words) < 4, 0).otherwise(counted(words))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns COUNTS (long)."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(NOT_WHITE))
    stop = lambda w: F.rtrim(F.lower(w), F.lit(".,")).isin(STOP_WORDS)
    of_words = let(words_of(body), lambda w: F.struct(
        F.size(w).alias("n_words"),
        F.char_length(F.array_join(w, "")).alias("word_chars"),
        F.size(F.filter(w, stop)).alias("n_stop_words"),
        repeat_words(w).alias("n_repeat_words"),
    ))
    of_lines = let(lines, lambda x: F.struct(
        F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    names = [F.col(f"`{c}`") for c in docs.columns if c not in COUNTS]
    out = docs.select(*names, of_words.alias("__words"), of_lines.alias("__lines"),
                      F.regexp_count(body, F.lit(f"[{SYMBOLS}]")).alias("n_symbols"))
    place = {"n_symbols": "n_symbols", "n_lines": "__lines.n_lines", "n_dup_lines": "__lines.n_dup_lines"}
    return out.select(*names, *[F.col(place.get(c, f"__words.{c}")).cast("long").alias(c) for c in COUNTS])


def with_verdict(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with COUNTS, ``base_failed`` and ``kept``."""
    counted = with_counts(docs, text)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    verdict = ~failed
    for rule in rules:
        verdict = verdict & rule.column()
    names = [F.col(f"`{c}`") for c in counted.columns if c not in ("base_failed", "kept")]
    return counted.select(*names, failed.alias("base_failed"), verdict.alias("kept"))


def rejected_removed(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    marked = "__judged"
    judged = with_verdict(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(marked),
                                      F.col("text").alias("__text")), rules, "__text")
    return judged.filter("kept").select(f"{marked}.*")
