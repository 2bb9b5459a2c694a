"""Personal data by weak supervision, in built-in column expressions.

Candidates are the matches of one pattern per kind. Five labelers vote on each (1: personal, 0: not,
-1: abstain): the kind's own validity check, a gazetteer, cue words before it, its edges, and its
shape. Expectation-maximisation over the counts of vote patterns estimates each labeler's
reliabilities and gives every pattern a probability; a logistic span classifier is trained on those.
Candidates of the four base kinds are spans if they pass their check, and no others of these kinds
are; those that fail serve as negative examples. Of the other kinds (long credentials, assigned passwords, account
numbers, phone numbers without a country) no check alone tells, and the classifier decides. Names of people are not looked for.

The text is scanned once, in one projection without user functions. What it found is a table of the distinct texts that have
candidates, by 128 bits of their digest. Patterns are counted by a grouped aggregation over it; at most ``kinds * 3 ** labelers`` rows of
counts reach the driver, which fits both models, and the classifier goes back as a column expression. Documents meet their spans by
digest in one join, which Spark broadcasts if the table is small.

Null and empty texts have no spans. Offsets are in code points, the end exclusive. Repeated rows are
treated one by one; in an empty table nothing is learned. Other columns pass through unless they carry
an output name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastria.llm.common import let, written

KINDS = ["email", "ip", "card", "phone", "secret", "password", "account", "local_phone"]
BASE_KINDS = KINDS[:4]
LABELERS = ["check", "gazetteer", "cue", "edges", "shape"]
#: Characters before a candidate in which cue words count.
CONTEXT = 24
THRESHOLD = 0.5
#: Bits that tell every task which texts may have candidates; they change cost, not results.
SLOTS = 1 << 23

#: The base patterns, with possessive repeats and starts at the edge of a run, so that a search is
#: linear; they match what the plain patterns match. The last four have no base pattern.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}+(?![A-Za-z0-9+/_-])",
    "password": r"(?<=[:=][\"'\x20]{0,2})(?<=(?i:passw(?:or[dt]|d)|passphrase|pwd)[\"']?\x20{0,2}[:=]\x20{0,2}[\"']?)[^\s\"'<>]{6,64}+",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
    "local_phone": r"(?<![A-Za-z0-9+.,:/(\x2D])(?<![0-9]\x20)\(?0[1-9][0-9]{0,3}\)?(?:[\x20/.-][0-9]{2,9}){1,4}+(?![A-Za-z0-9])",
}
#: Words and prefixes that the labelers know.
GAZETTEER = {
    "email": r"(?i)\.(com|org|net|edu|gov|io|co|de|fr|es|uk|eu|info)$",
    "ip": r"^(?!0|10\.|127\.|192\.168\.|255\.)",
    "card": r"^(4|5[1-5]|2[2-7]|3[47]|6(011|5))",
    "phone": r"^\+(1|7|20|27|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-5])",
    "secret": r"^(AKIA|ASIA|sk-|ghp_|xox[abp]-|AIza)",
    "password": r"(?i)^(?!(changeme|example|password|required|optional|string|hidden|secret|redacted|unknown|default|your|none|null|true|false|[x*.]+$))",
    "account": r"^(AD|AE|AL|AT|BA|BE|BG|CH|CY|CZ|DE|DK|EE|ES|FI|FR|GB|GE|GI|GR|HR|HU|IE|IL|IS|IT|LI|LT|LU|LV|MC|MD|ME|MK|MT|NL|NO|PL|PT|RO|RS|SE|SI|SK|SM|TR|UA|XK)",
    "local_phone": r"^\(?0(1[0-9]{1,2}|20|30|40|69|89|[1-9][0-9]{0,3})\)?[^0-9]",
}
CUES = {
    "email": r"(?i)(mail|contact|write|address)\W*$",
    "ip": r"(?i)\b(ip|host|server|address)\W*$",
    "card": r"(?i)(card|visa|mastercard|amex|credit)\W*$",
    "phone": r"(?i)(tel|phone|call|mobile|fax)\W*$",
    "secret": r"(?i)(token|secret|key|passw(or)?d|bearer)\W*$",
    "password": r"(?i)(passw(or[dt]|d)|passphrase|pwd)\W*$",
    "account": r"(?i)(iban|account|konto|bank|compte|cuenta)\W*$",
    "local_phone": r"(?i)(tel|phone|call|mobile|fax|telefon|téléphone|teléfono|anruf)\W*$",
}
SHAPES = {
    "email": r"^[A-Za-z0-9].*@[^@]*[A-Za-z]$",
    "ip": r"^(0|[1-9][0-9]*)(\.(0|[1-9][0-9]*)){3}$",
    "card": r"^([0-9]+|[0-9]{4}([ -][0-9]{4})+)$",
    "phone": r"^\+[0-9]{1,3}([ .-]?\(?[0-9]+\)?)+$",
    # digits and letters, but no words joined by signs as in paths and titles
    "secret": r"^(?=.*[0-9])(?=.*[A-Za-z])(?!(?:[A-Za-z0-9]*[/_-])*?[a-z]{2,}[/_-][a-z]{2,}(?:[/_-]|$))",
    "password": r"^(?=.*[A-Za-z])(?=.*[^A-Za-z])",
    "account": r"^([A-Z0-9]+|[A-Z0-9]{4}(\x20[A-Z0-9]{4})+(\x20[A-Z0-9]{1,3})?)$",
    "local_phone": r"^(\(0[0-9]+\)|0[0-9]+)(\x20[0-9]+|/[0-9]+|-[0-9]+|\.[0-9]+)+$",
}
#: Kinds of which the gazetteer knows what they can't be; of kinds whose cue is part of the rule its absence counts too.
CLOSED = {"card", "phone", "email", "password", "account", "local_phone"}
CUED = {"local_phone"}
#: Kinds whose check digits or length say for certain what can't be one.
CERTAIN = ["account", "local_phone"]


def running(values: Column, block: int = 256) -> Column:
    """Sums of each value and all before it, blockwise, so long arrays take no quadratic time."""
    def sums(xs: Column) -> Column:
        none = F.struct(F.lit(0).cast("long").alias("s"), F.array().cast("array<bigint>").alias("out"))
        step = lambda acc, x: let(acc["s"] + x, lambda s: F.struct(s.alias("s"), F.array_append(acc["out"], s).alias("out")))
        return F.aggregate(xs, none, step, lambda acc: acc["out"])

    def blocks(xs: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / block).cast("int"))
        return F.transform(starts, lambda b: sums(F.slice(xs, b * block + 1, F.lit(block))))

    def joined(parts: Column) -> Column:
        before = sums(F.transform(parts, lambda p: F.element_at(p, -1)))
        return let(before, lambda t: F.flatten(F.transform(parts, lambda p, i: F.transform(
            p, lambda x: x + F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(t, i - 1))))))

    return F.when(F.size(values) == 0, F.array().cast("array<bigint>")).otherwise(let(blocks(values), joined))


def luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = 2 * d - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add)
    return total % 10 == 0


def ninety_seven(value: Column) -> Column:
    """Whether an account number, read from its fifth character on with letters as numbers, leaves 1 when divided by 97."""
    turned = F.concat(F.substring(value, 5, 40), F.substring(value, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(turned)), F.lit(0), add) == 1


def check(kind: str, value: Column) -> Column:
    """The validity check of a kind."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.char_length(digits)
    if kind == "ip":
        # parts may have leading zeros and any number of digits
        small = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
        return value.rlike(rf"^(?:{small}\.){{3}}{small}$")
    if kind == "card":
        return F.when(n.between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    if kind == "secret":
        return value.rlike(r"^([0-9a-f]{32,}|[0-9A-F]{32,}|(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z]).*)$") & value.rlike("[A-Za-z]")
    if kind == "password":
        return value.rlike(r"^(?=.*[0-9])(?=.*[^0-9])")
    if kind == "account":
        bare = F.regexp_replace(value, " ", "")
        return F.when(F.char_length(bare).between(15, 34), ninety_seven(bare)).otherwise(False)
    if kind == "local_phone":
        return n.between(9, 12)
    return F.lit(True)


def candidates(text: Column, kind: str) -> Column:
    """Start, end, check and votes of every match of a kind; ``text`` isn't null."""
    number = KINDS.index(kind)
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))

    def described(values: Column, gaps: Column, ends: Column) -> Column:
        def one(value: Column, i: Column) -> Column:
            before, after = F.substring(F.get(gaps, i), -CONTEXT, CONTEXT), F.substring(F.get(gaps, i + 1), 1, 1)
            valid = check(kind, value)
            vote = lambda yes, no=None: F.when(yes, 1).otherwise(-1 if no is None else F.when(no, 0).otherwise(-1))
            clean = ~before.rlike(r"[\p{L}\p{N}_]$") & ~after.rlike(r"^[\p{L}\p{N}_]")
            shaped = value.rlike(SHAPES[kind])
            known = value.rlike(GAZETTEER[kind])
            cued = before.rlike(CUES[kind])
            return F.struct(
                (F.get(ends, i) - F.char_length(value)).alias("start"), F.lit(number).alias("kind"), F.get(ends, i).alias("end"),
                valid.alias("check"),
                F.array(vote(valid, ~valid), vote(known, ~known) if kind in CLOSED else vote(known),
                        vote(cued, ~cued) if kind in CUED else vote(cued), vote(clean, ~clean), vote(shaped, ~shaped)).alias("votes"))

        return F.transform(values, one)

    def placed(values: Column) -> Column:
        # what lies before, between and behind the matches gives their places
        gaps = F.split(text, PATTERNS[kind], -1)
        lengths = lambda g: F.zip_with(values, F.slice(g, F.lit(1), F.size(values)),
                                       lambda v, x: (F.char_length(v) + F.char_length(x)).cast("long"))
        return let(gaps, lambda g: let(running(lengths(g)), lambda ends: described(values, g, ends)))

    return let(found, lambda v: F.when(F.size(v) > 0, placed(v)).otherwise(F.array().cast(
        "array<struct<start:bigint,kind:int,end:bigint,check:boolean,votes:array<int>>>")))


def with_candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``candidates``, by start and kind."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn("candidates", F.sort_array(F.concat(*[candidates(body, k) for k in KINDS])))


@dataclass(frozen=True)
class Patterns:
    """Vote patterns of candidates and how often each occurs."""

    kinds: np.ndarray
    votes: np.ndarray
    counts: np.ndarray


def patterns(found: DataFrame) -> Patterns:
    """``found`` has ``candidates`` and how many rows have them (copies)."""
    rows = (found.select("copies", F.explode("candidates").alias("c")).groupBy("c.kind", "c.votes").agg(F.sum("copies").alias("n"))
            .orderBy("kind", "votes").collect())
    return Patterns(np.array([r["kind"] for r in rows], int), np.array([r["votes"] for r in rows], int).reshape(-1, len(LABELERS)),
                    np.array([r["n"] for r in rows], float))


def reliabilities(seen: Patterns, rounds: int = 50) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """The probability of each pattern, and by kind each labeler's share of right votes on either class.

    Labelers vote independently given the class. They start out right four times in five, and one
    right and one wrong vote are added to each count, so no estimate is certain.
    """
    truth = np.zeros(len(seen.counts))
    found: dict[int, np.ndarray] = {}
    for kind in np.unique(seen.kinds):
        rows = seen.kinds == kind
        votes, n = seen.votes[rows], seen.counts[rows]
        prior, right = 0.5, np.full((2, len(LABELERS)), 0.8)  # right[c]: share of right votes where the class is c
        for _ in range(rounds):
            log = [np.full(len(n), math.log(1 - prior)), np.full(len(n), math.log(prior))]
            for c in (0, 1):
                log[c] = log[c] + np.where(votes < 0, 0.0, np.where(votes == c, np.log(right[c]), np.log(1 - right[c]))).sum(axis=1)
            p = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
            prior = (1 + (n * p).sum()) / (2 + n.sum())
            for c, weight in ((0, n * (1 - p)), (1, n * p)):
                given = (weight[:, None] * (votes >= 0)).sum(axis=0)
                hits = (weight[:, None] * (votes == c)).sum(axis=0)
                # a labeler is better than chance, else the classes would swap
                right[c] = np.clip((hits + 4) / (given + 5), 0.55, 0.99)
        truth[rows], found[int(kind)] = p, right
    return truth, found


def features(kinds: np.ndarray, votes: np.ndarray) -> np.ndarray:
    """For each kind and labeler whether it says yes and whether it says no, and the kind."""
    one = np.eye(len(KINDS))[kinds]
    said = np.concatenate([votes == 1, votes == 0], axis=1).astype(float)
    return np.concatenate([one, (one[:, :, None] * said[:, None, :]).reshape(len(kinds), one.shape[1] * said.shape[1])], axis=1)


def span_classifier(seen: Patterns, truth: np.ndarray, rounds: int = 30, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton steps."""
    x = features(seen.kinds, seen.votes)
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (seen.counts * (truth - p)) - ridge * weights
        curve = (x * (seen.counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        weights = weights + np.linalg.solve(curve, slope)
    return weights


def score(c: Column, weights: np.ndarray) -> Column:
    """The classifier on a candidate."""
    k, j = len(KINDS), 2 * len(LABELERS)
    table = F.lit([float(w) for w in weights])
    at = lambda i: F.get(table, i)
    total = at(c["kind"])
    for i in range(len(LABELERS)):
        vote = F.get(c["votes"], i)
        total = total + F.when(vote == 1, at(k + c["kind"] * j + i)).when(vote == 0, at(k + c["kind"] * j + i + len(LABELERS))).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def slot(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(SLOTS))


def with_spans(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``candidates`` and their spans: ``base``, and ``all``, which has the classifier's too."""
    digest = F.substring(F.sha2(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8"), 256), 1, 32)
    # equal texts have equal candidates
    scanned = with_candidates(docs.select(F.col(text).alias("text")), "text").filter(F.size("candidates") > 0)
    found = written(scanned.groupBy(F.substring(F.sha2(F.encode("text", "UTF-8"), 256), 1, 32).alias("__digest"))
                    .agg(F.first("candidates").alias("candidates"), F.count("*").alias("copies"),
                         F.first(slot(F.col("text"))).alias("slot")), "candidates")
    seen = patterns(found)
    truth, _ = reliabilities(seen)
    weights = span_classifier(seen, truth)
    is_base = lambda c: (c["kind"] < len(BASE_KINDS)) & c["check"]
    certain = [KINDS.index(k) for k in CERTAIN]
    is_new = lambda c: ((c["kind"] >= len(BASE_KINDS)) & (c["check"] | ~c["kind"].isin(certain))
                        & (score(c, weights) >= threshold))
    bare = lambda xs: F.transform(xs, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    chosen = found.select(F.col("__digest"), F.col("candidates").alias("__found"),
                          bare(F.filter("candidates", is_base)).alias("__base"),
                          bare(F.filter("candidates", lambda c: is_base(c) | is_new(c))).alias("__all"))
    empty = lambda c: F.array().cast(chosen.schema[c].dataType)
    added = {"candidates": "__found", "base": "__base", "all": "__all"}
    # at most SLOTS / 64 rows: texts without candidates, which are most, stay where they are
    words = found.groupBy((F.col("slot") / 64).cast("long").alias("__word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("slot") % 64).cast("int"))).alias("__bits"))
    looked = docs.withColumn("__slot", slot(F.coalesce(F.col(text), F.lit("")))).join(
        F.broadcast(words), (F.col("__slot") / 64).cast("long") == F.col("__word"), "left")
    met = F.coalesce(F.getbit("__bits", F.col("__slot") % 64) == 1, F.lit(False))
    inner = ["__slot", "__word", "__bits"]
    some = looked.filter(met).drop(*inner).withColumn("__own", digest).join(
        chosen, F.col("__own") == F.col("__digest"), "left").withColumns(
        {c: F.coalesce(x, empty(x)) for c, x in added.items()}).drop("__own", "__digest", *added.values())
    return looked.filter(~met).drop(*inner).withColumns({c: empty(x) for c, x in added.items()}).union(some)


def as_text(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    name = lambda s: F.get(F.lit(KINDS), s["kind"])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with ``<kind>`` in place of spans; a span that overlaps an earlier one is hidden with it."""
    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        more = F.array(F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                       F.concat(F.lit("<"), F.get(F.lit(KINDS), s["kind"]), F.lit(">")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], F.concat(acc["out"], more)).otherwise(acc["out"]).alias("out"))

    def close(acc: Column) -> Column:
        return F.concat(F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.char_length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, none, step, close))


def redacted_docs(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with personal data hidden in ``text`` and ``n_chars`` counted anew."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.coalesce("text", F.lit("")).alias("body"))
    hidden = with_spans(row, "body").select("row", redacted(F.col("body"), F.col("all")).alias("body"), (F.size("all") > 0).alias("any"))
    changed = {"text": F.when(F.col("any"), F.col("body")).otherwise(F.col("row.text")),
               "n_chars": F.when(F.col("any"), F.char_length("body").cast("long")).otherwise(F.col("row.n_chars"))}
    return hidden.select(*[changed[c].alias(c) if c in changed else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
