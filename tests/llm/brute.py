"""Plain implementations that the operators are compared with."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def rule_counts(text: str | None) -> dict:
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + d for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated), "base_failed": failed}


def kept_by_rules(text: str | None, rules, stop_words) -> bool:
    counts = rule_counts(text)
    words = WORD.findall(text or "")
    counts["n_stop_words"] = sum(w.lower().rstrip(".,") in stop_words for w in words)
    counts["n_lines"] = sum(bool(WORD.search(x)) for x in (text or "").split("\n"))
    shares = [(100 * counts[r.part], counts[r.whole], r) for r in rules]
    return not counts["base_failed"] and all(
        (r.least is None or a >= r.least * b) and (r.most is None or a <= r.most * b) for a, b, r in shares)


def shingles(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def components(rows: list[tuple[int, str | None]]) -> list[int]:
    """The smallest id that each row reaches by links."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    smallest: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(rows):
        known = [x for x in (smallest.get(find(i)), doc_id) if x is not None]
        smallest[find(i)] = min(known) if known else None
    return [smallest[find(i)] for i in range(len(rows))]


def repeated_runs(texts: list[bytes], length: int = 200) -> list[list[tuple[int, int]]]:
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        runs: list[list[int]] = []
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + length
                else:
                    runs.append([i, i + length])
        out.append([tuple(r) for r in runs])
    return out


def rest_of(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    gone = {i for a, b in runs for i in range(a, b)}
    return bytes(c for i, c in enumerate(data) if i not in gone)


def luhn(digits: str) -> bool:
    twice = [sum(divmod(2 * int(c), 10)) for c in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(twice)) % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int, str]]:
    """Start, number of the kind, end, kind."""
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)
