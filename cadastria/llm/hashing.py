"""Vectorised hashes of words and byte strings in Arrow string columns.

A string's hash is a polynomial over a random value for each byte, so that of any substring follows from
prefix sums; a final mix spreads its bits. It is taken modulo two primes near 2^31, 62 bits together: no two strings are alike for
every base, as there are such modulo a power of two. ``quick_hashes`` are modulo 2^64; equal strings have equal ones, no more is
promised. All values are fixed by ``SEED``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SEED = 20_011
#: Bytes that are hashed at once; the working arrays are a few tens of times that.
BLOCK = 1 << 20

_random = np.random.Generator(np.random.PCG64(SEED))
#: Primes that products of two remainders fit 64 bits for.
PRIMES = (2_147_483_647, 2_147_483_629)
#: By prime: a value for each byte, and the base.
VALUES = [_random.integers(1, p, 256) for p in PRIMES]
BASES = [int(_random.integers(1 << 20, p)) for p in PRIMES]
QUICK_VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
QUICK_BASE = int(_random.integers(1 << 40, 1 << 61)) * 8 + 5
STEPS = _random.integers(1 << 40, 1 << 62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of a base modulo a prime, as many as were asked for so far."""

    def __init__(self, base: int, prime: int) -> None:
        self.prime, self.known, self.next = prime, np.ones(1, np.int64), base

    def __call__(self, n: int) -> np.ndarray:
        while len(self.known) < n:
            self.known = np.concatenate([self.known, self.known * self.next % self.prime])
            self.next = self.next * self.next % self.prime
        return self.known[:n]


UP = [Powers(b, p) for b, p in zip(BASES, PRIMES)]
DOWN = [Powers(pow(b, -1, p), p) for b, p in zip(BASES, PRIMES)]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """By prime, prefix sums one longer than ``data``, for ``span_hashes``. They fit 64 bits for 2^32 bytes."""
    out = np.zeros((len(PRIMES), len(data) + 1), np.int64)
    for row, values, up, prime in zip(out, VALUES, UP, PRIMES):
        np.cumsum(values[data] * up(len(data)) % prime, out=row[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    a, b = ((row[end] - row[start]) % p * down(prefix.shape[1])[start] % p for row, down, p in zip(prefix, DOWN, PRIMES))
    return mix((a.astype(np.uint64) << np.uint64(31)) | b.astype(np.uint64))


class QuickPowers:
    """Powers of ``QUICK_BASE`` and of its inverse, as many as were asked for so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(n - 1, b, np.uint64)])
                                  for b in (QUICK_BASE, pow(QUICK_BASE, -1, 1 << 64)))


QUICK = QuickPowers()


def quick_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all strings of ``width`` bytes."""
    QUICK.need(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(QUICK_VALUES[data] * QUICK.up[:len(data)], out=prefix[1:])
    return mix((prefix[width:] - prefix[:-width]) * QUICK.down[:len(data) - width + 1])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column without nulls, and where each value begins, with the end."""
    wide = column.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset:wide.offset + len(wide) + 1]
    held = wide.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and the first word of each text, with the end."""
    data, offsets = utf8(column)
    inside = ~IS_WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK, side="right")))
        base = starts[at]
        prefix = prefix_hashes(LOWER[data[base:ends[to - 1]]])
        hashes[at:to] = span_hashes(prefix, starts[at:to] - base, ends[at:to] - base)
        at = to
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; a shorter text is one shingle, one without words has none."""
    hashes, first = word_hashes(column)
    rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for k in range(words):
        rolled += hashes[k:k + len(rolled)] * STEPS[k]
    rolled = mix(rolled)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= words:
            out.append(np.unique(rolled[a:b - words + 1]))
        elif b > a:
            whole = np.sum(hashes[a:b] * STEPS[:b - a]) + np.uint64(b - a)
            out.append(mix(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
