"""Vectorised word hashing shared by the operators of this subpackage.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D of the UTF-8 text.  All functions
work on a whole Arrow batch at once, so the cost is a few machine operations a byte and no Python
object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CHUNK = 1 << 20

_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64, kept for the next call while it is small."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1024, 1 << (n - 1).bit_length())
        step = np.full(size, base, np.uint64)
        step[0] = 1
        have = np.multiply.accumulate(step)
        if size <= 2 * _CHUNK:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, a bijection that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * _MIX1
    h ^= h >> np.uint64(27)
    h = h * _MIX2
    h ^= h >> np.uint64(31)
    return h


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


class Words:
    """The words of several texts: `start` and `end` are byte places in `data`, `bounds` has for
    text i the words bounds[i]:bounds[i + 1]."""

    def __init__(self, texts: Iterable[bytes | str | None], lower: bool = False):
        raw = [t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        self.n = len(raw)
        self.data = np.frombuffer(b" ".join([*raw, b""]) if raw else b"", np.uint8)
        sizes = np.fromiter(map(len, raw), np.int64, self.n) + 1
        self.text_start = np.concatenate(([0], np.cumsum(sizes)))
        space = _SPACE[self.data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1 if len(space) else np.zeros(0, np.int64)
        if len(space) and not space[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[0::2], edge[1::2]
        self.bounds = np.searchsorted(self.start, self.text_start)
        if lower:
            self.data = _LOWER[self.data]

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owner(self) -> np.ndarray:
        """For each word the number of its text."""
        return np.repeat(np.arange(self.n), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word: a polynomial of scrambled bytes, mixed with the length."""
        out = np.empty(len(self.start), np.uint64)
        at = 0
        while at < len(self.start):
            low = self.start[at]
            to = max(at + 1, int(np.searchsorted(self.end, low + _CHUNK, "right")))
            a, b = self.start[at:to] - low, self.end[at:to] - low
            m = int(b[-1])
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[self.data[low : low + m]] * _power(_BASE, m), dtype=np.uint64)))
            out[at:to] = (total[b] - total[a]) * _power(_INVERSE, m + 1)[a] + (b - a).astype(np.uint64) * _ODD
            at = to
        return mix(out)


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n word hashes; len(h) - n + 1 of them, across the bounds of texts too."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    factor = 1
    for k in range(n):
        out += h[k : k + m] * np.uint64(factor)
        factor = factor * 0xC2B2AE3D27D4EB4F % (1 << 64)
    return mix(out)


def inside(bounds: np.ndarray, n: int, total: int) -> np.ndarray:
    """For every window of n words whether it lies within one text."""
    m = max(0, total - n + 1)
    ok = np.zeros(total + 1, np.int32)
    lo, hi = bounds[:-1], np.maximum(bounds[:-1], bounds[1:] - n + 1)
    np.add.at(ok, lo, 1)
    np.add.at(ok, hi, -1)
    return np.cumsum(ok)[:m] > 0


def spread(starts: np.ndarray, n: int, total: int) -> np.ndarray:
    """For every word whether a window of n words that starts at one of `starts` covers it."""
    d = np.zeros(total + 1, np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + n, -1)
    return np.cumsum(d[:total]) > 0
