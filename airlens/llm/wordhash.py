"""64-bit hashes of the words of many texts at once, in numpy.

A word's hash is a polynomial over 2**64 in random byte values, mixed with
its length; all words of a run of texts come from one prefix sum, so the
cost is a few nanoseconds a byte and independent of the vocabulary.
"""

from __future__ import annotations

import numpy as np

from airlens.llm.common import HELD

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Word separators: ASCII white space; every ASCII byte but 0-9 and a-z.
SPACE_SEP = np.zeros(256, bool)
SPACE_SEP[[0x20, *range(0x09, 0x0E)]] = True
ALNUM_SEP = np.zeros(256, bool)
ALNUM_SEP[:0x80] = True
ALNUM_SEP[0x30:0x3A] = False
ALNUM_SEP[0x61:0x7B] = False


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE**i and its inverse for i < n, modulo 2**64."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("_POWERS", _BASE), ("_INVERSES", _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            globals()[name] = np.multiply.accumulate(p)
    return _POWERS[:n], _INVERSES[:n]


def _forget() -> None:
    global _POWERS, _INVERSES
    _POWERS = _INVERSES = np.ones(1, np.uint64)


HELD["powers"] = _forget


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer on uint64."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix sums for ``span_hashes``; ``data`` is uint8."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(len(data))[0], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for arrays of spans."""
    inverse = powers(max(len(prefix), 1))[1]
    raw = (prefix[end] - prefix[start]) * inverse[start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(prefix: np.ndarray, k: int) -> np.ndarray:
    """``span_hashes`` of every span of ``k`` bytes."""
    m = max(len(prefix) - k, 0)
    raw = (prefix[k:] - prefix[:m]) * powers(max(len(prefix), 1))[1][:m]
    return mix(raw + np.uint64(k * 0xD6E8FEB86659FD93 & (1 << 64) - 1))


class Words:
    """The words of a run of texts: ``hash`` per word, ``doc`` its text's
    number, ``first[i]:first[i+1]`` the words of text i; ``start``, ``end``
    are byte spans in ``data``."""

    def __init__(self, texts: list[bytes], separators: np.ndarray):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        data = LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)] if texts else np.zeros(0, np.uint8)
        inside = np.zeros(len(data) + 1, np.int8)
        inside[1:] = ~separators[data]
        change = np.diff(inside)
        self.data = data
        self.start = np.flatnonzero(change == 1)
        self.end = np.flatnonzero(change == -1)
        # A text ends with the joining space, so no word spans two texts and
        # every word has its end.
        self.offset = np.concatenate(([0], np.cumsum(sizes)))
        self.first = np.searchsorted(self.start, self.offset)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.count)
        self.hash = span_hashes(prefix_hashes(data), self.start, self.end)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes (over text borders too)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = out * np.uint64(_BASE) + words[k:k + m]
    return mix(out + np.uint64(n))
