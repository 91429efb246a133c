"""Sets of five-word shingles as sorted 64-bit hashes, by arrays."""

from __future__ import annotations

import numpy as np

from litmill.llm.common import LOWER, SPACE

WORDS = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd and 5 modulo 8, so powers stay apart in all but the lowest bits
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_OF_BYTE = np.random.default_rng(20_240_607).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE)] = True
_powers = {"base": np.ones(1, np.uint64), "inverse": np.ones(1, np.uint64)}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers[name]) < n:
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[0] = 1
        _powers[name] = np.multiply.accumulate(out)
    return _powers[name][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(text: bytes) -> np.ndarray:
    """A hash for each run of bytes that are no ASCII white space, A-Z as a-z."""
    data = np.frombuffer(text.translate(LOWER), np.uint8)
    edge = np.empty(len(data) + 2, bool)
    edge[0] = edge[-1] = True
    np.take(_IS_SPACE, data, out=edge[1:-1])
    change = np.flatnonzero(edge[1:] != edge[:-1])
    start, end = change[::2], change[1::2]
    if not len(start):
        return np.empty(0, np.uint64)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_OF_BYTE[data] * _power("base", _BASE, len(data)), out=sums[1:])
    return mix((sums[end] - sums[start]) * _power("inverse", _INVERSE, len(data))[start])


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    """Distinct shingles, sorted; all words as one where there are fewer."""
    w = word_hashes(text)
    if not len(w):
        return w
    k = min(words, len(w))
    out = w[: len(w) - k + 1].copy()
    for i in range(1, k):
        out = mix(out * np.uint64(3)) + w[i : len(w) - k + 1 + i]
    return np.unique(mix(out + np.uint64(k)))
