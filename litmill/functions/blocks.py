"""Matching blocks of two sequences as ``difflib`` finds them, without its
quadratic cost where elements are frequent.

The longest block is found by its length: runs of each power of two get a number,
equal runs the same one, so runs of any length are told by two numbers, and
whether any of a length is common takes two sorted arrays. Among the longest the
first of the left side and of the right side wins, which is ``difflib``'s choice
too, so blocks, their order and what is derived from them are the same.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Sequence

import numpy as np


class Blocks(difflib.SequenceMatcher):
    """``SequenceMatcher`` without junk whose search goes by arrays where that takes less."""

    def __init__(self, a: Sequence, b: Sequence):
        super().__init__(None, a, b, autojunk=False)
        places = {x: len(p) for x, p in self.b2j.items()}
        self.work = np.concatenate(([0], np.cumsum([places.get(x, 0) for x in a], dtype=np.int64)))
        self.runs: list[np.ndarray] = []

    def _runs(self, k: int) -> np.ndarray:
        """Numbers of the runs of ``2**k`` elements that begin at each place of both sides."""
        if not self.runs:
            numbers: dict = {}
            self.runs.append(np.fromiter((numbers.setdefault(x, len(numbers)) for side in (self.a, self.b) for x in side), np.int64))
        while len(self.runs) <= k:
            last, step = self.runs[-1], 1 << len(self.runs) - 1
            pairs = last[:-step] * (len(self.a) + len(self.b)) + last[step:]
            self.runs.append(np.unique(pairs, return_inverse=True)[1].astype(np.int64))
        return self.runs[k]

    def find_longest_match(self, alo=0, ahi=None, blo=0, bhi=None):
        ahi, bhi = len(self.a) if ahi is None else ahi, len(self.b) if bhi is None else bhi
        if self.work[ahi] - self.work[alo] <= 4 * (ahi - alo + bhi - blo) + 2000:
            return super().find_longest_match(alo, ahi, blo, bhi)
        n = len(self.a)

        def keys(size: int) -> tuple[np.ndarray, np.ndarray]:
            k = size.bit_length() - 1
            runs, rest = self._runs(k), size - (1 << k)
            side = lambda low, high: runs[low : high - size + 1] * (n + len(self.b)) + runs[low + rest : high - size + 1 + rest]
            return side(alo, ahi), side(n + blo, n + bhi)

        def common(size: int) -> tuple[int, int] | None:
            left, right = keys(size)
            met = np.isin(left, right)
            i = int(met.argmax())
            return (i, int((right == left[i]).argmax())) if met[i] else None

        best, size, most = None, 0, min(ahi - alo, bhi - blo)
        low, high = 1, most + 1  # the first size that may hold, the first known not to
        while low < high:
            asked = min(2 * size or 1, most) if high > most else (low + high) // 2
            found = common(asked)
            if found is None:
                high = asked
            else:
                best, size, low = found, asked, asked + 1
        return difflib.Match(alo + best[0], blo + best[1], size) if best else difflib.Match(alo, blo, 0)


def matching_share(a: str, b: str) -> float:
    """``SequenceMatcher.ratio``. No block crosses a sign that the other text
    lacks, so a run of such signs counts as one."""
    shared = set(a) & set(b)
    if not shared:
        return 0.0
    taken = shared | set(a) | set(b)
    lone = [c for c in map(chr, range(0xE000, 0xE000 + 2 + len(taken))) if c not in taken][:2]
    foreign = re.compile("[^" + "".join(map(re.escape, sorted(shared))) + "]+")
    x, y = (foreign.sub(lambda _: sign, text) for sign, text in zip(lone, (a, b)))
    return 2.0 * sum(m.size for m in Blocks(x, y).get_matching_blocks()) / (len(a) + len(b))
