"""Longest common blocks of two sequences, found without comparing element by element.

The standard matcher looks at every pair of equal elements, so texts whose elements repeat (the
characters of any text, blank lines of a long one) take it the product of their lengths. Here windows
of 1, 2, 4, ... elements are numbered, equal windows alike, by one sort a length, until no window of
one text is in the other. The longest block that two ranges share is then found from these numbers by
doubling and halving: a range takes n log n steps, whatever repeats in it. Blocks, their order and all that
follows from them (opcodes, ratios) are the standard matcher's without its junk rules.
"""

from __future__ import annotations

import difflib
from collections.abc import Sequence

import numpy as np

#: Products of lengths up to this one go to the standard matcher, which is faster there and gives the same.
SMALL = 40_000


def _numbers(a: Sequence, b: Sequence) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(a, str) and isinstance(b, str):
        return tuple(np.frombuffer(x.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64) for x in (a, b))
    known: dict = {}
    return tuple(np.fromiter((known.setdefault(x, len(known)) for x in s), np.int64, len(s)) for s in (a, b))


def _dense(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1]


class Matcher(difflib.SequenceMatcher):
    """A SequenceMatcher without junk, whose longest matches are found by numbered windows."""

    def __init__(self, a: Sequence, b: Sequence):
        super().__init__(None, "", "", autojunk=False)
        self.a, self.b, self.shift = a, b, len(a) + 1
        x, y = _numbers(a, b)
        both = _dense(np.concatenate([x, [-1], y]))  # what stands between them is in no match
        self.windows = [both]
        width = 1
        while len(both) > width and self._common(both, width):
            both = _dense(both[:-width] * (int(both.max()) + 1) + both[width:])
            width *= 2
            self.windows.append(both)

    def _common(self, numbers: np.ndarray, width: int) -> bool:
        left, right = numbers[: max(0, self.shift - width)], numbers[self.shift :]
        seen = np.zeros(int(numbers.max()) + 1, bool)
        seen[right] = True
        return bool(seen[left].any())

    def _shared(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of two sets of numbers are in the other one."""
        most = max(int(left.max(initial=0)), int(right.max(initial=0))) + 1
        in_left, in_right = np.zeros(most, bool), np.zeros(most, bool)
        in_left[left], in_right[right] = True, True
        return in_right[left], in_left[right]

    def find_longest_match(self, alo: int = 0, ahi: int | None = None, blo: int = 0, bhi: int | None = None) -> difflib.Match:
        """The longest block of a[alo:ahi] and b[blo:bhi]; of several the first in a, then in b."""
        ahi, bhi = len(self.a) if ahi is None else ahi, len(self.b) if bhi is None else bhi
        size, level = 0, -1
        left = right = left_ids = right_ids = np.zeros(0, np.int64)
        for k, numbers in enumerate(self.windows):  # the largest power of two that both ranges share
            width = 1 << k
            if alo + width > ahi or blo + width > bhi:
                break
            x, y = numbers[alo : ahi - width + 1], numbers[self.shift + blo : self.shift + bhi - width + 1]
            in_x, in_y = self._shared(x, y)
            if not in_x.any():
                break
            size, level = width, k
            left, right = alo + np.flatnonzero(in_x), blo + np.flatnonzero(in_y)
            left_ids, right_ids = x[in_x], y[in_y]
        if not size:
            return difflib.Match(alo, blo, 0)
        for k in range(level - 1, -1, -1):  # then longer by smaller powers, from what is shared so far
            width = 1 << k
            fit_x, fit_y = left + size + width <= ahi, right + size + width <= bhi
            if not fit_x.any() or not fit_y.any():
                continue
            x, y = left[fit_x], right[fit_y]
            step = int(self.windows[k].max()) + 1
            keys = _dense(np.concatenate([left_ids[fit_x] * step + self.windows[k][x + size], right_ids[fit_y] * step + self.windows[k][self.shift + y + size]]))
            of_x, of_y = keys[: len(x)], keys[len(x) :]
            in_x, in_y = self._shared(of_x, of_y)
            if in_x.any():
                size, left, right, left_ids, right_ids = size + width, x[in_x], y[in_y], of_x[in_x], of_y[in_y]
        return difflib.Match(int(left[0]), int(right[np.flatnonzero(right_ids == left_ids[0])[0]]), size)


def matcher(a: Sequence, b: Sequence) -> difflib.SequenceMatcher:
    """The matcher that suits the lengths."""
    return difflib.SequenceMatcher(None, a, b, autojunk=False) if len(a) * len(b) <= SMALL else Matcher(a, b)
