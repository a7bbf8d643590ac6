"""Is the matching-block similarity of two texts above a threshold?  The answer of difflib, without its full walk."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np

POINTS = 1 << 20  # places where rare letters of both texts are equal that are held at once
RARE_FROM = 200  # texts from this length on are anchored at rare letters only, as in difflib


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _equal_start(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the common start."""
    n, at, step = min(len(x), len(y)), 0, 32
    while at < n:
        differ = x[at:min(at + step, n)] != y[at:min(at + step, n)]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, step * 4
    return n


class Anchors:
    """The places (i, j) where a rare letter of ``b`` stands in both texts, and how long equal ones run up to there."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.a, self.b = a, b
        order = np.argsort(b, kind="stable")
        letters, first, count = np.unique(b[order], return_index=True, return_counts=True)
        if len(b) >= RARE_FROM:
            rare = count <= len(b) // 100 + 1
            letters, first, count = letters[rare], first[rare], count[rare]
        # one letter more that no text has, so that there is always one to look up
        letters, first, count = np.append(letters, np.uint32(0xFFFFFFFF)), np.append(first, 0), np.append(count, 0)
        slot = np.searchsorted(letters, a)
        own = letters[slot] == a
        each = np.where(own, count[slot], 0)
        self.begin = np.concatenate([[0], np.cumsum(each)])
        self.size = int(self.begin[-1])
        if self.size > POINTS:
            return
        self.i = np.repeat(np.arange(len(a)), each)
        self.j = order[np.repeat(first[slot] - self.begin[:-1], each) + np.arange(self.size)]
        self.run = np.ones(self.size, dtype=np.int64)
        later = np.flatnonzero((self.i > 0) & (self.j > 0))
        later = later[own[self.i[later] - 1] & (a[self.i[later] - 1] == b[self.j[later] - 1])]
        if len(later):
            i, diagonal = self.i[later], self.j[later] - self.i[later]
            by = np.lexsort((i, diagonal))
            i, diagonal, at = i[by], diagonal[by], np.arange(len(by))
            fresh = np.append(True, (diagonal[1:] != diagonal[:-1]) | (i[1:] != i[:-1] + 1))
            self.run[later[by]] = 2 + at - np.maximum.accumulate(np.where(fresh, at, 0))

    def longest(self, alo: int, ahi: int, blo: int, bhi: int) -> tuple[int, int, int]:
        """``SequenceMatcher.find_longest_match``: the longest run of rare letters, the first of equals, widened by any equal letters."""
        i, j, k = alo, blo, 0
        start, stop = self.begin[alo], self.begin[ahi]
        js = self.j[start:stop]
        inside = np.flatnonzero((js >= blo) & (js < bhi))
        if len(inside):
            rows, cols = self.i[start + inside], js[inside]
            size = np.minimum(np.minimum(self.run[start + inside], rows - (alo - 1)), cols - (blo - 1))
            best = size.argmax()
            k = int(size[best])
            i, j = int(rows[best]) - k + 1, int(cols[best]) - k + 1
        back = _equal_start(self.a[alo:i][::-1], self.b[blo:j][::-1])
        i, j, k = i - back, j - back, k + back
        return i, j, k + _equal_start(self.a[i + k:ahi], self.b[j + k:bhi])


def alike(x: str, y: str, threshold: float) -> bool:
    """``SequenceMatcher(None, x, y).ratio() > threshold``.

    The blocks found so far are a lower bound of the matching letters, and with the shorter side
    of every open range an upper one: the walk ends as soon as either decides.
    """
    total = len(x) + len(y)
    if not total:
        return threshold < 1.0

    def above(matching: int) -> bool:
        return 2.0 * matching / total > threshold

    sure, most = 0, min(len(x), len(y))
    if not above(most):
        return False
    anchors = Anchors(_codes(x), _codes(y))
    longest = anchors.longest if anchors.size <= POINTS else SequenceMatcher(None, x, y).find_longest_match
    open_ranges = [(0, len(x), 0, len(y))]
    while open_ranges:
        alo, ahi, blo, bhi = open_ranges.pop()
        i, j, k = longest(alo, ahi, blo, bhi)
        most -= min(ahi - alo, bhi - blo)
        if k:
            sure += k
            most += k + min(i - alo, j - blo) + min(ahi - i - k, bhi - j - k)
            if above(sure):
                return True
            open_ranges += [r for r in ((alo, i, blo, j), (i + k, ahi, j + k, bhi)) if r[0] < r[1] and r[2] < r[3]]
        if not above(most):
            return False
    return above(sure)
