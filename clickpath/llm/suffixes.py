"""Hash-compared suffix sort.

``sort`` orders positions of a byte string by the text that extends from them,
forward or backward, with a merge sort. Two positions are compared through
prefix polynomial hashes: binary search finds their common extension in a
logarithmic number of steps, and the byte behind it decides. All comparisons
of a merge level run as one vectorised step. The result is verified against
the bytes; after a hash collision another base is tried, and at last the bytes
themselves are sorted.
"""

from __future__ import annotations

import numpy as np

from clickpath.llm.common import PrefixHash


class _Comparer:
    def __init__(self, data: np.ndarray, at: np.ndarray, length: np.ndarray, forward: bool, seed: int):
        self.data, self.at, self.length, self.forward = data, at, length, forward
        self.hash = PrefixHash(data, seed)

    def _extension_hash(self, items: np.ndarray, n: np.ndarray) -> np.ndarray:
        p = self.at[items]
        return self.hash.segments(p, p + n) if self.forward else self.hash.segments(p - n, p)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of every pair, by binary search."""
        low = np.zeros(len(a), np.int64)
        high = np.minimum(self.length[a], self.length[b])
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            mid = (low[open_] + high[open_] + 1) >> 1
            same = self._extension_hash(a[open_], mid) == self._extension_hash(b[open_], mid)
            low[open_[same]] = mid[same]
            high[open_[~same]] = mid[~same] - 1

    def next_byte(self, items: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The byte behind ``n`` common ones; -1 at the end of the extension."""
        ended = n >= self.length[items]
        p = self.at[items] + (n if self.forward else -1 - n)
        p[ended] = 0
        out = self.data[p].astype(np.int64)
        out[ended] = -1
        return out

    def below(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """a sorts before b; equal extensions are not below each other."""
        n = self.common(a, b)
        return self.next_byte(a, n) < self.next_byte(b, n)


def _merge_sort(c: _Comparer) -> np.ndarray:
    n = len(c.at)
    order = np.arange(n)
    place = np.arange(n)
    width = 1
    while width < n:
        own = place // width  # run of each slot
        other = own ^ 1
        low = np.minimum(other * width, n)
        high = np.minimum(low + width, n)
        first = low.copy()
        left = own % 2 == 0
        while True:  # rank of every item in its sibling run
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) >> 1
            mine, theirs = order[open_], order[mid]
            lefts = left[open_]
            # a stable merge: items of the left run go before equal ones of the right run
            after = np.where(lefts, c.below(theirs, mine), ~c.below(mine, theirs))
            low[open_[after]] = mid[after] + 1
            high[open_[~after]] = mid[~after]
        start = np.minimum(own, other) * width
        target = start + (place - own * width) + (low - first)
        merged = np.empty(n, np.int64)
        merged[target] = order
        order = merged
        width *= 2
    return order


def _extension(data: bytes, at: int, n: int, forward: bool) -> bytes:
    return data[at : at + n] if forward else data[at - n : at][::-1]


def _verified(data: bytes, c: _Comparer, order: np.ndarray, common: np.ndarray) -> bool:
    at, length = c.at.tolist(), c.length.tolist()
    for i, j, n in zip(order[:-1].tolist(), order[1:].tolist(), common[1:].tolist(), strict=True):
        a, b = _extension(data, at[i], length[i], c.forward), _extension(data, at[j], length[j], c.forward)
        if a[:n] != b[:n] or a[n : n + 1] > b[n : n + 1] or (n < min(len(a), len(b)) and a[n] == b[n]):
            return False
    return True


def sort(data: np.ndarray, at: np.ndarray, length: np.ndarray, forward: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Order of the extensions of ``length`` bytes at ``at`` and, for each sorted
    place, the common extension with the place before it (0 for the first)."""
    raw = data.tobytes()
    for seed in (0, 1):
        c = _Comparer(data, at, length, forward, seed)
        order = _merge_sort(c)
        common = np.zeros(len(order), np.int64)
        common[1:] = c.common(order[:-1], order[1:])
        if _verified(raw, c, order, common):
            return order, common
    texts = [_extension(raw, a, n, forward) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
    order = np.array(sorted(range(len(texts)), key=texts.__getitem__), np.int64)
    common = np.zeros(len(order), np.int64)
    for k in range(1, len(order)):
        a, b = texts[order[k - 1]], texts[order[k]]
        differ = np.flatnonzero(np.frombuffer(a[: len(b)], np.uint8) != np.frombuffer(b[: len(a)], np.uint8))
        common[k] = differ[0] if len(differ) else min(len(a), len(b))
    return order, common
