"""Cover tree over norm-augmented vectors, for windows of inner products.

Every vector gets one more coordinate, the root of ``M**2 - |x|**2`` for a common bound
``M`` of the norms, so that inner products with a query (whose own extra coordinate is 0)
fall as distances grow. A node has a centre and a covering radius: the largest distance of
its vectors from the centre. The centres of its children come from a farthest-first
traversal, so they lie at least the children's covering radius apart, and the radii halve
from level to level unless ``FAN`` children are not enough for that. Centre and
radius bound the inner products of a whole node from both sides.

``search`` descends best-first for a group of queries at once: the nodes with the highest
bounds are opened, a batch at a time; nodes whose bounds lie outside all windows, or
below the ``k`` best that are known, are skipped; the vectors of leaves are verified by
their exact integer products.
"""

from __future__ import annotations

import io

import numpy as np

LEAF = 32
FAN = 16
#: nodes opened at once, and queries that descend together
BATCH, GROUP = 32, 256
LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def augmented(vectors: np.ndarray, bound2: float) -> np.ndarray:
    v = vectors.astype(np.float64)
    return np.concatenate((v, np.sqrt(np.maximum(0.0, bound2 - (v * v).sum(1)))[:, None]), 1)


def distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gap = points - centre
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def farthest_first(points: np.ndarray, most: int, enough: float = 0.0, first: int = 0) -> tuple[list[int], np.ndarray, np.ndarray]:
    """At most ``most`` centres, each the point farthest from those before it, until all points
    are within ``enough``; the nearest centre of every point and its distance."""
    centres, near = [first], distances(points, points[first])
    own = np.zeros(len(points), np.int64)
    while len(centres) < most:
        far = int(near.argmax())
        if near[far] <= enough:
            break
        d = distances(points, points[far])
        closer = d < near
        own[closer], near[closer] = len(centres), d[closer]
        centres.append(far)
    return centres, own, near


def product_bounds(centres: np.ndarray, radius: np.ndarray, queries: np.ndarray, bound2: float) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds (nodes x queries) of the inner products of each node's vectors.
    ``centres`` are augmented, ``queries`` are not; rounding is allowed for."""
    q2 = (queries * queries).sum(1)[None, :]
    inner = centres[:, :-1] @ queries.T
    apart = np.sqrt(np.maximum(0.0, q2 + (centres * centres).sum(1)[:, None] - 2 * inner))
    radius = radius[:, None] * (1 + 1e-9)
    slack = 1e-9 * (q2 + bound2) + 1e-6
    reach = np.sqrt(q2) * radius
    gone = np.maximum(0.0, apart - radius)
    high = np.minimum((q2 + bound2 - gone * gone) / 2, inner + reach) + slack
    low = np.maximum((q2 + bound2 - (apart + radius) ** 2) / 2, inner - reach) - slack
    return low, high


def _narrow(values: np.ndarray) -> np.ndarray:
    most = int(np.abs(values).max()) if values.size else 0
    return values.astype(next(t for t in (np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))


class CoverTree:
    """Vectors in leaf order (``ids``, ``labels``, ``vectors``) and the nodes over them, level by level."""

    FIELDS = ("ids", "labels", "vectors", "bound2", "centre", "radius", "start", "end", "child", "children")

    def __init__(self, **fields):
        for name in self.FIELDS:
            setattr(self, name, fields[name])
        self.bound2 = float(self.bound2)
        self.points = augmented(self.vectors, self.bound2)
        # products and their sums are exact in doubles below 2**53, else in 64-bit integers
        self.exact = self.vectors.astype(np.float64 if self.bound2 < 1 << 53 else np.int64)

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, bound2: float, leaf: int = LEAF, fan: int = FAN) -> CoverTree:
        points = augmented(vectors, bound2)
        order = np.arange(len(ids))
        centre, radius, start, end = [0], [float(distances(points, points[0]).max())], [0], [len(ids)]
        child, children = [], []
        at = 0
        while at < len(centre):  # nodes are numbered level by level
            a, b = start[at], end[at]
            child.append(len(centre))
            if b - a <= leaf or radius[at] == 0:
                children.append(0)
                at += 1
                continue
            own = points[order[a:b]]
            first = int(np.flatnonzero(order[a:b] == centre[at])[0])
            picked, part, near = farthest_first(own, fan, radius[at] / 2, first)
            centre += order[a:b][picked].tolist()
            by_part = np.argsort(part, kind="stable")
            order[a:b] = order[a:b][by_part]
            bounds = np.searchsorted(part[by_part], np.arange(len(picked) + 1))
            for k in range(len(picked)):
                start.append(a + int(bounds[k]))
                end.append(a + int(bounds[k + 1]))
                radius.append(float(near[part == k].max()))
            children.append(len(picked))
            at += 1
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return cls(
            ids=ids[order], labels=labels[order], vectors=_narrow(vectors[order]), bound2=bound2, centre=place[centre], radius=np.array(radius),
            start=np.array(start), end=np.array(end), child=np.array(child), children=np.array(children),
        )

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in self.FIELDS})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> CoverTree:
        with np.load(io.BytesIO(raw)) as found:
            return cls(**{name: found[name] for name in cls.FIELDS})

    def search(self, ids, labels, queries, low, high, k: int, same: bool):
        """For every query and window the ``k`` vectors with the highest products in it (ties to the
        smaller id) whose label is the query's own (``same``) or another; a query's own id is left out.
        ``low`` and ``high`` are (queries x windows) inclusive bounds. Returns query, window, id, score."""
        near = augmented(queries, max(self.bound2, float((queries.astype(np.float64) ** 2).sum(1).max(initial=0.0))))
        tops = self.points[self.centre[1 : 1 + self.children[0]]] if self.children[0] else self.points[self.centre[:1]]
        alike = (near[:, :-1] @ tops[:, :-1].T).argmax(1)  # queries that go the same way descend together
        order = np.argsort(alike, kind="stable")
        parts = []
        for a in range(0, len(order), GROUP):
            own = order[a : a + GROUP]
            q, w, i, s = self._descend(ids[own], labels[own], queries[own], low[own], high[own], k, same)
            parts.append((own[q], w, i, s))
        return [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 4

    def _descend(self, ids, labels, queries, low, high, k, same):
        n, windows = low.shape
        best = _Best(low, high, k)
        q = queries.astype(np.float64)
        exact = q if self.exact.dtype == np.float64 else queries.astype(np.int64)
        lows, highs = np.full((len(self.centre), n), -np.inf), np.full((len(self.centre), n), np.inf)
        lows[:1], highs[:1] = product_bounds(self.points[self.centre[:1]], self.radius[:1], q, self.bound2)
        waiting = np.zeros(1, np.int64)
        while len(waiting):
            open_ = best.open_to(lows[waiting], highs[waiting])
            alive = open_.any(1)
            waiting, open_ = waiting[alive], open_[alive]
            if not len(waiting):
                break
            key = np.where(open_, np.minimum(highs[waiting], best.cap[None, :]), -np.inf).max(1)
            chosen = np.argsort(-key, kind="stable")[:BATCH]
            taken = waiting[chosen]
            waiting = np.delete(waiting, chosen)
            inner = taken[self.children[taken] > 0]
            leaves = taken[self.children[taken] == 0]
            if len(leaves):
                at = np.concatenate([np.arange(a, b) for a, b in zip(self.start[leaves].tolist(), self.end[leaves].tolist(), strict=True)])
                who = np.flatnonzero(open_[chosen[self.children[taken] == 0]].any(0))
                scores = (self.exact[at] @ exact[who].T).astype(np.int64)
                fits = (self.labels[at][:, None] == labels[who][None, :]) == same
                fits &= self.ids[at][:, None] != ids[who][None, :]
                best.add(who, self.ids[at], scores, fits)
            if len(inner):
                below = np.concatenate([np.arange(c, c + m) for c, m in zip(self.child[inner].tolist(), self.children[inner].tolist(), strict=True)])
                lows[below], highs[below] = product_bounds(self.points[self.centre[below]], self.radius[below], q, self.bound2)
                waiting = np.concatenate((waiting, below))
        return best.rows()


class _Best:
    """The ``k`` best of every query and window so far."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.k, self.high = k, high
        n, self.windows = low.shape
        self.floor = np.where(low <= high, low, HIGHEST)  # the least score that still counts
        self.scores = np.zeros((n, self.windows, k), np.int64)
        self.ids = np.zeros((n, self.windows, k), np.int64)
        self.count = np.zeros((n, self.windows), np.int64)
        self.cap = np.where(low <= high, high, LOWEST).max(1).astype(np.float64)

    def open_to(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Nodes x queries: a window may still take a vector of the node."""
        out = np.zeros(low.shape, bool)
        for w in range(self.windows):
            shut = self.floor[:, w] > self.high[:, w]
            out |= (high >= self.floor[None, :, w]) & (low <= self.high[None, :, w]) & ~shut[None, :]
        return out

    def add(self, who: np.ndarray, ids: np.ndarray, scores: np.ndarray, fits: np.ndarray) -> None:
        for w in range(self.windows):
            ok = fits & (scores >= self.floor[who, w][None, :]) & (scores <= self.high[who, w][None, :])
            if len(ids) > 2 * self.k and ok.any():  # only the k best of a column, and their ties, can enter
                masked = np.where(ok, scores, LOWEST)
                ok &= masked >= np.partition(masked, len(ids) - self.k, axis=0)[len(ids) - self.k][None, :]
            point, column = np.nonzero(ok)
            if not len(point):
                continue
            touched = np.unique(who[column])
            mine = np.arange(self.k)[None, :] < self.count[touched, w][:, None]
            query = np.concatenate((who[column], np.repeat(touched, mine.sum(1))))
            score = np.concatenate((scores[point, column], self.scores[touched, w][mine]))
            id_ = np.concatenate((ids[point], self.ids[touched, w][mine]))
            order = np.lexsort((id_, -score, query))
            query, score, id_ = query[order], score[order], id_[order]
            rank = np.arange(len(query)) - np.searchsorted(query, query)
            top = rank < self.k
            self.scores[query[top], w, rank[top]], self.ids[query[top], w, rank[top]] = score[top], id_[top]
            self.count[touched, w] = np.minimum(self.k, np.bincount(query, minlength=touched[-1] + 1)[touched])
            full = touched[self.count[touched, w] == self.k]
            self.floor[full, w] = np.maximum(self.floor[full, w], self.scores[full, w, self.k - 1])

    def rows(self):
        query, window, place = np.nonzero(np.arange(self.k)[None, None, :] < self.count[:, :, None])
        return query, window, self.ids[query, window, place], self.scores[query, window, place]
