"""A cover tree for inner products, with whole-number vectors.

Points are lifted to a sphere: a further coordinate sqrt(M² - |x|²) gives each the length M of
the longest, and a query, lifted by 0, keeps its inner products.  A node covers its points with
a cone around its centre, one of them: the angle to its farthest point.  Its children's centres
are a net of its points at half that distance (its own centre first, then the farthest point
left; at most ``FAN`` a node, whose covering angle is then what it is).

With the angle t between query and centre and the covering angle r, every score in a node lies
between |q| M cos(t + r) and |q| M cos(t - r).  ``search`` goes down level by level, skips nodes
outside all windows of scores, then takes a query's leaves best bound first, skips those
below what each window has found, and computes the scores of a leaf's points exactly.
"""

from __future__ import annotations

import io

import numpy as np

#: Points of a leaf, and children of a node, at most.
LEAF = 256
FAN = 16
#: Angles are trusted to so much; it loosens the bounds, never the scores.
SLACK = 1e-7


def lift(x: np.ndarray, longest: float) -> np.ndarray:
    """Unit vectors of the points on the sphere of the longest (of length 1 if all are zero)."""
    x = np.asarray(x, np.float64)
    if longest == 0:
        return np.hstack([x, np.ones((len(x), 1))])
    x = x / longest
    return np.hstack([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1, keepdims=True)))])


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def net(lifted: np.ndarray, most: int, cosine: float = 2.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres (the first row first, then always the farthest point) until every point is within
    the angle of ``cosine`` or there are ``most``; each point's centre and its cosine with it."""
    centres, owner, best = [0], np.zeros(len(lifted), np.int64), lifted @ lifted[0]
    while len(centres) < most:
        far = int(np.argmin(best))
        if best[far] >= min(cosine, 1.0 - 1e-14):
            break
        new = lifted @ lifted[far]
        closer = new > best
        closer[far] = True
        owner[closer], best = len(centres), np.where(closer, new, best)
        centres.append(far)
    return np.array(centres), owner, best


def build(x: np.ndarray, labels: np.ndarray, ids: np.ndarray, names: np.ndarray, longest: float) -> bytes:
    """The tree of points x (n x d whole numbers) as bytes; ids: the least ids of equal rows,
    filled up with the largest long."""
    lifted = lift(x, longest)
    order, centre, reach, first, last, leaf = [], [], [], [], [], []
    todo = [np.arange(len(x))]
    while todo:  # level by level, so that children follow each other
        below: list[np.ndarray] = []
        done = len(centre) + len(todo)
        for rows in todo:
            near = lifted[rows] @ lifted[rows[0]]
            wide = float(angles(near.min()))
            centre.append(int(rows[0]))
            reach.append(wide + SLACK)
            if len(rows) <= LEAF or wide < SLACK:
                leaf.append(True)
                first.append(sum(map(len, order)))
                order.append(rows)
                last.append(first[-1] + len(rows))
                continue
            most = min(FAN, 2 * -(-len(rows) // LEAF))
            heads, owner, _ = net(lifted[rows], most, float(np.cos(wide / 2)))
            parts = [rows[owner == k] for k in range(len(heads))]
            parts = [np.concatenate([[rows[h]], part[part != rows[h]]]) for h, part in zip(heads, parts)]  # its centre first
            leaf.append(False)
            first.append(done + len(below))
            below += parts
            last.append(done + len(below))
        todo = below
    at = np.concatenate(order) if order else np.zeros(0, np.int64)
    out = io.BytesIO()
    np.savez(out, x=x[at], labels=labels[at], ids=ids[at], names=names[at], centre=lifted[centre], reach=np.array(reach),
             first=np.array(first), last=np.array(last), leaf=np.array(leaf), longest=np.array(longest))
    return out.getvalue()


class Tree:
    def __init__(self, data: bytes):
        with np.load(io.BytesIO(data)) as f:
            for k in f.files:
                setattr(self, k, f[k])
        self.real = self.x.astype(np.float64) if float(np.abs(self.x).max(initial=0)) < 2.0**52 else None

    def scores(self, lo: int, hi: int, queries: np.ndarray) -> np.ndarray:
        """Exact inner products of queries with points lo..hi: in doubles where every sum fits, else in longs."""
        if self.real is not None and float(np.abs(queries).max(initial=0)) * float(np.abs(self.x).max(initial=0)) * queries.shape[1] < 2.0**52:
            return (queries.astype(np.float64) @ self.real[lo:hi].T).astype(np.int64)
        return queries @ self.x[lo:hi].T

    def leaves(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Going down level by level, the leaves that some query's windows can reach, with the least
        and largest score that each may hold, per query and leaf."""
        size = np.linalg.norm(queries.astype(np.float64), axis=1, keepdims=True)
        unit = queries / np.maximum(size, 1e-300)
        found, least, most = [], [], []
        level = np.zeros(min(1, len(self.centre)), np.int64)
        while len(level):
            below, above = cone(unit, self.centre[level], self.reach[level], size * float(self.longest))
            open_ = reachable(below, above, low, high).any(axis=0)
            leaf = open_ & self.leaf[level]
            found.append(level[leaf])
            least.append(below[:, leaf])
            most.append(above[:, leaf])
            inner = level[open_ & ~self.leaf[level]]
            level = np.concatenate([np.arange(self.first[n], self.last[n]) for n in inner]) if len(inner) else np.zeros(0, np.int64)
        if not found:
            return np.zeros(0, np.int64), np.zeros((len(queries), 0)), np.zeros((len(queries), 0))
        return np.concatenate(found), np.hstack(least), np.hstack(most)

    def search(self, queries: np.ndarray, labels: np.ndarray, same: bool, names: np.ndarray, ids: np.ndarray,
               low: np.ndarray, high: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(query, window, score, id): of each query's windows (least and largest scores, query x
        window; none where least > largest) the first ``most`` rows by falling score and rising id,
        whose label is the query's (same) or is not.  With ``same``, one row of the query's own
        name and id is left out.

        Every query goes through its leaves from the best bound down, in batches of 1, 2, 4, ...
        leaves; a leaf is scored at once for all queries that have it in their batch.  Between
        batches each window's floor rises to the score of the row after the ``most``-th found.
        """
        leaf, below, above = self.leaves(queries, low, high)
        floors = low.copy()
        tops = np.full((*low.shape, most + 1), NO_SCORE)
        order = np.argsort(-np.minimum(above, high.max(axis=1, initial=NO_SCORE)[:, None].astype(float)), axis=1, kind="stable")
        hits: list[tuple[np.ndarray, ...]] = []
        start, batch = 0, 1
        while start < len(leaf):
            turn = np.zeros(above.shape, bool)
            np.put_along_axis(turn, order[:, start : start + batch], True, axis=1)
            turn &= reachable(below, above, floors, high)
            for k in np.flatnonzero(turn.any(axis=0)):
                rows, lo, hi = np.flatnonzero(turn[:, k]), int(self.first[leaf[k]]), int(self.last[leaf[k]])
                score = self.scores(lo, hi, queries[rows])
                able = (self.labels[lo:hi] == labels[rows, None]) == same
                for w in range(low.shape[1]):
                    inside = np.where(able & (score >= floors[rows, w, None]) & (score <= high[rows, w, None]), score, NO_SCORE)
                    some = np.flatnonzero((inside > NO_SCORE).any(axis=1))
                    if not len(some):
                        continue
                    inside, mine = inside[some], rows[some]
                    best = inside if inside.shape[1] <= most + 1 else np.partition(inside, -most - 1, axis=1)[:, -most - 1 :]
                    tops[mine, w] = np.partition(np.hstack([tops[mine, w], best]), -most - 1, axis=1)[:, -most - 1 :]
                    floors[mine, w] = np.maximum(floors[mine, w], tops[mine, w].min(axis=1))
                    q, point = np.nonzero(inside >= np.maximum(best.min(axis=1), NO_SCORE + 1)[:, None])
                    hits.append((mine[q], np.full(len(q), w), inside[q, point], lo + point))
            start, batch = start + batch, batch * 2
        if not hits:
            return (np.zeros(0, np.int64),) * 4
        q, w, score, point = (np.concatenate(c) for c in zip(*hits))
        kept = score >= floors[q, w]
        q, w, score, point = q[kept], w[kept], score[kept], point[kept]
        each = self.ids[point]
        if same:
            own = (each == ids[q, None]) & (self.names[point] == names[q])[:, None]
            each[own & (np.cumsum(own, axis=1) == 1)] = NO_ID
        at, column = np.nonzero(each != NO_ID)
        q, w, score, found = q[at], w[at], score[at], each[at, column]
        order = np.lexsort((found, -score, w, q))
        q, w, score, found = q[order], w[order], score[order], found[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (w[1:] != w[:-1])
        begin = np.flatnonzero(new)
        kept = np.arange(len(q)) - np.repeat(begin, np.diff(np.append(begin, len(q)))) < most
        return q[kept], w[kept], score[kept], found[kept]


#: Fills up lists of ids; below every score.
NO_ID = np.iinfo(np.int64).max
NO_SCORE = np.iinfo(np.int64).min


def reachable(below: np.ndarray, above: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Per query and node: some window of the query meets the node's scores."""
    out = np.zeros(below.shape, bool)
    for w in range(low.shape[1]):
        open_ = (low[:, w] <= high[:, w])[:, None]
        out |= open_ & (above >= low[:, w, None].astype(float)) & (below <= high[:, w, None].astype(float))
    return out


def cone(units: np.ndarray, centres: np.ndarray, reach: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of points within ``reach`` of each centre, for unit queries of
    which ``size`` is the length times the points' length."""
    t = angles(units @ centres[:, : units.shape[1]].T)
    low = size * np.cos(np.minimum(np.pi, t + reach + SLACK))
    return low - 1e-6 - 1e-12 * size, size * np.cos(np.maximum(0.0, t - reach - SLACK)) + 1e-6 + 1e-12 * size
