"""Exact top-k search with M-trees.

A shard of vectors is bulk-loaded into an M-tree: pages of at most ``PAGE`` entries,
each with a routing vector, a covering radius (no vector below is farther from it)
and the distance to the parent's routing vector.  The search is best-first: a heap
holds pages by the best score anything in them can have, and ends when that is below
the k-th best score found.

Scores are inner products, which a metric bounds from both sides: for any x within
distance d of p, <q, x> <= <q, p> + |q| d.  So a page within radius r of its routing
vector p scores at most <q, p> + |q| r.  Before <q, p> is computed at all, the stored
distance e to the parent's routing vector o gives <q, p> <= <q, o> + |q| e, and pages
and vectors that this rules out are skipped without a computation.  The same bounds
hold at the leaves.  Bounds carry a slack for rounding, so results are exact.

Vectors lie in shards by hash (`vectors.search`); each shard's tree is exact, so the
best of all shards are the exact top k.

Edge cases: rows with a null id or with null, empty or non-finite vectors take no
part; equal vectors and ties go to the smaller id; fewer than k candidates give all;
a table without queries or rows gives an empty result; vectors of several lengths
only meet their like; extra columns aren't read.  Scores are exact below 2 ** 53.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .vectors import search, usable

PAGE = 128
FANOUT = 16


class MTree:
    """A bulk-loaded M-tree over the rows of a float64 matrix."""

    def __init__(self, x: np.ndarray, page: int = PAGE, fanout: int = FANOUT):
        self.x, self.page, self.fanout = x, page, fanout
        self.route: list[np.ndarray] = []     # routing vector of each node
        self.radius: list[float] = []
        self.up: list[float] = []             # distance to the parent's routing vector
        self.below: list = []                 # child nodes, or the rows of a leaf page
        self.leaf: list[bool] = []
        self.reach: list = []                 # of a leaf's rows: distance to the routing vector
        if len(x):
            self._load(np.arange(len(x)), x.mean(axis=0), 0.0)

    def _load(self, rows: np.ndarray, route: np.ndarray, up: float) -> int:
        node = len(self.route)
        away = np.sqrt(((self.x[rows] - route) ** 2).sum(axis=1))
        self.route.append(route)
        self.radius.append(float(away.max()))
        self.up.append(up)
        self.leaf.append(len(rows) <= self.page)
        self.below.append(rows)
        self.reach.append(away)
        if self.leaf[node]:
            return node
        # spread pivots: each is the row farthest from those before it
        first = int(away.argmax())
        pivots, near = [first], np.full(len(rows), np.inf)
        side = np.zeros(len(rows), np.int64)
        for k in range(min(self.fanout, -(-len(rows) // self.page))):
            d = ((self.x[rows] - self.x[rows[pivots[k]]]) ** 2).sum(axis=1)
            side[d < near] = k
            near = np.minimum(near, d)
            pivots.append(int(near.argmax()))
        if (side == side[0]).all():  # equal vectors can't be told apart: cut evenly
            side = np.arange(len(rows)) * 2 // len(rows)
        children = []
        for k in np.unique(side):
            part = rows[side == k]
            centre = self.x[part].mean(axis=0)
            children.append(self._load(part, centre, float(np.sqrt(((centre - route) ** 2).sum()))))
        self.below[node], self.reach[node] = np.array(children), None
        return node

    def seal(self) -> "MTree":
        self.routes = np.array(self.route)
        self.radii, self.ups = np.array(self.radius), np.array(self.up)
        return self

    def best(self, q: np.ndarray, k: int, allowed=None) -> tuple[list[tuple[float, int]], int]:
        """((score, row) of at least the k best rows, all ties with the k-th
        included; number of inner products computed)."""
        if not len(self.x):
            return [], 0
        size = float(np.sqrt(q @ q))
        slack = 1e-9 * (1.0 + size * float(np.abs(self.x).max()) * len(q))
        top: list[float] = []             # the k best scores so far, smallest first
        found: list[tuple[float, int]] = []
        floor, done = -np.inf, 1
        heap = [(-(float(q @ self.routes[0]) + size * self.radii[0]), 0, float(q @ self.routes[0]))]
        while heap:
            bound, node, here = heapq.heappop(heap)
            if -bound + slack < floor:
                break
            below = self.below[node]
            if not self.leaf[node]:
                # bound of each child from stored distances only
                below = below[here + size * (self.ups[below] + self.radii[below]) + slack >= floor]
                score = self.routes[below] @ q
                done += len(below)
                limit = score + size * self.radii[below]
                for c, s, b in zip(below.tolist(), score.tolist(), limit.tolist()):
                    if b + slack >= floor:
                        heapq.heappush(heap, (-b, c, s))
                continue
            rows = below[here + size * self.reach[node] + slack >= floor]
            if allowed is not None:
                rows = rows[allowed[rows]]
            done += len(rows)
            score = self.x[rows] @ q
            good = score >= floor
            found += zip(score[good].tolist(), rows[good].tolist())
            for s in np.sort(score[good])[-k:].tolist():
                if len(top) < k:
                    heapq.heappush(top, s)
                elif s > top[0]:
                    heapq.heapreplace(top, s)
            if len(top) == k:
                floor = top[0]
        return [f for f in found if f[0] >= floor], done


def _search_shard(k: int):
    def find(ids, x, qids, q):
        tree = MTree(x).seal()
        a, b, s, seen = [], [], [], np.zeros(len(qids), np.int64)
        for i in range(len(qids)):
            own = ids == qids[i]
            found, seen[i] = tree.best(q[i], k, ~own if own.any() else None)
            a += [i] * len(found)
            b += [r for _, r in found]
            s += [v for v, _ in found]
        return np.array(a, np.int64), np.array(b, np.int64), np.array(s, np.float64), seen

    return find


def quantised(rows: DataFrame, scale: float) -> DataFrame:
    """Vectors with every component x turned into floor(scale * x)."""
    return rows.withColumn("vec", F.transform("vec", lambda x: F.floor(x * scale).cast("double")))


def top_k(rows: DataFrame, id_col: str, vector_col: str, is_query, k: int = 5, scale: float = 256.0, **sizes) -> DataFrame:
    """(query_id, rank, vec_id, score, examined): the k rows with the largest
    integer inner product for every row for which ``is_query`` (a Column over
    ``id``) holds.  ``examined`` counts inner products in the row's shard."""
    return search(quantised(usable(rows, id_col, vector_col), scale), is_query, _search_shard(k), k, "long", **sizes)
