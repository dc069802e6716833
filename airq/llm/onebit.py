"""Approximate nearest neighbours from randomly rotated one-bit codes.

Every vector is scaled to unit length, taken relative to the nearest of a few
centres, rotated by one random rotation and reduced to the signs of its components:
one bit each, packed.  Two correction scalars go with the code: the length r of the
residual, and the inner product c of the residual's direction with its code.  For a
query, the inner product of its rotated residual with the code, divided by c, is an
unbiased estimate of the inner product of the directions, and

    |error| <= EPSILON * sqrt((1 - c * c) / (c * c) / (dimension - 1))

with a probability that EPSILON sets.  Estimates and bounds of a whole shard come from
packed bits; only vectors whose upper bound reaches the k-th largest lower bound are
read in full and scored exactly, in double precision.

Centres are fitted on a bounded sample (``SAMPLE`` rows by hash of the id); every row is
indexed.  Shards and query blocks are those of `vectors.search`.

Edge cases: rows with a null id or with null, empty, zero or non-finite vectors take
no part; ties go to the smaller id; fewer than k candidates give all; one-dimensional
vectors are scored exactly; a table without queries or rows gives an empty result;
vectors of several lengths only meet their like; extra columns aren't read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .vectors import search, usable

SAMPLE = 8192
CENTRES = 16
EPSILON = 2.6
SEED = 29
QUERIES = 256


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same for every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def evened(x: np.ndarray) -> np.ndarray:
    """Rows scaled by powers of two to components of at most 1: cosines stay the
    same to the last bit, and squares of huge or tiny components stay finite."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def fit_centres(x: np.ndarray, k: int = CENTRES, rounds: int = 8) -> np.ndarray:
    """Plain k-means on a small sample of unit vectors."""
    if len(x) < 4 * k:
        return x.mean(axis=0, keepdims=True)
    c = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(rounds):
        near = (x @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)
        c = np.array([x[near == j].mean(axis=0) if (near == j).any() else c[j] for j in range(k)])
    return c


class Codes:
    """One-bit codes of unit vectors relative to their nearest centres."""

    def __init__(self, unit: np.ndarray, centres: np.ndarray, turn: np.ndarray):
        self.centres, self.turn, self.dim = centres, turn, unit.shape[1]
        self.near = (unit @ centres.T - 0.5 * (centres * centres).sum(axis=1)).argmax(axis=1)
        residual = unit - centres[self.near]
        self.length = np.sqrt((residual * residual).sum(axis=1))
        turned = (residual / np.maximum(self.length, 1e-30)[:, None]) @ turn.T
        self.bits = np.packbits(turned > 0, axis=1)
        self.fit = np.abs(turned).sum(axis=1) / np.sqrt(self.dim)          # <direction, code>
        self.shift = (unit * centres[self.near]).sum(axis=1)              # <vector, centre>
        with np.errstate(divide="ignore", invalid="ignore"):
            spread = np.sqrt(np.maximum(0.0, 1 - self.fit ** 2) / max(1, self.dim - 1)) / self.fit
        self.spread = np.where(self.fit > 0, spread, 0.0)
        self.order = np.argsort(self.near, kind="stable")
        self.edges = np.searchsorted(self.near[self.order], np.arange(len(centres) + 1))

    def estimate(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(estimated cosine, error bound), one row per query, one column per vector."""
        est = np.empty((len(q), len(self.near)), np.float32)
        err = np.empty_like(est)
        for j in range(len(self.centres)):
            rows = self.order[self.edges[j]:self.edges[j + 1]]
            if not len(rows):
                continue
            c = self.centres[j]
            away = q - c
            size = np.sqrt((away * away).sum(axis=1))
            turned = ((away / np.maximum(size, 1e-30)[:, None]) @ self.turn.T).astype(np.float32)
            sign = np.unpackbits(self.bits[rows], axis=1, count=self.dim).astype(np.float32) * 2 - 1
            scale = np.where(self.fit[rows] > 0, 1 / np.maximum(self.fit[rows], 1e-30), 0) / np.sqrt(self.dim) * self.length[rows]
            part = (turned @ sign.T) * scale * size[:, None]
            est[:, rows] = part + (q @ c)[:, None] + self.shift[rows] - c @ c
            err[:, rows] = EPSILON * size[:, None] * (self.length * self.spread)[rows]
        return est, err + 1e-5


def _search_shard(k: int, centres: dict):
    def find(ids, x, qids, q):
        dim, x, q = x.shape[1], evened(x), evened(q)
        norm, qnorm = np.sqrt((x * x).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
        codes = Codes(x / norm[:, None], centres.value.get(dim, np.zeros((1, dim))), rotation(dim))
        a, b, s, seen = [], [], [], np.zeros(len(qids), np.int64)
        for at in range(0, len(qids), QUERIES):
            part = slice(at, at + QUERIES)
            est, err = codes.estimate(q[part] / qnorm[part][:, None])
            own = qids[part][:, None] == ids[None, :]
            low = np.where(own, -np.inf, est - err)
            floor = np.partition(low, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(est), -np.inf)
            i, j = np.nonzero((est + err >= floor[:, None]) & ~own)
            exact = (x[j] * q[part][i]).sum(axis=1) / (norm[j] * qnorm[part][i])
            seen[part] = np.bincount(i, minlength=len(est))
            a.append(i + at)
            b.append(j)
            s.append(exact)
        return np.concatenate(a), np.concatenate(b), np.concatenate(s), seen

    return find


def nearest(rows: DataFrame, id_col: str, vector_col: str, is_query, k: int = 5, **sizes) -> DataFrame:
    """(query_id, rank, vec_id, score, examined): the k rows found with the largest
    cosine for every row for which ``is_query`` (a Column over ``id``) holds;
    ``examined`` counts the vectors reranked in the row's shard."""
    spark = rows.sparkSession
    rows = usable(rows, id_col, vector_col).filter(F.exists("vec", lambda x: x != 0))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vec").toPandas()["vec"]  # at most SAMPLE rows
    by_dim: dict[int, list] = {}
    for v in sample:
        u = evened(np.asarray(v)[None, :])[0]
        by_dim.setdefault(len(u), []).append(u / np.sqrt(u @ u))
    centres = spark.sparkContext.broadcast({d: fit_centres(np.array(v)) for d, v in by_dim.items()})
    return search(rows, is_query, _search_shard(k, centres), k, "double", **sizes)
