"""Least squares with many targets from one pass over the rows (M2, M4).

The normal equations need X'X and X'Y only: sums over rows whose number depends on the
columns, not on the rows.  They are gathered once for all targets and solved on the
driver, where a few hundred columns make a small dense system.

* `gram` writes the sums as one SQL aggregate (partial sums before the shuffle), for
  inputs of a few dozen columns;
* `block_gram` takes an array column of inputs, for a few hundred: every task multiplies
  its Arrow batches as matrices and keeps one running sum, so a task emits one row per
  input, whatever its rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def list_matrix():
    """A function that turns an Arrow list column, whose lists have ``width`` numbers, into a
    matrix.  (Made here, it travels to the workers by value.)"""
    def matrix(col, width: int) -> np.ndarray:
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), width)

    return matrix


def gram(rows: DataFrame, inputs: list[Column], targets: list[Column]) -> tuple[np.ndarray, np.ndarray, int]:
    """(X'X, X'Y, rows) as one aggregate of sums; rows without a null take part only."""
    p, q = len(inputs), len(targets)
    d = rows.select(*[c.alias(f"x{i}") for i, c in enumerate(inputs)], *[c.alias(f"y{j}") for j, c in enumerate(targets)]).dropna()
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    sums = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i, j in pairs] + [F.sum(F.col(f"x{i}") * F.col(f"y{j}")) for i in range(p) for j in range(q)]
    got = d.agg(F.count(F.lit(1)), *sums).first()
    value = [v or 0.0 for v in got[1:]]
    xx = np.zeros((p, p))
    for (i, j), v in zip(pairs, value):
        xx[i, j] = xx[j, i] = v
    return xx, np.array(value[len(pairs):]).reshape(p, q), got[0]


def block_gram(rows: DataFrame, inputs: str, targets: str, p: int, q: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(X'X, X'Y, rows) of array columns with ``p`` inputs and ``q`` targets a row."""
    matrix = list_matrix()

    def run(batches):
        total, n = np.zeros((p, p + q)), 0
        for batch in batches:
            if len(batch):
                x = matrix(batch.column(0), p)
                total += x.T @ np.concatenate([x, matrix(batch.column(1), q)], axis=1)
                n += len(batch)
        if n:
            off = pa.array(np.arange(0, (p + 1) * (p + q), p + q, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(p)), pa.array(np.full(p, n)), pa.ListArray.from_arrays(off, pa.array(total.ravel()))],
                                             ["i", "n", "v"])

    def merged(key, table):
        v = matrix(table["v"], p + q).sum(axis=0)
        return pa.table({"i": pa.array([key[0].as_py()]), "n": pa.array([sum(table["n"].to_pylist())]), "v": pa.array([v.tolist()])})

    schema = "i long, n long, v array<double>"
    found = rows.select(inputs, targets).mapInArrow(run, schema).groupBy("i").applyInArrow(merged, schema).collect()    # p rows
    total = np.zeros((p, p + q))
    for r in found:
        total[r["i"]] = r["v"]
    return total[:, :p], total[:, p:], found[0]["n"] if found else 0


def solve(xx: np.ndarray, xy: np.ndarray, n: int, ridge: float, free: int = 0) -> np.ndarray:
    """Coefficients (inputs x targets) of (X'X + ridge * n * I) b = X'Y; input ``free`` (the
    intercept) isn't held back.  Without rows all are 0."""
    if not n:
        return np.zeros_like(xy)
    hold = np.full(len(xx), ridge * n)
    hold[free] = 0.0
    return np.linalg.solve(xx + np.diag(hold), xy)
