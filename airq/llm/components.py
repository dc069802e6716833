"""Connected components of a link table, as Spark jobs.

Alternating large-star and small-star steps: every node tells its neighbours the
smallest node it knows, until the edges no longer change; each component is then a
star around its smallest node.  Every step is two aggregations and two joins whose
hot keys are split; edges never leave the executors.  Each round is written to the shared checkpoint folder,
so lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize

ROUNDS = 60


def _star(edges: DataFrame) -> DataFrame:
    """Every node with its smallest neighbour (itself included), from partial minima.
    Written, so that the join back has a shuffle right below either side and
    adaptive execution can split the links of a hub."""
    return materialize(edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "stars")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_star(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    star = _star(down)
    return (down.join(star, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(star.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node that has a link; component is its
    smallest node."""
    edges = links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = materialize(edges, "links")
    state = None
    for _ in range(ROUNDS):
        t = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (t["n"], t["h"]) == state:
            break
        state = (t["n"], t["h"])
        edges = materialize(_small(_large(edges)), "links")
    else:
        raise RuntimeError("components didn't settle")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
