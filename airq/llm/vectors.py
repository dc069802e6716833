"""Vector tables in blocks: what the two vector searches share.

Rows are dealt into shards by a hash of their id and vector, so every shard has
about the same size whatever the data; queries are dealt into blocks.  A task gets
one shard and one block of queries and returns the block's best rows of the shard;
a window over (query) keeps the best of all shards.  Memory is bounded by a shard
plus a block, and no pair of rows leaves a task unless it is among the best.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

SHARD_ROWS = 4096
QUERY_ROWS = 8192


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec array<double>) of rows with an id and a non-empty vector of finite
    components."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(F.col("vec"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (rows.select(F.col(id_col).alias("id"), v.alias("vec"))
            .filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)).filter(~bad))


def matrix(col) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)


def search(rows: DataFrame, is_query, find, k: int, score_type: str, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score, examined): the ``k`` best rows for each query.

    ``rows`` has (id, vec); ``is_query`` is a Column over ``id``.  ``find(ids,
    vectors, query_ids, query_vectors)`` returns (position of the query, position
    of the row, score) arrays holding at least the k best rows of each query by
    (score descending, id), plus the number of rows examined per query.  Rows with
    the query's id are not candidates.  Vectors only meet vectors of their length.
    A query id that occurs on several rows is one query: its smallest vector.
    """
    rows = rows.withColumn("dim", F.size("vec"))
    queries = rows.filter(is_query).groupBy("id").agg(F.min("vec").alias("vec")).withColumn("dim", F.size("vec"))
    n, q = rows.count(), queries.count()
    shards, blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(q / query_rows))
    shard = F.pmod(F.xxhash64("id", "vec"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("dim", shard.alias("shard"), every(blocks).alias("block"), "id", "vec")
    right = queries.select(F.col("dim").alias("q_dim"), every(shards).alias("q_shard"), block.alias("q_block"),
                           F.col("id").alias("q_id"), F.col("vec").alias("q_vec"))
    key_type = rows.schema["id"].dataType.simpleString()

    def best(table: pa.Table, asked: pa.Table) -> pa.Table:
        ids, qids = table["id"].to_numpy(), asked["q_id"].to_numpy()
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(len(qids), np.int64))
        a, b, s, seen = find(ids, matrix(table["vec"]), qids, matrix(asked["q_vec"])) if len(ids) and len(qids) else none
        order = np.lexsort((ids[b], -s, a))
        a, b, s = a[order], b[order], s[order]
        start = np.searchsorted(a, a)
        keep = np.arange(len(a)) - start < k
        a, b, s = a[keep], b[keep], s[keep]
        return pa.table({"query_id": pa.array(qids[a]), "vec_id": pa.array(ids[b]),
                         "score": pa.array(s.astype(np.int64) if score_type == "long" else s), "examined": pa.array(seen[a].astype(np.int64))})

    found = left.groupBy("dim", "shard", "block").cogroup(right.groupBy("q_dim", "q_shard", "q_block")).applyInArrow(
        best, f"query_id {key_type}, vec_id {key_type}, score {score_type}, examined long")
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score", "examined"))
