"""Block exchange: look statistics of the whole corpus up for every document
without a broadcast table and without a row per document position.

Documents are dealt into blocks of bounded size.  A block's task finds its
distinct keys (words, byte contexts) and sends, per key bucket, one packed row
of sorted keys and counts.  A bucket's task merges the rows of all blocks, so it
holds the corpus-wide counts of its keys, turns them into values, and sends each
block one packed row with the values of that block's keys in the same order.
The block's task then scores its documents with a table no larger than the block.

    documents --by block--> keys --by bucket--> values --by block--> scores

Sizes are bounded on both sides: a block by ``block_bytes`` of text (a longer
text makes a larger block), a bucket by the number of buckets, which follows the
corpus size.  All steps are lazy Spark shuffles, so a lost executor's
parts are recomputed from the input.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import U64, splitmix

BLOCK_BYTES = 8 << 20
KEY_SCHEMA = "bucket int, block int, part int, keys binary, counts binary"
VALUE_SCHEMA = "block int, bucket int, part int, vals binary"


def text_bytes(docs: DataFrame, text: str) -> int:
    """Total UTF-8 size of a text column: one aggregate, one number."""
    return int(docs.agg(F.sum(F.octet_length(F.col(text)).cast("long")).alias("b")).first()["b"] or 0)


def block_count(total_bytes: int, block_bytes: int = BLOCK_BYTES) -> int:
    return max(1, math.ceil(total_bytes / block_bytes))


def block_of(n_blocks: int, *cols):
    """Block of a row.  Hashing every column given (id and text) keeps rows that
    share one of them apart; equal rows may meet, which costs balance only."""
    return F.pmod(F.xxhash64(*cols), F.lit(n_blocks)).cast("int").alias("block")


def bucket_of(route: np.ndarray, n_buckets: int) -> np.ndarray:
    return (splitmix(route) % U64(n_buckets)).astype(np.int64)


def pack_by_bucket(block: int, part: int, keys: np.ndarray, counts: np.ndarray, route: np.ndarray, n_buckets: int):
    """Rows of KEY_SCHEMA for one block: sorted distinct ``keys`` with a count
    matrix (one row per counter), routed by ``route``."""
    bucket = bucket_of(route, n_buckets)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    full = np.flatnonzero(np.diff(edges))
    k, c = keys[order], counts[:, order].astype(np.uint32)
    return pa.table({
        "bucket": pa.array(full, pa.int32()),
        "block": pa.array(np.full(len(full), block), pa.int32()),
        "part": pa.array(np.full(len(full), part), pa.int32()),
        "keys": pa.array([pack(k[edges[b]:edges[b + 1]]) for b in full], pa.binary()),
        "counts": pa.array([pack(c[:, edges[b]:edges[b + 1]]) for b in full], pa.binary()),
    })


def pack(a: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def unpack(b: bytes, dtype) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)


def merge(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of many (keys, counts) rows, with summed counts."""
    keys = np.concatenate([k for k, _ in rows])
    counts = np.concatenate([c for _, c in rows], axis=1)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[:, order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first, axis=1)


def exchange(docs: DataFrame, n_buckets: int, extract, resolve, score, score_schema: str) -> DataFrame:
    """The three steps above.

    ``docs`` has an int column ``block``.
    ``extract(block, table) -> iterable of tables`` of KEY_SCHEMA,
    ``resolve({part: {block: (keys, counts)}}) -> {part: {block: values}}`` per bucket,
    ``score(block, table, {part: {bucket: value bytes}}) -> table`` of ``score_schema``.
    """
    docs = docs.select("block", *[c for c in docs.columns if c != "block"])

    def keys_of(table: pa.Table) -> pa.Table:
        out = list(extract(table["block"][0].as_py(), table))
        return pa.concat_tables(out)

    def values_of(table: pa.Table) -> pa.Table:
        parts: dict = {}
        for r in table.to_pylist():
            keys = unpack(r["keys"], U64)
            counts = unpack(r["counts"], np.uint32).reshape(-1, len(keys))
            parts.setdefault(r["part"], {})[r["block"]] = (keys, counts)
        bucket = table["bucket"][0].as_py()
        rows = [(block, bucket, part, pack(v)) for part, by in resolve(parts).items() for block, v in by.items()]
        cols = list(zip(*rows)) or [(), (), (), ()]
        return pa.table({"block": pa.array(cols[0], pa.int32()), "bucket": pa.array(cols[1], pa.int32()),
                         "part": pa.array(cols[2], pa.int32()), "vals": pa.array(cols[3], pa.binary())})

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        vals: dict = {}
        for r in right.to_pylist():
            vals.setdefault(r["part"], {})[r["bucket"]] = r["vals"]
        return score(left["block"][0].as_py(), left, vals)

    keys = docs.groupBy("block").applyInArrow(keys_of, KEY_SCHEMA)
    values = keys.groupBy("bucket").applyInArrow(values_of, VALUE_SCHEMA)
    return docs.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(scored, score_schema)


def gather(keys: np.ndarray, route: np.ndarray, n_buckets: int, vals: dict, dtype) -> np.ndarray:
    """Values for a block's sorted ``keys`` from the packed rows it got back."""
    bucket = bucket_of(route, n_buckets)
    out = np.zeros(len(keys), dtype)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        out[order[edges[b]:edges[b + 1]]] = unpack(vals[int(b)], dtype)
    return out
