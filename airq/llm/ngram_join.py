"""N-gram Jaccard self-join with adaptive multi-match prefixes, and its components.

Two texts link when their sets of distinct five-word shingles have a Jaccard
similarity of at least ``percent`` / 100.  Steps:

1. **Order.**  A fixed-size count sketch of all shingles (``CELLS`` counters of one
   byte, whatever the corpus) gives one global order, rare shingles first.  Where
   the corpus has many more shingles than cells the order gets coarser, which costs
   candidates but no links.
2. **Adaptive prefixes.**  A set of n shingles that must share o = ceil(n p / 100)
   with any partner shares at least l of its first n - o + l.  Each set picks the l
   of 1 .. ``MAX_MATCH`` with the least estimated cost, from the lengths of its
   shingles' lists: entries scanned, plus the candidates they can yield divided by l.
   A pair is a candidate only if its prefixes share min(l_a, l_b) shingles, which
   every linked pair does (the shorter requirement holds for both prefixes).
3. **Exact copies** have equal sets; one row per distinct set takes part, so a group
   of copies costs one row however large it is.
4. **Short lists** (shingles in at most ``LIST`` prefixes) give candidate pairs; the
   shared count is checked, then the whole sets are intersected.
5. **Long lists** come from large groups of near copies.  First each list's hub (the
   set with the largest lists) is compared with its members, and the components of
   those links found.  Only sets of different components can still add a link that
   matters: the list is cut into chunks and every pair of chunks is compared by a
   task of its own that keeps a spanning set of the links it finds.  No pairs are
   emitted and no task holds a whole list; nothing is skipped.
6. The links' components (`components`), and per document the smallest id in its.

Set sizes, intersections and the threshold are exact over 64-bit shingle hashes.

Edge cases: null, empty and blank texts have no shingles and link with nothing (their
component is their own id); a text with fewer than five words is one shingle; a null
id takes part, and a component's id is its smallest non-null one; repeated rows share
a component; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .blocks import pack, unpack
from .components import components
from .text import U64, returning_memory, shingles, slices, splitmix, string_column, words

SIZE = 5
PERCENT = 80
CELLS = 1 << 24
BLOOM_BITS = 26
STRIPES = 64
MAX_MATCH = 16
VERIFY_COST = 16.0
LIST = 32
CHUNK = 1024


def distinct_shingles(col: pa.StringArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes ordered per text, offsets per text)."""
    h, first = shingles(words(col), size)
    text = np.repeat(np.arange(len(col)), np.diff(first))
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])]) if len(h) else np.zeros(0, bool)
    h, text = h[new], text[new]
    return h, np.searchsorted(text, np.arange(len(col) + 1))


def _cell(h: np.ndarray) -> np.ndarray:
    return (splitmix(h) >> U64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def _stripes(a: np.ndarray, stripes: int):
    for k, part in enumerate(np.split(a, stripes)):
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([pack(part)], pa.binary())], ["stripe", "data"])


def list_size_sketch(own: DataFrame, size: int) -> np.ndarray:
    """log2 of how many texts hold a shingle of each of ``CELLS`` cells, in eighths:
    one byte per cell, whatever the corpus."""

    @returning_memory
    def count(batches):
        total, rows = np.zeros(CELLS, np.uint16), 0
        for batch in batches:
            col = string_column(batch.column("text"))
            for a, b in slices(col):
                if rows + b - a > 65_000:  # before a counter could run over
                    yield from _stripes(total, STRIPES)
                    total, rows = np.zeros(CELLS, np.uint16), 0
                rows += b - a
                h, _ = distinct_shingles(col.slice(a, b - a), size)
                np.add.at(total, _cell(h), np.uint16(1))
        if rows:
            yield from _stripes(total, STRIPES)

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(CELLS // STRIPES, np.int64)
        for x in table["data"].to_pylist():
            total += unpack(x, np.uint16)
        small = np.minimum(255, np.round(8 * np.log2(1.0 + total))).astype(np.uint8)
        return pa.table({"stripe": table["stripe"].slice(0, 1), "data": pa.array([pack(small)], pa.binary())})

    rows = (own.select("text").mapInArrow(count, "stripe int, data binary").groupBy("stripe")
            .applyInArrow(add, "stripe int, data binary").collect())  # STRIPES rows of fixed size
    out = np.zeros((STRIPES, CELLS // STRIPES), np.uint8)
    for r in rows:
        out[r["stripe"]] = unpack(r["data"], np.uint8)
    return out.reshape(-1)


def _bits(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = splitmix(fp ^ U64(0x2545F491))
    return (h >> U64(64 - BLOOM_BITS)).astype(np.int64), ((h << U64(20)) >> U64(64 - BLOOM_BITS)).astype(np.int64)


def bloom(wanted: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size over a column ``fp``; what it lets through by
    chance is dropped by a join later."""

    @returning_memory
    def mark(batches):
        bits, some = np.zeros(1 << BLOOM_BITS, bool), False
        for batch in batches:
            for at in _bits(batch.column("fp").to_numpy().view(U64)):
                bits[at] = some = True
        if some:
            yield from _stripes(np.packbits(bits), STRIPES)

    def either(table: pa.Table) -> pa.Table:
        total = np.bitwise_or.reduce([unpack(x, np.uint8) for x in table["data"].to_pylist()])
        return pa.table({"stripe": table["stripe"].slice(0, 1), "data": pa.array([pack(total)], pa.binary())})

    rows = wanted.select("fp").mapInArrow(mark, "stripe int, data binary").groupBy("stripe").applyInArrow(either, "stripe int, data binary").collect()
    out = np.zeros((STRIPES, (1 << BLOOM_BITS) // 8 // STRIPES), np.uint8)
    for r in rows:
        out[r["stripe"]] = unpack(r["data"], np.uint8)
    return out.reshape(-1)


def _may_hold(bits: np.ndarray, fp: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([(bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 for at in _bits(fp)])


def prefixes(h: np.ndarray, first: np.ndarray, sketch: np.ndarray, percent: int, max_match: int = MAX_MATCH):
    """(prefix lengths, hashes in global order): each set's prefix for the largest
    number of matches it may choose.  The prefix for k matches is its first
    n - ceil(n p / 100) + k hashes."""
    n = np.diff(first)
    text = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((h, sketch[_cell(h)], text))
    need = -(-n * percent // 100)
    return n - need + np.minimum(need, max_match), h[order]


def matches_by_cost(lists: DataFrame, percent: int, max_match: int = MAX_MATCH) -> DataFrame:
    """(fp, need): the number of matches k that costs a set least.  With k matches
    it scans S_k list entries, those of its first n - ceil(n p / 100) + k shingles,
    which yield at most S_k / k candidates with k matches; verifying one costs as
    much as ``VERIFY_COST`` entries."""
    n, most = F.col("n"), F.ceil(F.col("n") * percent / 100)
    scans = lists.groupBy("fp").agg(F.first("n").alias("n"), *[
        F.sum(F.when(F.col("pos") < n - most + k, F.col("len") - 1).otherwise(0)).alias(f"s{k}") for k in range(1, max_match + 1)])
    cost = [F.struct((F.col(f"s{k}") * (1 + VERIFY_COST / k)).alias("cost"), F.lit(k).alias("need"))
            for k in range(1, max_match + 1)]
    options = F.filter(F.array(*cost), lambda c: c["need"] <= F.greatest(most, F.lit(1)))
    return scans.select("fp", F.array_min(options)["need"].alias("need"))


def _fingerprint(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of each set (0 for an empty one)."""
    n = np.diff(first)
    with np.errstate(over="ignore"):
        acc = np.concatenate([[U64(0)], np.cumsum(splitmix(h), dtype=U64)])
        other = np.concatenate([[U64(0)], np.cumsum(splitmix(h ^ U64(0x5DEECE66D)), dtype=U64)])
        f = splitmix(acc[first[1:]] - acc[first[:-1]]) ^ splitmix((other[first[1:]] - other[first[:-1]]) + n.astype(U64))
    return np.where(n > 0, f, U64(0))


def _rows(sketch, size: int, percent: int):
    """Per text: set size, fingerprint, needed matches and prefix.  Of texts with
    equal sets only the first that a task meets carries its prefix."""

    @returning_memory
    def run(batches):
        met: set[int] = set()
        for batch in batches:
            col = string_column(batch.column("text"))
            for a, b in slices(col):
                h, first = distinct_shingles(col.slice(a, b - a), size)
                fp = _fingerprint(h, first)
                length, ranked = prefixes(h, first, sketch.value, percent)
                for i, f in enumerate(fp.tolist()):
                    if f in met:
                        length[i] = 0
                    met.add(f)
                take = np.arange(len(ranked)) - np.repeat(first[:-1], np.diff(first)) < np.repeat(length, np.diff(first))
                off = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(off), pa.array(ranked[take].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(a, b - a), pa.array(np.diff(first).astype(np.int64)), pa.array(fp.view(np.int64)),
                     tokens], ["key", "n", "fp", "tokens"])

    return run


def _sets(size: int, wanted):
    """Whole shingle sets of the texts whose fingerprint may be wanted."""

    @returning_memory
    def run(batches):
        for batch in batches:
            col = string_column(batch.column("text"))
            for a, b in slices(col):
                h, first = distinct_shingles(col.slice(a, b - a), size)
                fp = _fingerprint(h, first)
                some = (np.diff(first) > 0) & _may_hold(wanted.value, fp).astype(bool)
                n = np.diff(first)
                off = np.concatenate([[0], np.cumsum(n[some])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(fp[some].view(np.int64)), pa.ListArray.from_arrays(
                    pa.array(off), pa.array(h[np.repeat(some, n)].view(np.int64)))], ["fp", "tokens"])

    return run


def _linked(shared, n_a, n_b, percent: int):
    return 100 * shared >= percent * (n_a + n_b - shared)


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    left = sets.select(F.col("fp").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("fp").alias("b"), F.col("tokens").alias("tb"))
    shared = F.size(F.array_intersect("ta", "tb"))
    return pairs.join(left, "a").join(right, "b").filter(_linked(shared, F.size("ta"), F.size("tb"), percent)).select("a", "b")


def _compare_chunks(percent: int):
    """Links between two chunks of one list, reduced to a spanning set."""

    def run(table: pa.Table) -> pa.Table:
        fp = table["fp"].to_numpy()
        i, j, own = (table[c][0].as_py() if c != "own" else table[c].to_numpy() for c in ("i", "j", "own"))
        tokens = pa.concat_arrays(table["tokens"].chunks)
        off = tokens.offsets.to_numpy()
        flat, of = tokens.values.to_numpy()[off[0]:off[-1]], np.repeat(np.arange(len(fp)), np.diff(off))
        n = np.diff(off)
        _, index, times = np.unique(flat, return_inverse=True, return_counts=True)
        common = times[index] > 1
        index, of = np.unique(index[common], return_inverse=True)[1], of[common]
        left = np.flatnonzero(own == i)
        right = left if i == j else np.flatnonzero(own == j)
        shared = np.zeros((len(left), len(right)), np.int64)
        width = int(index.max()) + 1 if len(index) else 0
        for a in range(0, width, 4096):
            part = (index >= a) & (index < a + 4096)
            x = np.zeros((len(fp), min(4096, width - a)), np.float32)
            x[of[part], index[part] - a] = 1
            shared += (x[left] @ x[right].T).astype(np.int64)    # counts up to 4096 are exact in float32
        ok = _linked(shared, n[left][:, None], n[right][None, :], percent)
        comp = table["comp"].to_numpy()
        group = {}

        def find(x):
            while group.get(x, x) != x:
                group[x] = group.get(group[x], group[x])
                x = group[x]
            return x

        a_out, b_out = [], []
        for x, y in zip(*np.nonzero(ok)):
            p, q = find(comp[left[x]]), find(comp[right[y]])
            if p != q:
                group[p] = q
                a_out.append(fp[left[x]])
                b_out.append(fp[right[y]])
        return pa.table({"a": pa.array(a_out, pa.int64()), "b": pa.array(b_out, pa.int64())})

    return run


def prefix_lists(rows: DataFrame) -> DataFrame:
    """(token, fp, len, n, pos): the prefixes of distinct sets, without the shingles
    that only one has.  Lists are counted by partial sums and their lengths written, so
    that the join back has a shuffle (or a broadcast) right below either side, which
    adaptive execution needs to split the list of a hot shingle."""
    sets = materialize(rows.filter(F.size("tokens") > 0).dropDuplicates(["fp"]).select("fp", "n", "tokens"), "distinct-sets")
    shared = sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("len")).filter("len > 1")
    return (sets.select("fp", "n", F.posexplode("tokens").alias("pos", "token")).join(materialize(shared, "lengths"), "token")
            .select("token", "fp", "len", "n", "pos"))


def similar_groups(docs: DataFrame, id_col: str, text_col: str, size: int = SIZE, percent: int = PERCENT,
                   list_limit: int = LIST, chunk: int = CHUNK) -> DataFrame:
    """(key, n_shingles, component) of every row of ``docs``."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    key = own.schema["key"].dataType.simpleString()
    sketch = spark.sparkContext.broadcast(list_size_sketch(own, size))
    rows = materialize(own.mapInArrow(_rows(sketch, size, percent), f"key {key}, n long, fp long, tokens array<long>"), "prefixes")
    sketch.destroy()  # the written table no longer needs it

    lists = materialize(prefix_lists(rows), "lists")
    # with the list lengths known, every set chooses its number of matches and keeps that prefix
    lists = lists.join(matches_by_cost(lists, percent), "fp")
    lists = materialize(lists.filter(F.col("pos") < F.col("n") - F.ceil(F.col("n") * percent / 100) + F.col("need")).drop("pos"), "prefix-lists")

    short = lists.filter(F.col("len") <= list_limit)
    left = short.select("token", F.col("fp").alias("a"), F.col("n").alias("n_a"), F.col("need").alias("need_a"))
    right = short.select("token", F.col("fp").alias("b"), F.col("n").alias("n_b"), F.col("need").alias("need_b"))
    pairs = left.join(right, "token").filter((F.col("a") < F.col("b")) & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")))
    pairs = (pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.first("need_a").alias("need_a"), F.first("need_b").alias("need_b"))
             .filter(F.col("shared") >= F.least("need_a", "need_b")).select("a", "b"))

    long = lists.filter(F.col("len") > list_limit)
    hubness = long.groupBy("fp").agg(F.sum("len").alias("weight"))
    long = materialize(long.join(hubness, "fp"), "long-lists")
    hubs = long.groupBy("token").agg(F.max(F.struct("weight", "fp", "n")).alias("hub")).select("token", F.col("hub.fp").alias("hub"), F.col("hub.n").alias("n_hub"))
    stars = (long.join(hubs, "token").filter((F.col("fp") != F.col("hub")) & (100 * F.least("n", "n_hub") >= percent * F.greatest("n", "n_hub")))
             .select(F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b")).distinct())
    pairs = materialize(pairs.union(stars).distinct(), "candidates")

    # whole sets, of candidates only: texts aren't shuffled, a filter of fixed size
    # picks them where they are read
    wanted = materialize(pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).union(long.select("fp")).distinct(), "wanted")
    picks = spark.sparkContext.broadcast(bloom(wanted))
    sets = own.select("text").mapInArrow(_sets(size, picks), "fp long, tokens array<long>")
    sets = materialize(sets.join(wanted, "fp", "left_semi").dropDuplicates(["fp"]), "sets")
    picks.destroy()
    links = materialize(_similar(pairs, sets, percent), "similar")

    # long lists again: what hubs left apart
    known = components(links, "a", "b")
    left_apart = long.join(known.withColumnRenamed("node", "fp"), "fp", "left").withColumn("comp", F.coalesce("component", "fp"))
    several = left_apart.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("len_")).filter("x <> y")
    chunks = F.ceil(F.col("len_") / chunk).cast("int")
    parts = (left_apart.join(several, "token").withColumn("own", F.pmod(F.xxhash64("fp"), chunks).cast("int"))
             .select("token", "fp", "comp", "own", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other"))
             .select("token", "fp", "comp", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    more = parts.join(sets, "fp").groupBy("token", "i", "j").applyInArrow(_compare_chunks(percent), "a long, b long")
    links = materialize(links.union(more), "links")

    groups = components(links, "a", "b")
    members = rows.filter("n > 0").groupBy("fp").agg(F.min("key").alias("least"))
    named = members.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = named.groupBy("component").agg(F.min("least").alias("name"))
    names = named.select("fp", "component").join(names, "component").select("fp", "name")
    return (rows.select("key", "n", "fp").join(names, "fp", "left")
            .select("key", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("name")).alias("component")))
