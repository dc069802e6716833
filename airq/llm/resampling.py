"""Target-distribution importance resampling: draw the documents that look like a target.

Documents and target texts are bags of hashed word runs (1 to ``GRAMS`` consecutive words
in ``BUCKETS`` buckets of a crc32).  A bucket's gain is the log ratio of its smoothed
share in the target over that in the documents, in thousandths; a document's weight is the mean
gain of its features.  A Gumbel number, a hash of the document's id, is added: the
largest scores then are a draw without replacement in proportion to the exponentials of the weights.

1. **Counts.**  Every task adds its texts' features into one array of ``BUCKETS``
   numbers, so a table becomes ``BUCKETS`` rows a task whatever its texts hold, and no
   bucket, however frequent, is a hot key.  The gains are one array of fixed size.
2. **Scores.**  A second pass over the texts takes each feature's gain from that array.
3. **Selection.**  The K-th largest key (score, id, features) is found by weighted medians of medians,
   without a sort of the table: each partition tells the median of the keys it has left
   and how many these are, the median of these medians, weighted by those sizes, is the
   pivot, and the keys above it are counted.  At least a quarter of what is left lies on
   either side of the pivot, so every round throws away a guaranteed fraction, until the
   pivot is the K-th key itself.  A round is one job: it counts for the last pivot and
   gives the medians on both of its sides.  The driver sees two medians a partition.
4. **Ranks.**  Only the winners are sorted, by ranges, and numbered by prefix sums of the range sizes.

Features are split, hashed (crc32, with runs joined by the crc's linearity) and scored in
numpy over slices of about 1 MB of text.

Ids are whole numbers.

Edge cases: null and empty texts and texts without words have no features, weight 0, and
take part like others if ``min_words`` allows; a null id is hashed as empty text and
comes last among equal scores; rows equal in score, id and features are interchangeable,
and of such rows as many are drawn as there is room for; an empty table or a draw of 0 rows draws nothing; a text
is held whole, so a very long one needs about 60 bytes of memory a byte; other
columns aren't read, whatever their names.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.positions import with_global_position
from ..session import materialize
from .text import lower_bytes, raw, slices, string_column

GRAMS = 2
BUCKETS = 10_000
SEED = 7
MIN_WORDS = 20
SHARE = 25          # per cent of the eligible documents
LONG = 64           # longer words go through zlib one by one

#: Bytes that separate words: ASCII but digits and (after lower-casing) letters.
_APART = np.ones(256, bool)
_APART[0x30:0x3A] = _APART[0x61:0x7B] = _APART[0x80:] = False


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_TABLE = _crc_table()


def _zero_bytes(n: int) -> np.ndarray:
    """For each length up to ``n``, four tables that advance a crc by that many zero bytes."""
    out = np.zeros((n + 1, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for i in range(1, n + 1):
        out[i] = _TABLE[out[i - 1] & np.uint32(0xFF)] ^ (out[i - 1] >> np.uint32(8))
    return out


_ZEROS = _zero_bytes(LONG)


def crc_words(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 of byte ranges: byte k of all words that have one, k by k."""
    size = end - start
    out = np.full(len(start), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-size, kind="stable")
    longer = int((size > LONG).sum())
    todo, at, state = order[longer:], start[order[longer:]], out[order[longer:]]
    left = np.searchsorted(-size[todo], -np.arange(1, LONG + 1), "right")   # words with at least k bytes
    for k, n in enumerate(left.tolist()):
        if not n:
            break
        state[:n] = _TABLE[(state[:n] ^ buf[at[:n] + k]) & np.uint32(0xFF)] ^ (state[:n] >> np.uint32(8))
    out[todo] = state
    out ^= np.uint32(0xFFFFFFFF)
    for i in order[:longer].tolist():
        out[i] = zlib.crc32(buf[start[i]:end[i]].tobytes())
    return out


def crc_append(crc: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray, own: np.ndarray) -> np.ndarray:
    """crc32 of (a text of crc ``crc``) + blank + (the byte range, of crc ``own``)."""
    crc = crc ^ np.uint32(0xFFFFFFFF)
    crc = _TABLE[(crc ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (crc >> np.uint32(8)) ^ np.uint32(0xFFFFFFFF)
    size = end - start
    short = np.minimum(size, LONG)
    out = own.copy()
    for k in range(4):
        out ^= _ZEROS[short, k, (crc >> np.uint32(8 * k)) & np.uint32(0xFF)]
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = zlib.crc32(buf[start[i]:end[i]].tobytes(), int(crc[i]))
    return out


def features(col: pa.StringArray, grams: int = GRAMS, buckets: int = BUCKETS):
    """(buckets of all features, their text, words per text) of a null-free string array."""
    buf, off = raw(col)
    buf = lower_bytes(buf)
    n = len(buf)
    inside = ~_APART[buf]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    begins[cut], ends[cut - 1] = inside[cut], inside[cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, off)
    words = np.diff(first)
    text = np.repeat(np.arange(len(words)), words)
    own = crc_words(buf, start, end)
    found, owner, run = [own], [text], own
    for g in range(1, grams):
        run = crc_append(run[:-1], buf, start[g:], end[g:], own[g:]) if len(run) > 1 else run[:0]
        same = text[g:] == text[:len(text) - g]
        found.append(run[same])
        owner.append(text[g:][same])
    return np.concatenate(found) % np.uint32(buckets), np.concatenate(owner), words


def bucket_counts(docs: DataFrame, text_col: str, grams: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all texts of a table."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            col = string_column(batch.column(0))
            for a, b in slices(col):
                total += np.bincount(features(col.slice(a, b - a), grams, buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    own = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = own.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in found.collect():   # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of every bucket."""
    s, t, b = source.astype(np.float64), target.astype(np.float64), float(len(source))
    return np.floor(1000.0 * np.log((t + 1.0) * (s.sum() + b) / ((s + 1.0) * (t.sum() + b)))).astype(np.int64)


def gumbel(id_col: str, seed: int = SEED) -> Column:
    """A Gumbel number in thousandths, a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def scored(docs: DataFrame, id_col: str, text_col: str, gain: np.ndarray, grams: int = GRAMS, seed: int = SEED) -> DataFrame:
    """(key, n_words, n_features, weight, score) of every document."""
    buckets = len(gain)
    shared = docs.sparkSession.sparkContext.broadcast(gain)   # ``buckets`` numbers

    def run(batches):
        for batch in batches:
            col = string_column(batch.column(2))
            weight, n_features, n_words = (np.zeros(len(col), np.int64) for _ in range(3))
            for a, b in slices(col):
                bucket, text, words = features(col.slice(a, b - a), grams, buckets)
                n = np.bincount(text, minlength=b - a)
                # sums of whole numbers far below 2 ** 53 are exact in doubles
                total = np.bincount(text, shared.value[bucket].astype(np.float64), minlength=b - a).astype(np.int64)
                weight[a:b] = np.floor_divide(total, np.maximum(n, 1))
                n_features[a:b], n_words[a:b] = n, words
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(n_features), pa.array(weight), pa.array(weight + batch.column(1).to_numpy())],
                ["key", "n_words", "n_features", "weight", "score"])

    own = docs.select(F.col(id_col).alias("key"), gumbel(id_col, seed).alias("noise"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = own.schema["key"].dataType.simpleString()
    return own.mapInArrow(run, f"key {kind}, n_words long, n_features long, weight long, score long")


#: Order of the draw: larger scores first, then smaller ids (null last), then fewer features.
_ORDER = lambda: (F.col("score").desc(), F.col("key").asc_nulls_last(), F.col("n_features"))
_LAST = np.iinfo(np.int64).max
_KEY = "a long, b long, c long"     # the order as ascending integers


def _as_key() -> list[Column]:
    return [(-F.col("score")).alias("a"), F.coalesce(F.col("key").cast("long"), F.lit(int(_LAST))).alias("b"), F.col("n_features").alias("c")]


def _below(keys: tuple, pivot: tuple, strictly: bool = True) -> np.ndarray:
    a, b, c = keys
    x, y, z = pivot
    last = c < z if strictly else c <= z
    return (a < x) | ((a == x) & ((b < y) | ((b == y) & last)))


def _round(keys: DataFrame, low: tuple | None, high: tuple | None, pivot: tuple | None) -> list:
    """One pass over the keys in (low, high): per partition and side of the pivot, how many
    keys there are, how many equal the pivot, and the side's median."""
    def run(batches):
        parts = [[b.column(i).to_numpy() for i in range(3)] for b in batches]
        if not parts:
            return
        cols = tuple(np.concatenate(c) for c in zip(*parts))
        keep = np.ones(len(cols[0]), bool)
        if low is not None:
            keep &= ~_below(cols, low, strictly=False)
        if high is not None:
            keep &= _below(cols, high)
        cols = tuple(c[keep] for c in cols)
        sides = [(0, cols, 0)]
        if pivot is not None:
            under = _below(cols, pivot)
            over = ~_below(cols, pivot, strictly=False)
            sides = [(-1, tuple(c[under] for c in cols), 0), (1, tuple(c[over] for c in cols), int(len(under) - under.sum() - over.sum()))]
        rows = []
        for side, part, equal in sides:
            n = len(part[0])
            if n:
                at = np.lexsort(part[::-1])[(n - 1) // 2]
                rows.append((side, n, equal, *(int(c[at]) for c in part)))
            elif equal:
                rows.append((side, 0, equal, 0, 0, 0))
        if rows:
            names = ["side", "n", "equal", "a", "b", "c"]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names)

    left = keys
    if low is not None:     # lets the scan skip row groups
        left = left.filter(F.col("a") >= low[0])
    if high is not None:
        left = left.filter(F.col("a") <= high[0])
    return left.mapInArrow(run, "side long, n long, equal long, " + _KEY).collect()


def weighted_median(medians: list[tuple[tuple, int]]) -> tuple:
    """The median among (key, weight): at least half of the weight on either side of it, itself included."""
    medians = sorted(medians)
    half, run = sum(w for _, w in medians) / 2, 0
    for key, w in medians:
        run += w
        if run >= half:
            return key
    raise ValueError("no medians")


def cutoff(keys: DataFrame, k: int) -> tuple[tuple, int, int]:
    """(the k-th smallest key, how many keys lie below it, rounds).  ``keys``: a written
    table of the columns a, b, c that has at least ``k`` rows, k >= 1."""
    low = high = pivot = None
    before, rounds = 0, 0           # keys that are at most ``low``
    while True:
        rounds += 1
        found = _round(keys, low, high, pivot)
        if pivot is not None:
            under = sum(r["n"] for r in found if r["side"] < 0)
            equal = sum(r["equal"] for r in found)
            if before + under < k <= before + under + equal:
                return pivot, before + under, rounds
            side = -1 if k <= before + under else 1
            if side < 0:
                high = pivot
            else:
                low, before = pivot, before + under + equal
            found = [r for r in found if r["side"] == side]
        medians = [((r["a"], r["b"], r["c"]), r["n"]) for r in found if r["n"]]
        pivot = weighted_median(medians)


def draw(rows: DataFrame, eligible: Column, n: int) -> DataFrame:
    """``rows`` (a written table with the columns of `scored`) with ``rank``: 1 to ``n`` for
    the first ``n`` eligible rows of the order, null for the others."""
    no_rank = F.lit(None).cast("long")
    if n < 1:
        return rows.withColumn("rank", no_rank)
    keys = materialize(rows.filter(eligible).select(*_as_key()).sortWithinPartitions("a"), "draw-keys")
    (x, y, z), _, _ = cutoff(keys, n)
    a, b, c = _as_key()
    first = F.coalesce(eligible & ((a < x) | ((a == x) & ((b < y) | ((b == y) & (c <= z))))), F.lit(False))
    # rows equal to the cutoff key come last in the order; those beyond n aren't drawn
    won = with_global_position(rows.filter(first), _ORDER(), "rank")
    return (won.withColumn("rank", F.when(F.col("rank") <= n, F.col("rank")))
            .unionByName(rows.filter(~first).withColumn("rank", no_rank)))


def resample(docs: DataFrame, target: DataFrame, id_col: str, text_col: str, target_col: str, share: int = SHARE,
             min_words: int = MIN_WORDS, grams: int = GRAMS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(key, n_words, n_features, weight, score, rank) of every document; ``rank`` is null
    for those not drawn.  Of the documents with ``min_words`` words, ``share`` per cent are drawn."""
    gain = gains(bucket_counts(docs, text_col, grams, buckets), bucket_counts(target, target_col, grams, buckets))
    rows = materialize(scored(docs, id_col, text_col, gain, grams, seed), "draw-scores")
    enough = F.col("n_words") >= min_words
    return draw(rows, enough, rows.filter(enough).count() * share // 100)
