"""Toxicity: two class-conditional Kneser-Ney models over the letters of words.

A word is coded symbol by symbol (its bytes and an end mark) given up to ``ORDER``
preceding symbols of the same word.  Each class, toxic and ordinary, has counts of
the highest order; what discounting leaves goes to one interpolated Kneser-Ney model
that both classes share, built from their joint counts at the highest order and
from distinct left contexts below it.  So an expression that is rare in a class, or
whose context the class has never seen, falls back to what both say alike and gives
no evidence, while one that is common in one class and absent from the other gives
much, even in words never seen whole.

A text's evidence is the difference of its two log-likelihoods, normalised by its
length in words.  As a few toxic words in a long text hardly move that mean, two
more readings of the same difference go with it: the largest of any word and how
many words exceed ``STRONG``.  A logistic curve turns the three into a score in
[0, 1].  Labels, language, source and id are never inputs.

The models are fitted on a bounded sample of the labelled texts: at most
``SAMPLE_ROWS`` rows, and about ``SAMPLE_BYTES`` of text, chosen by a hash of the
id.  Where the rows' texts exceed those bytes, each label gets half of them, plus what
the other leaves; a label keeps the texts that fit, in hash order (at least its shortest
one), and its rows weigh the more in the curve the fewer are kept.  The curve is calibrated on evidence that each half of the sample gives about the
other half; the final counts are those of the whole sample.  The number of distinct
letter runs, and so the size of the model every task gets, is bounded by the
sample's bytes.  Every whole text of the table is scored, in one pass without
a shuffle.

Edge cases: null and empty texts have no words and get the score of no evidence;
a label that is null or whose document is missing isn't used; several labels of
one document count as toxic if any is; with labels of one class only (or none) the
score is that class's share (0 without labels); repeated rows are scored each;
null ids are scored like others; an empty table gives an empty result; other
columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .blocks import KEY_SCHEMA, merge, pack, pack_by_bucket, unpack
from .ppm import BITS, _find, _mask, symbol_codes
from .text import U64, KeyIndex, returning_memory, slices, sorted_distinct, string_column, words

ORDER = 6
DISCOUNT = 0.9
STRONG = 4.0
SAMPLE_ROWS = 16_000
SAMPLE_BYTES = 48 << 20
STRIPES = 64
ALPHABET = 257


def distinct_words(col: pa.StringArray):
    """(Words, distinct word hashes in order, the distinct words as a string array)."""
    w = words(col)
    if not len(w.hash):
        return w, w.hash, pa.array([], pa.binary())
    keys, index = sorted_distinct(w.hash), None
    index = KeyIndex(keys)
    one = np.zeros(len(keys), np.int64)
    one[index.find(w.hash)] = np.arange(len(w.hash))  # any occurrence of each
    start, size = w.start[one], (w.end - w.start)[one]
    off = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(off[-1]) + np.repeat(start - off[:-1], size)
    text = pa.Array.from_buffers(pa.string(), len(keys), [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(w.buf[at])])
    return w, keys, text


@returning_memory
def _gram_counts(batches):
    """Counts of the letter runs in a batch's words, per ``part`` of its rows."""
    for batch in batches:
        col, part = string_column(batch.column("text")), batch.column("part").to_numpy()
        found = []
        for k in range(4):
            own = col.filter(pa.array(part == k))
            for a, b in slices(own):
                w, keys, text = distinct_words(own.slice(a, b - a))
                if not len(keys):
                    continue
                times = np.bincount(KeyIndex(keys).find(w.hash), minlength=len(keys))
                codes, first = symbol_codes(text, ORDER)
                weight = np.repeat(times, np.diff(first))
                order = np.argsort(codes, kind="stable")
                s = codes[order]
                new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
                n = np.add.reduceat(weight[order], new)
                counts = np.zeros((4, len(new)), np.int64)
                counts[k] = n
                found.append((s[new], counts))
        if found:
            keys, counts = merge(found)
            yield from pack_by_bucket(0, 0, keys, counts, keys, STRIPES).to_batches()


def _merged(table: pa.Table) -> pa.Table:
    """One packed row per stripe with the counts of all tasks."""
    rows = [(unpack(k, U64), unpack(c, np.uint32)) for k, c in zip(table["keys"].to_pylist(), table["counts"].to_pylist())]
    keys, counts = merge([(k, c.reshape(4, -1)) for k, c in rows])
    return pa.table({"keys": pa.array([pack(keys)], pa.binary()), "counts": pa.array([pack(counts.astype(np.uint32))], pa.binary())})


class _Level:
    """One order of a Kneser-Ney model: discounted shares of seen grams, and
    what each context leaves for the order below."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        keep = counts > 0
        grams, counts = grams[keep], counts[keep].astype(np.float64)
        ctx = grams >> BITS
        new = np.concatenate([[True], ctx[1:] != ctx[:-1]]) if len(ctx) else np.zeros(0, bool)
        of = np.cumsum(new) - 1
        total = np.bincount(of, weights=counts, minlength=int(new.sum()))
        # sorted arrays without hash tables: every worker holds the model, and queries come sorted
        self.grams, self.share = grams, (counts - DISCOUNT) / total[of] if len(of) else counts
        self.ctx, self.rest = ctx[new], DISCOUNT * np.bincount(of, minlength=len(total)) / total if len(of) else total

    def blend(self, query: np.ndarray, below: np.ndarray) -> np.ndarray:
        """P(symbol | context) of sorted grams, given the next shorter order's ``below``."""
        if not len(self.share):
            return below
        g, c = _find(self.grams, query), _find(self.ctx, query >> BITS)
        return np.where(c >= 0, np.where(g >= 0, self.share[g], 0.0) + self.rest[c] * below, below)


class Model:
    """The two classes' models and the curve from evidence to score.  It travels
    as its packed counts; a worker builds the tables when it first needs them."""

    def __init__(self, grams: np.ndarray, ordinary: np.ndarray, toxic: np.ndarray):
        order = np.argsort(grams, kind="stable")
        self.counts = grams[order], ordinary[order].astype(np.uint32), toxic[order].astype(np.uint32)
        self.weights, self.constant, self.built = None, 0.0, False

    def __getstate__(self):
        grams, ordinary, toxic = self.counts
        return pack(np.diff(grams, prepend=U64(0))), pack(ordinary), pack(toxic), self.weights, self.constant

    def __setstate__(self, state):
        steps, ordinary, toxic, self.weights, self.constant = state
        self.counts = np.cumsum(unpack(steps, U64), dtype=U64), unpack(ordinary, np.uint32), unpack(toxic, np.uint32)
        self.built = False

    def build(self) -> None:
        if self.built:
            return
        grams, ordinary, toxic = self.counts
        self.built = True
        self.classes = (_Level(grams, ordinary), _Level(grams, toxic))
        self.shared, longer = [], grams
        for k in range(ORDER - 1, -1, -1):
            short = np.sort(longer & _mask(k + 1))  # each distinct left context counts once
            new = np.flatnonzero(np.concatenate([[True], short[1:] != short[:-1]])) if len(short) else np.zeros(0, int)
            longer = short[new]
            self.shared.append(_Level(longer, np.diff(np.append(new, len(short)))))
        self.shared.reverse()
        self.shared.append(_Level(grams, ordinary + toxic))

    def evidence(self, grams: np.ndarray) -> np.ndarray:
        """log P(toxic) - log P(ordinary) of each gram's last symbol; grams are sorted and distinct."""
        self.build()
        shorter, p = np.zeros(1, U64), np.full(1, 1.0 / ALPHABET)
        for k, level in enumerate(self.shared):
            query = grams if k == ORDER else sorted_distinct(grams & _mask(k + 1))
            p = level.blend(query, p[KeyIndex(shorter).find(query & _mask(k))])
            shorter = query
        o, t = (level.blend(grams, p) for level in self.classes)
        return np.log(t) - np.log(o)

    def features(self, col: pa.StringArray) -> np.ndarray:
        """Per text: mean evidence per word, the largest, log(1 + strong words)."""
        w, keys, text = distinct_words(col)
        n = np.diff(w.first)
        out = np.zeros((len(col), 3))
        if not len(keys):
            return out
        codes, first = symbol_codes(text, ORDER)
        grams = sorted_distinct(codes)
        each = self.evidence(grams)[KeyIndex(grams).find(codes)]
        of_word = np.add.reduceat(each, first[:-1])[KeyIndex(keys).find(w.hash)]
        some = n > 0
        at = w.first[:-1][some]
        out[some, 0] = np.add.reduceat(of_word, at) / n[some]
        out[some, 1] = np.maximum.reduceat(of_word, at)
        out[some, 2] = np.log1p(np.add.reduceat((of_word > STRONG).astype(np.float64), at))
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))

    def calibrate(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """Logistic regression by Newton steps with a small ridge; ``weight`` is per row."""
        if not len(y) or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.0
            return
        a = np.column_stack([x, np.ones(len(x))])
        ridge = np.diag([0.1, 0.1, 0.1, 1e-6])
        w = np.zeros(4)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + ridge, a.T @ (weight * (y - p)) - ridge @ w)
            w += step / max(1.0, np.abs(step).max() / 3)
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w


def thinned(sample: DataFrame, size: dict[int, int], sample_bytes: int):
    """(rows of ``sample`` within ``sample_bytes``, weight per label): each label has
    half of the bytes and what the other leaves."""
    h = F.xxhash64("k_", F.lit(1))
    rows = sample.groupBy(h.alias("h"), "toxic").agg(F.sum(F.octet_length("text").cast("long")).alias("b"),
                                                     F.count(F.lit(1)).alias("n")).orderBy("h").collect()  # at most a row per id of the sample
    kept, weight = [], {}
    for label in size:
        own, some, left = [r for r in rows if r["toxic"] == label], [], max(sample_bytes // 2, sample_bytes - sum(size.values()) + size[label])
        for r in own:
            if r["b"] <= left:
                some.append(r)
                left -= r["b"]
        some = some or [min(own, key=lambda r: r["b"])]
        kept += [(r["h"],) for r in some]
        weight[label] = sum(r["n"] for r in own) / sum(r["n"] for r in some)
    kept = F.broadcast(sample.sparkSession.createDataFrame(kept, "h long"))
    return sample.join(kept, h == F.col("h"), "left_semi"), weight


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, train,
        sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on labelled rows for which ``train`` (a Column over ``id_col``) holds."""
    spark = docs.sparkSession
    marks = (labels.filter(train & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("k_"))
             .agg(F.max(F.col(label_col).cast("int")).alias("toxic")).withColumn("h_", F.xxhash64("k_"))
             .orderBy("h_", "k_").limit(sample_rows))
    # at most sample_rows rows of (id, label, hash): a proven bound for the broadcast
    own = docs.select(F.col(id_col).alias("k_"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sample = own.join(F.broadcast(marks), "k_")
    size = {r["toxic"]: r["b"] for r in sample.groupBy("toxic").agg(F.sum(F.octet_length("text").cast("long")).alias("b")).collect()}
    weight = dict.fromkeys(size, 1.0)
    if sum(size.values()) > sample_bytes:
        sample, weight = thinned(sample, size, sample_bytes)
    half = F.pmod(F.xxhash64("k_", F.lit(2)), F.lit(2)).cast("int")
    classes = (half * 2 + F.col("toxic")).alias("part")   # half and class of a row
    grams = (sample.select("text", classes).mapInArrow(_gram_counts, KEY_SCHEMA).groupBy("bucket")
             .applyInArrow(_merged, "keys binary, counts binary").collect())  # STRIPES rows, bounded by the sample
    key = np.concatenate([np.zeros(0, U64), *(unpack(r["keys"], U64) for r in grams)])
    o0, t0, o1, t1 = np.concatenate([np.zeros((4, 0), np.uint32), *(unpack(r["counts"], np.uint32).reshape(4, -1) for r in grams)], axis=1)
    model = Model(key, o0 + o1, t0 + t1)
    halves = spark.sparkContext.broadcast([Model(key[o + t > 0], o[o + t > 0], t[o + t > 0]) for o, t in ((o1, t1), (o0, t0))])

    @returning_memory
    def features(batches):
        for batch in batches:
            col = string_column(batch.column("text"))
            half = batch.column("half").to_numpy()
            for k in (0, 1):
                mine = pa.array(half == k)
                own, toxic = col.filter(mine), batch.column("toxic").filter(mine)
                for a, b in slices(own):
                    x = halves.value[k].features(own.slice(a, b - a))  # counted on the other half
                    yield pa.RecordBatch.from_arrays([*(pa.array(v) for v in x.T), toxic.slice(a, b - a)], ["a", "b", "c", "toxic"])

    x = sample.select("text", "toxic", half.alias("half")).mapInArrow(features, "a double, b double, c double, toxic int").toPandas()
    halves.destroy()
    toxic = x["toxic"].to_numpy()
    model.calibrate(x[["a", "b", "c"]].to_numpy(), toxic.astype(np.float64), np.array([weight[t] for t in toxic.tolist()], np.float64))
    return model


def score(docs: DataFrame, text_col: str, model: Model) -> DataFrame:
    """``docs`` with a double column ``score`` (replacing one of that name)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c != "score"]
    own = docs.select(*keep)
    at = keep.index(text_col)

    @returning_memory
    def run(batches):
        for batch in batches:
            col = string_column(batch.column(at))
            s = [shared.value.score(shared.value.features(col.slice(a, b - a))) for a, b in slices(col)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(s) if s else np.zeros(0))], [*keep, "score"])

    return own.mapInArrow(run, StructType([*own.schema.fields, StructField("score", DoubleType())]))
