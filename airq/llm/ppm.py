"""Language-model scores: prediction by partial matching over bytes.

The model is a byte-context trie of fixed order: for every context of up to
``order`` symbols, how often each next symbol followed it in the training
documents.  A symbol is looked up in the longest seen context; if it never
followed there, an escape is paid and the next shorter context is tried.

* Escape estimation (method D): with T occurrences and D distinct symbols left in
  a context, the escape has probability D / 2T and a symbol seen n times
  (2n - 1) / 2T.
* Symbol exclusion: symbols already ruled out by a longer context leave the
  counts T and D of the shorter ones, so no probability is spent on them.
* Below order 0 the symbols never seen share what is left evenly.

A text is coded as its bytes (A-Z lower-cased) followed by an end symbol; its
first bytes are coded after ``order`` end symbols.  The code length is kept per
document as log10 probability.

Training counts cover every training document and are never pruned.  The trie
isn't broadcast: contexts are dealt into buckets by their last three symbols, so
that a bucket holds all orders from three up for its contexts (`blocks.exchange`).
Only the counts of orders 0 to 2 are shared with every task; they have at most
257 ** 3 cells whatever the corpus is.

``adaptive_code_lengths`` codes each document with a trie that starts empty and
learns as it goes; it needs no corpus.

Edge cases: a null text counts as empty (its end symbol is still coded); an empty
table gives an empty result; without training documents every symbol costs
log10(257); rows that repeat are scored each; a null id takes the remainder of the
empty string; columns beyond id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import blocks
from .blocks import block_count, block_of, gather, pack_by_bucket, text_bytes
from .text import KeyIndex, U64, lower_bytes, raw, slices, sorted_distinct, string_column, words

ORDER = 5
BITS = U64(9)
END = 256
ALPHABET = 257
SHARED = 2  # orders up to this one are broadcast
GRAMS, WORDS = 0, 1


def _mask(symbols: int):
    return U64((1 << (9 * symbols)) - 1)


def symbol_codes(col: pa.StringArray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(code of every coded symbol with its ``order`` predecessors, offsets per
    text).  Low 9 bits: the symbol; above: the context, nearest symbol lowest."""
    buf, off = raw(col)
    buf = lower_bytes(buf)
    n = len(off) - 1
    size = np.diff(off)
    shift = np.repeat(np.arange(n) * (order + 1) + order, size)
    sym = np.full(len(buf) + n * (order + 1), END, np.uint64)
    sym[np.arange(len(buf)) + shift] = buf
    at = np.arange(len(buf) + n) + np.repeat((np.arange(n) + 1) * order, size + 1)
    code = sym[at]
    for k in range(1, order + 1):
        code |= sym[at - k] << U64(9 * k)
    return code, np.concatenate([[0], np.cumsum(size + 1)])


class Level:
    """Counts of one order: grams, their contexts, and what excluding a
    context's symbols takes away from the next shorter context."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.grams, self.counts = grams, counts
        ctx = grams >> BITS
        new = np.concatenate([[True], ctx[1:] != ctx[:-1]]) if len(ctx) else np.zeros(0, bool)
        self.ctx, self.of = ctx[new], np.cumsum(new) - 1
        self.total = np.bincount(self.of, weights=counts, minlength=len(self.ctx))
        self.distinct = np.bincount(self.of, minlength=len(self.ctx))
        self.taken = np.zeros(len(self.ctx))

    def link(self, shorter: "Level", order: int) -> None:
        at = np.searchsorted(shorter.grams, self.grams & _mask(order))
        self.taken = np.bincount(self.of, weights=shorter.counts[at], minlength=len(self.ctx))


def _find(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.full(len(x), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return np.where(keys[at] == x, at, -1)


def marginal(grams: np.ndarray, counts: np.ndarray, order: int) -> Level:
    """The level of ``order`` from the counts of a longer one."""
    short = grams & _mask(order + 1)
    by = np.argsort(short, kind="stable")
    short, counts = short[by], counts[by]
    new = np.flatnonzero(np.concatenate([[True], short[1:] != short[:-1]])) if len(short) else np.zeros(0, int)
    return Level(short[new], np.add.reduceat(counts, new) if len(new) else counts)


def shared_levels(grams: np.ndarray, counts: np.ndarray) -> list[Level]:
    """Levels 0 .. SHARED, linked, from the counts of order SHARED."""
    levels = [marginal(grams, counts, k) for k in range(SHARED + 1)]
    for k in range(1, SHARED + 1):
        levels[k].link(levels[k - 1], k)
    return levels


def log10_probability(query: np.ndarray, grams: np.ndarray, counts: np.ndarray, shared: list[Level], order: int) -> np.ndarray:
    """log10 P(symbol | context) of each (order + 1)-gram in ``query``, given the
    training counts of all grams whose contexts end like theirs."""
    levels = list(shared) + [marginal(grams, counts, k) for k in range(SHARED + 1, order + 1)]
    for k in range(SHARED + 1, order + 1):
        levels[k].link(levels[k - 1], k)
    logp = np.zeros(len(query))
    active = np.ones(len(query), bool)
    out_sum, out_n = np.zeros(len(query)), np.zeros(len(query))
    with np.errstate(divide="ignore", invalid="ignore"):
        for k in range(order, -1, -1):
            level = levels[k]
            gram = query & _mask(k + 1)
            c = _find(level.ctx, gram >> BITS)
            g = _find(level.grams, gram)
            seen = active & (c >= 0)
            total = level.total[c] - out_sum if len(level.ctx) else out_sum
            left = level.distinct[c] - out_n if len(level.ctx) else out_n
            hit = seen & (g >= 0)
            logp[hit] += np.log10((level.counts[g[hit]] - 0.5) / total[hit])
            miss = seen & (g < 0)
            pay = miss & (left > 0)
            logp[pay] += np.log10(0.5 * left[pay] / total[pay])
            if miss.any():
                out_sum[miss] = level.taken[c[miss]]
                out_n[miss] = level.distinct[c[miss]]
            active &= ~hit
    logp[active] -= np.log10(ALPHABET - out_n[active])
    return logp


def _short_counts(order: int):
    """Per batch, counts of (SHARED + 1)-grams of the training texts."""

    def run(batches):
        for batch in batches:
            col = string_column(batch.column(0))
            for a, b in slices(col):
                codes, _ = symbol_codes(col.slice(a, b - a), SHARED)
                s = np.sort(codes)
                new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s[new].astype(np.int64)), pa.array(np.diff(np.append(new, len(s))).astype(np.int64))], ["gram", "n"])

    return run


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = np.sort(codes)
    new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, int)
    return s[new], np.diff(np.append(new, len(s)))


def _keys_and_counts(trained: list, other: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a block with their counts in its training texts, from the
    slices' counted keys (``trained``) and distinct keys (``other``)."""
    pairs = [(k, n[None, :]) for k, n in trained] + [(k, np.zeros((1, len(k)), np.int64)) for k in other]
    if not sum(len(k) for k, _ in pairs):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    keys, counts = blocks.merge(pairs)
    return keys, counts[0]


def _route(part: int, keys: np.ndarray) -> np.ndarray:
    return (keys >> BITS) & _mask(SHARED + 1) if part == GRAMS else keys


def score_documents(docs: DataFrame, id_col: str, text_col: str, held_out, order: int = ORDER,
                    block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """Score every text with the model of the texts that aren't ``held_out``.

    Returns (key, held_out, n_words, n_known_words, log10_counts, new_words,
    log10_p): ``log10_p`` is the model's log10 probability; the rest serves a
    word-frequency baseline: how many words occur in training texts, the sum of
    log10(c + 0.1) over the words, and on one row per block the number of
    training words whose first block it is (their sum is the vocabulary).
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), held_out.alias("held_out"))
    key_type = own.schema["key"].dataType.simpleString()
    n_blocks = n_buckets = block_count(text_bytes(own, "text"), block_bytes)

    short = (own.filter(~F.col("held_out")).select("text").mapInArrow(_short_counts(order), "gram long, n long")
             .groupBy("gram").agg(F.sum("n").alias("n")).orderBy("gram").toPandas())  # at most 257 ** 3 rows
    shared = spark.sparkContext.broadcast(
        shared_levels(short["gram"].to_numpy().astype(U64), short["n"].to_numpy().astype(np.int64)))

    def scan(table):
        col = string_column(table["text"])
        held = table["held_out"].to_numpy(zero_copy_only=False).astype(bool) if len(table) else np.zeros(0, bool)
        for a, b in slices(col):
            part = col.slice(a, b - a)
            yield a, b, held[a:b], symbol_codes(part, order), words(part)

    def keys_of(table):
        seen = {GRAMS: ([], []), WORDS: ([], [])}
        for _, _, held, (codes, first), w in scan(table):
            for part, values, size in ((GRAMS, codes, np.diff(first)), (WORDS, w.hash, np.diff(w.first))):
                out = np.repeat(held, size)
                seen[part][0].append(_counted(values[~out]))
                seen[part][1].append(sorted_distinct(values[out]))
        return {part: _keys_and_counts(*lists) for part, lists in seen.items()}

    def extract(block, table):
        for part, (keys, counts) in keys_of(table).items():
            yield pack_by_bucket(block, part, keys, counts[None, :], _route(part, keys), n_buckets)

    def resolve(parts):
        out = {}
        if GRAMS in parts:
            by = parts[GRAMS]
            keys, counts = blocks.merge(list(by.values()))
            trained = counts[0] > 0
            logp = log10_probability(keys, keys[trained], counts[0][trained], shared.value, order).astype(np.float32)
            out[GRAMS] = {b: logp[np.searchsorted(keys, k)] for b, (k, _) in by.items()}
        if WORDS in parts:
            by = parts[WORDS]
            keys, counts = blocks.merge(list(by.values()))
            out[WORDS], claimed = {}, np.zeros(len(keys), bool)
            for b in sorted(by):
                at = np.searchsorted(keys, by[b][0])
                c = counts[0][at]
                mine = (c > 0) & ~claimed[at]
                claimed[at] = True
                out[WORDS][b] = c * 2 + mine
        return out

    def score(block, table, vals):
        n = len(table)
        grams, word_keys = [], []
        for _, _, _, (codes, _), w in scan(table):
            grams.append(sorted_distinct(codes))
            word_keys.append(sorted_distinct(w.hash))
        gram_keys = sorted_distinct(np.concatenate(grams)) if grams else np.zeros(0, U64)
        word_keys = sorted_distinct(np.concatenate(word_keys)) if word_keys else np.zeros(0, U64)
        logp = gather(gram_keys, _route(GRAMS, gram_keys), n_buckets, vals.get(GRAMS, {}), np.float32)
        packed = gather(word_keys, word_keys, n_buckets, vals.get(WORDS, {}), np.int64)
        count, new = packed >> 1, int((packed & 1).sum())
        log_c = np.log10(count + 0.1)
        gi, wi = KeyIndex(gram_keys), KeyIndex(word_keys)
        cols = {k: np.zeros(n) for k in ("n_words", "n_known_words", "log10_counts", "log10_p")}
        for a, b, _, (codes, first), w in scan(table):
            m = b - a
            of = np.repeat(np.arange(m), np.diff(first))
            cols["log10_p"][a:b] = np.bincount(of, weights=logp[gi.find(codes)].astype(np.float64), minlength=m)
            of, at = np.repeat(np.arange(m), np.diff(w.first)), wi.find(w.hash)
            cols["n_words"][a:b] = np.diff(w.first)
            cols["n_known_words"][a:b] = np.bincount(of, weights=count[at] > 0, minlength=m)
            cols["log10_counts"][a:b] = np.bincount(of, weights=log_c[at], minlength=m)
        first_row = np.zeros(n, np.int64)
        first_row[:1] = new
        return pa.table({
            "key": table["key"], "held_out": table["held_out"],
            "n_words": cols["n_words"].astype(np.int64), "n_known_words": cols["n_known_words"].astype(np.int64),
            "log10_counts": cols["log10_counts"], "new_words": first_row, "log10_p": cols["log10_p"],
        })

    dealt = own.withColumn("block", block_of(n_blocks, "key", "text"))
    return blocks.exchange(dealt, n_buckets, extract, resolve, score,
                           f"key {key_type}, held_out boolean, n_words long, n_known_words long, log10_counts double, new_words long, log10_p double")


def adaptive_code_lengths(docs: DataFrame, id_col: str, text_col: str, order: int = ORDER) -> DataFrame:
    """(key, n_bytes, log10_p): each text coded by a trie that starts empty and
    learns its symbols one by one; same escapes and exclusion.  Work grows with
    the text's length only; memory with one text."""
    own = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def code(text: str) -> float:
        data = [END] * order + list(text.encode("utf-8", "surrogatepass").translate(bytes(lower_bytes(np.arange(256, dtype=np.uint8))))) + [END]
        trie: dict = {}
        total = 0.0
        for p in range(order, len(data)):
            s, out, found = data[p], set(), False
            for k in range(order, -1, -1):
                node = trie.get(tuple(data[p - k:p]))
                if not node:
                    continue
                left = {x: n for x, n in node.items() if x not in out}
                if s in left:
                    total += np.log10((left[s] - 0.5) / sum(left.values()))
                    found = True
                    break
                if left:
                    total += np.log10(0.5 * len(left) / sum(left.values()))
                out = set(node)
            if not found:
                total -= np.log10(ALPHABET - len(out))
            for k in range(order + 1):
                node = trie.setdefault(tuple(data[p - k:p]), {})
                node[s] = node.get(s, 0) + 1
        return total

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                 pa.array([code(t) for t in texts], pa.float64())], ["key", "n_bytes", "log10_p"])

    return own.mapInArrow(run, f"key {own.schema['key'].dataType.simpleString()}, n_bytes long, log10_p double")
