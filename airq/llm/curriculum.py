"""Mixing sources to target weights along a time-varying curriculum.

Three steps, all DataFrame operations:

1. **Targets.**  Sources weigh ``weights`` in turn (in order of their name's code
   points, null last) and share ``total_ratio`` of all words.  A target stops at
   ``cap`` times its source's size and the excess is shared again by weight.  That
   fixed point is a water level: with the sources ordered by size / weight,
   everything below the level takes its cap and the rest weight x level, so running
   sums over the (few) sources find it without iterating.
2. **Takes.**  A source's documents stand in a fixed pseudo-random order; document
   d covers the demand interval [a, a + size) and, in the second pass, the same
   interval shifted by the source's size.  It is taken for the part of
   [0, target) that its intervals cover, so the takes of a source add up to its
   target rounded down, and no document is taken more than ``cap`` <= 2 times.
3. **Positions.**  Source s draws at rate w_s(t) = b + (e - b) t over training time
   t in [0, 1]; b and e are the source's entry in ``schedules``, in turn.  Its
   integral b t + (e - b) t^2 / 2, scaled to end at the target, is the words drawn
   until t.  Inverting it at a document's cumulative demand gives the document's
   training position, once per pass.  `in_training_order` makes one row per pass
   and range-sorts them by position.

The running sums never put a source into one task: every document falls into one
of ``BINS`` bins of its hash, bins are summed first, and a window only covers one
(source, bin).  The windows over sources see one row per source.

Edge cases: null or empty text has size 0 and is never taken; a source of size 0
has target 0; an empty table gives an empty result; null sources form one source;
null ids are documents like others; repeated rows follow each other in the order
(ties only decide between equal rows); extra columns, whatever their names, are
kept as they are (the operator's own columns replace equally named ones).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
SCHEDULES = ((1.0, 1.0), (0.2, 1.8), (1.8, 0.2))
TOTAL_RATIO = 1.5
CAP = 2.0
BINS = 4096
OUT = ("size", "source_size", "target", "taken", "passes", "first_position")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _cycle(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, total_ratio: float = TOTAL_RATIO, cap: float = CAP,
                   schedules=SCHEDULES) -> DataFrame:
    """(source, source_size, target, begin, end_rate) from one row per source
    (source, source_size).  One row per source, so single-task windows are fine."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    s = (sizes.withColumn("i", F.row_number().over(order) - 1)
         .withColumn("weight", _cycle(weights, F.col("i")))
         .withColumn("begin", _cycle([b for b, _ in schedules], F.col("i")))
         .withColumn("end_rate", _cycle([e for _, e in schedules], F.col("i")))
         .withColumn("limit", F.col("source_size") * cap))
    by_ratio = W.orderBy((F.col("limit") / F.col("weight")).asc(), "i")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing).orderBy("i")
    demand = F.sum("source_size").over(whole) * total_ratio
    s = (s.withColumn("level", (demand - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
         .withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))).over(whole)))
    return s.select("source", "source_size", F.least(F.col("limit"), F.coalesce(F.col("level") * F.col("weight"), F.col("limit"))).alias("target"),
                    "begin", "end_rate")


def _clip(x: Column, size: Column) -> Column:
    return F.greatest(F.lit(0), F.least(x, size)).cast("long")


def position(demand: Column, target: Column, begin: Column, end: Column) -> Column:
    """Training time at which a source has drawn ``demand`` words: the root t of
    (b t + (e - b) t^2 / 2) / ((b + e) / 2) = demand / target."""
    area = F.try_divide((begin + end) / 2 * demand, target)
    root = begin + F.sqrt(F.greatest(F.lit(0.0), begin * begin + 2 * (end - begin) * area))
    return F.coalesce(F.try_divide(2 * area, root), F.lit(0.0))


def mix(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights=WEIGHTS, total_ratio: float = TOTAL_RATIO,
        cap: float = CAP, schedules=SCHEDULES, seed: int = 17, bins: int = BINS) -> DataFrame:
    """``docs`` with, per row: size, source_size, target (its source's), taken
    (words), passes array<struct<pass, words, position>>, first_position."""
    if not 0 < cap <= 2:
        raise ValueError("cap must be in (0, 2]: a document has two passes")
    if any(b < 0 or e < 0 or b + e <= 0 for b, e in schedules):
        raise ValueError("schedule rates must be non-negative and not both 0")
    if any(w <= 0 for w in weights):
        raise ValueError("weights must be positive")
    p = "mix_"
    while any(c.startswith(p) for c in docs.columns):
        p += "_"
    keep = [c for c in docs.columns if c not in OUT]
    source = F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("null"))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_col, source_col, text_col)]))
    d = (docs.select(*keep, source.alias(p + "key"), F.col(source_col).alias(p + "source"), word_count(F.col(text_col)).alias(p + "size"),
                     key.alias(p + "hash"))
         .withColumn(p + "bin", F.floor(F.conv(F.substring(p + "hash", 1, 4), 16, 10).cast("int") * bins / 65536).cast("int")))
    own, size = [F.col(p + "key"), F.col(p + "bin")], F.col(p + "size")
    # whole sums per (source, bin), then running sums over the bins of a source
    binned = d.groupBy(*own, F.col(p + "source")).agg(F.sum(size).alias("bin_size"))
    ahead = W.partitionBy(p + "key").orderBy(p + "bin").rowsBetween(W.unboundedPreceding, -1)
    sizes = binned.groupBy(F.col(p + "source").alias("source")).agg(F.sum("bin_size").alias("source_size"))
    targets = source_targets(sizes, weights, total_ratio, cap, schedules)
    targets = targets.select(F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")).alias(p + "key"),
                             *[F.col(c).alias(p + c) for c in ("source_size", "target", "begin", "end_rate")])
    starts = binned.select(*own, F.coalesce(F.sum("bin_size").over(ahead), F.lit(0)).alias(p + "start")).join(targets, p + "key")
    within = W.partitionBy(*own).orderBy(p + "hash").rowsBetween(W.unboundedPreceding, -1)
    d = d.withColumn(p + "ahead", F.coalesce(F.sum(size).over(within), F.lit(0))).join(starts, [p + "key", p + "bin"])
    target, a = F.col(p + "target"), F.col(p + "ahead") + F.col(p + "start")
    passes = []
    for k in (0, 1):
        at = a + F.lit(k) * F.col(p + "source_size")
        passes.append(F.struct(F.lit(k + 1).alias("pass"), _clip(F.floor(target) - at, size).alias("words"),
                               position(at.cast("double"), target, F.col(p + "begin"), F.col(p + "end_rate")).alias("position")))
    d = d.withColumn(p + "passes", F.filter(F.array(*passes), lambda x: x["words"] > 0))
    return d.select(*keep, size.alias("size"), F.col(p + "source_size").alias("source_size"), target.alias("target"),
                    F.aggregate(p + "passes", F.lit(0).cast("long"), lambda x, y: x + y["words"]).alias("taken"),
                    F.col(p + "passes").alias("passes"), F.get(F.col(p + "passes"), F.lit(0))["position"].alias("first_position"))


def in_training_order(mixed: DataFrame, id_col: str) -> DataFrame:
    """One row per document and pass, range-sorted by training position."""
    rows = mixed.select("*", F.explode("passes").alias("p_")).drop("passes", "first_position")
    return (rows.select(*[c for c in rows.columns if c != "p_"], F.col("p_.pass").alias("pass"), F.col("p_.words").alias("pass_words"),
                        F.col("p_.position").alias("position"))
            .orderBy("position", id_col, "pass"))
