import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from airq.llm import resampling as S
from airq.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import same_rows


def grams(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return [zlib.crc32(x.encode()) % S.BUCKETS for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


TEXTS = ["", " .,;", "One", "one TWO three", "ÄÖ é中 x-y_z", "a" * 300 + " b " + "c" * 70 + " " + "d" * 64 + " " + "e" * 65, "w1 " * 500, "\x7f{x}~y",
         " ".join(f"t{k}" for k in range(3000))]


def test_features_equal_zlib():
    bucket, text, words = S.features(pa.array(TEXTS))
    for i, t in enumerate(TEXTS):
        assert sorted(bucket[text == i].tolist()) == sorted(grams(t))
    assert words.tolist() == [(len(grams(t)) + 1) // 2 for t in TEXTS]


def by_hand(docs, target, share=25, min_words=20):
    s, t = np.zeros(S.BUCKETS, int), np.zeros(S.BUCKETS, int)
    for _, x in docs:
        np.add.at(s, grams(x), 1)
    for x in target:
        np.add.at(t, grams(x), 1)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (t_s + S.BUCKETS) / ((s[b] + 1) * (t_t + S.BUCKETS)))) for t_s, t_t in [(int(s.sum()), int(t.sum()))] for b in range(S.BUCKETS)]
    rows = []
    for i, x in docs:
        g = grams(x)
        weight = sum(gain[b] for b in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    can = sorted((r for r in rows if (r[1] + 1) // 2 >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(can[:share * len(can) // 100], 1):
        r[4] = k
    return sorted(map(tuple, rows), key=repr)


def drawn(spark, docs, target, **kw):
    d = spark.createDataFrame([(*r, "own", 1, 2) for r in docs], "doc_id long, text string, key string, score int, rank int").repartition(5)
    t = spark.createDataFrame([(x,) for x in target], "text string")
    got = S.resample(d, t, "doc_id", "text", "text", **kw)
    return sorted((tuple(r[c] for c in ("key", "n_features", "weight", "score", "rank")) for r in got.collect()), key=repr)


def corpus(n, seed=1):
    r = random.Random(seed)
    return [(i, " ".join(r.choice(("Alpha", "beta", "gamma", "delta", "eps-ilon", "Zêta")) + str(r.randrange(9)) for _ in range(r.choice((3, 19, 20, 40))))) for i in range(n)]


@pytest.mark.parametrize("n, share", [(3, 25), (40, 25), (150, 1), (150, 100), (150, 0), (150, 60)])
def test_equals_brute_force(spark, n, share):
    docs, target = corpus(n), ["alpha1 beta2 gamma3"] * 9 + [None, ""]
    assert drawn(spark, docs, target, share=share) == by_hand(docs, target, share=share)


def test_ties_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{k}" for k in range(25))
    docs = [(4, text)] * 60 + [(None, text)] * 30 + [(None, None), (9, ""), (4, text + " x")] + corpus(30)
    assert drawn(spark, docs, [text], share=50) == by_hand(docs, [text], share=50)


def test_empty_tables(spark):
    assert drawn(spark, [], ["a b"]) == []
    docs = corpus(30)
    assert drawn(spark, docs, []) == by_hand(docs, [])


@pytest.mark.parametrize("seed", range(6))
def test_cutoff_is_the_kth_key_within_few_rounds(spark, seed):
    r = random.Random(seed)
    rows = [(r.randrange(40 if seed % 2 else 10 ** 6), r.randrange(3), r.randrange(2)) for _ in range(3000)]
    keys = spark.createDataFrame(rows, "a long, b long, c long").repartition(7)
    # partitions of very different sizes: medians are weighted
    keys = keys.union(spark.createDataFrame([(-5, 0, k) for k in range(10)], "a long, b long, c long").coalesce(1))
    rows = sorted(rows + [(-5, 0, k) for k in range(10)])
    for k in (1, 2, 11, 1500, len(rows)):
        key, below, rounds = S.cutoff(keys, k)
        assert key == rows[k - 1] and below == sum(x < key for x in rows)
        # each round keeps three quarters at most
        assert rounds <= 2 + math.log(len(rows)) / math.log(4 / 3)


def test_weighted_median_keeps_a_guaranteed_share():
    r = random.Random(2)
    for _ in range(200):
        medians = [((r.randrange(50),), r.randrange(1, 1000)) for _ in range(r.randrange(1, 30))]
        m, total = S.weighted_median(medians), sum(w for _, w in medians)
        assert 2 * sum(w for k, w in medians if k <= m) >= total and 2 * sum(w for k, w in medians if k >= m) >= total


def test_query_equals_sql(spark, oracle):
    same_rows(QUERIES["op13_importance_draw"](spark, SF_SMALL), *oracle(SF_SMALL, ORACLE["op13_importance_draw"]))


def test_documents_like_the_target_are_drawn_first(spark):
    docs = corpus(400)
    like = [(1000 + k, "target words stand here in a row " * 4) for k in range(20)]
    got = drawn(spark, docs + like, ["target words stand here in a row"] * 300, share=10)
    ranked = [r for r in got if r[4] is not None]
    assert {i for i, *_ in like} <= {r[0] for r in ranked}
