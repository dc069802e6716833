import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from airq.llm import ngram_join
from airq.llm.components import components
from airq.llm.queries import QUERIES

from ..conftest import SF_SMALL

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "id long, body string, n long, component string, fp string, text int"


def shingle_set(t, size=5):
    w = re.findall(r"[^\x20\x09-\x0d]+", (t or "").translate(LOW))
    return frozenset(tuple(w[j:j + size]) for j in range(max(1, len(w) - size + 1))) if w else frozenset()


def brute(rows):
    """component per row position, as the smallest id."""
    sets = [shingle_set(t) for _, t in rows]
    lists = defaultdict(list)
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for i, s in enumerate(sets):
        seen = Counter(j for g in s for j in lists[g])
        for g in s:
            lists[g].append(i)
        for j, k in seen.items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        r = find(i)
        if key is not None and (least.get(r) is None or key < least[r]):
            least[r] = key
    return [(len(sets[i]), least.get(find(i)) if sets[i] else rows[i][0]) for i in range(len(rows))]


def corpus(seed=0):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(3000)]
    doc = lambda n: rng.choices(vocab, k=n)
    common = doc(60)
    out = []
    for _ in range(80):
        out.append(doc(rng.choice([1, 3, 5, 30, 120])) + (common if rng.random() < 0.5 else []))
    for rate in (0.005, 0.02, 0.04):  # groups of near copies, some links only through others
        base = doc(150)
        for _ in range(45):
            out.append([w if rng.random() > rate else rng.choice(vocab) for w in base])
    out += [list(out[3]) for _ in range(10)]
    rows = [(i, " ".join(w).title() if i % 2 else "\n".join(w)) for i, w in enumerate(out)]
    rng.shuffle(rows)
    return rows + [(5000, None), (5001, ""), (5002, " \t "), (None, rows[0][1]), (None, "alone here"), rows[4], (rows[5][0], "quite another text under the same id")]


@pytest.mark.parametrize("limits", [{}, {"list_limit": 4, "chunk": 7}])
def test_groups_match_brute_force(spark, limits):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1, "c", "f", 2) for i, t in rows], SCHEMA).repartition(6)
    got = ngram_join.similar_groups(df, "id", "body", **limits).collect()
    want = [(i, *b) for (i, _), b in zip(rows, brute(rows))]
    assert sorted((str(r["key"]), r["n_shingles"], str(r["component"])) for r in got) == sorted((str(a), b, str(c)) for a, b, c in want)


def test_table_matches_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op10_ngram_jaccard"](spark, SF_SMALL).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted((i, *b) for (i, _), b in zip(rows, brute(rows)))


def test_prefixes_keep_the_needed_matches():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(1)
    base = [f"w{k}" for k in range(100)]
    texts = [" ".join(w if rng.random() > 0.02 else "z" + str(rng.random()) for w in base) for _ in range(40)]
    h, first = ngram_join.distinct_shingles(pa.array(texts), 5)
    sketch = np.minimum(255, np.round(8 * np.log2(1.0 + np.bincount(ngram_join._cell(h), minlength=ngram_join.CELLS)))).astype(np.uint8)
    length, ranked = ngram_join.prefixes(h, first, sketch, 80)
    sets = [shingle_set(t) for t in texts]
    least = [len(s) - -(-len(s) * 80 // 100) for s in sets]
    assert length.tolist() == [n + ngram_join.MAX_MATCH for n in least]
    part = lambda i, k: set(ranked[first[i]:first[i] + least[i] + k].tolist())
    for i in range(40):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                assert all(len(part(i, a) & part(j, b)) >= min(a, b) for a in (1, 5, 16) for b in (1, 7, 16))


def test_matches_follow_cost(spark):
    """Sets on crowded lists ask for more matches, sets on short ones for one."""
    rows = [(1, 100, pos, 2) for pos in (0, 30)] + [(2, 100, pos, 30) for pos in range(36)] + [(3, 1, 0, 5)]
    got = ngram_join.matches_by_cost(spark.createDataFrame(rows, "fp long, n long, pos long, len long"), 80).collect()
    need = {r["fp"]: r["need"] for r in got}
    assert need[2] > 3 and need[3] == 1 and 1 <= need[1] <= ngram_join.MAX_MATCH


def test_empty_table(spark):
    assert ngram_join.similar_groups(spark.createDataFrame([], SCHEMA), "id", "body").collect() == []


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(40)] + [(100 + rng.randint(0, 30), 100 + rng.randint(0, 30)) for _ in range(25)] + [(200, k) for k in range(201, 240)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    parent = {}
    for a, b in edges:
        parent.setdefault(a, a), parent.setdefault(b, b)
    find = lambda a: a if parent[a] == a else find(parent[a])
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    want = {n: find(n) for e in edges if e[0] != e[1] for n in e}
    assert got == want
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").collect() == []


def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "mixing", "segmentation"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = docs.limit(3).union(docs.limit(1)).union(docs.limit(1).select(F.lit(None).cast("long"), F.lit(None).cast("string"), "lang", F.lit(None).cast("string"), "n_chars"))
    docs = docs.union(extra).withColumn("score", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("passes", F.lit(2))
    kept = []
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL).cache()
        kept.append(out)
        docs = out
    for out in kept[:2]:
        assert out.columns == list(corpus_pipeline.DOCUMENT)
    assert kept[2].columns == [*corpus_pipeline.DOCUMENT, *corpus_pipeline.ORDER]
    clean = kept[0].collect()
    groups = brute([(r["doc_id"], r["text"]) for r in clean])
    single = kept[1].collect()
    left = {(r["doc_id"], r["text"]) for r in single}
    assert len(left) == len(single)
    assert sorted(str(c) for _, c in brute([(r["doc_id"], r["text"]) for r in single])) == sorted({str(c) for _, c in groups})
    mixed = kept[2].collect()
    times = Counter((r["doc_id"], r["text"]) for r in mixed)
    assert set(times) <= left and max(times.values()) <= 2 and all(t.split() for _, t in times)
    ids = kept[3].groupBy("doc_id").agg(F.max("rank").alias("r")).collect()
    assert {r["doc_id"] for r in ids} == {i for i, _ in times}


def test_the_curriculum_survives_to_the_last_stage(spark):
    """Positions sort the segmentations into the mix's order, and passes differ."""
    docs = spark.createDataFrame([(i, f"some words of document {i} that are longer ones " * 3, "en", f"src{i % 2}", 9) for i in range(40)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    mixed = corpus_pipeline.mix_sources(spark, docs, SF_SMALL)
    order = [(r["doc_id"], r["pass"]) for r in mixed.collect()]          # in_training_order sorts
    assert max(p for _, p in order) == 2
    rows = corpus_pipeline.segment(spark, mixed.repartition(5), SF_SMALL).collect()
    first = sorted((r for r in rows if r["rank"] == 1), key=lambda r: (r["position"], r["doc_id"], r["pass"]))
    assert [(r["doc_id"], r["pass"]) for r in first] == order
    by = {(r["doc_id"], r["pass"], r["rank"]): r["ids"] for r in rows}
    twice = [i for i, p in order if p == 2]
    assert twice and all([by[i, 1, k] for k in (1, 2)] != [by[i, 2, k] for k in (1, 2)] for i in twice)


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.count() > 100 and "ids" in out.columns


def test_pipeline_on_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.collect() == []


def test_shares_of_very_large_sets_are_exact():
    """Sets of more than 170,000 shingles on either side of the threshold."""
    import numpy as np
    import pyarrow as pa

    n, shared = 225_000, 199_999        # one more makes exactly 80 %
    a = np.arange(n, dtype=np.int64)
    b = np.concatenate([np.arange(shared), 10 ** 7 + np.arange(n - shared)])
    for extra, linked in ((0, 100 * shared >= 80 * (2 * n - shared)), (1, 100 * (shared + 1) >= 80 * (2 * n - shared - 1))):
        b[shared:shared + extra] = a[shared:shared + extra]
        off = np.array([0, n, 2 * n], np.int32)
        t = pa.table({"fp": pa.array([1, 2]), "i": pa.array([0, 0]), "j": pa.array([0, 0]), "own": pa.array([0, 0]), "comp": pa.array([1, 2]),
                      "tokens": pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate([a, b])))})
        assert (ngram_join._compare_chunks(80)(t).num_rows == 1) == linked
