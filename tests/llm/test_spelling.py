import random
import zlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from airq.llm import spelling as S
from airq.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import same_rows


def classes(words, halvings=1):
    rows = []
    for w in words:
        size = len(w)
        for kind, m, end in ((S.REPLACE, size, size), (S.INSERT, size, size + 1), (S.INSERT, size - 1, size)):
            spans = [(0, end)]
            for _ in range(halvings):
                spans = [s for a, b in spans for s in (((a, (a + b) // 2), ((a + b) // 2, b)) if b - a > 1 else ((a, b),))]
            rows += [(w, kind, m, a, b) for a, b in spans]
    return rows


def one_edit(words):
    words, letters, out = set(words), set("".join(words)), set()
    for w in words:
        for p in range(len(w)):
            other = [w[:p] + w[p + 1:], *(w[:p] + c + w[p + 1:] for c in letters)]
            out |= {frozenset((w, x)) for x in other if x != w and x in words}
    return out


@pytest.mark.parametrize("seed", range(60))
def test_composition_equals_brute_force(seed):
    r = random.Random(seed)
    letters = "abé"[:1 + seed % 3]
    words = sorted({"".join(r.choice(letters) for _ in range(r.randint(3, 9))) for _ in range(r.randint(1, 80))})
    rows = classes(words, seed % 4)
    r.shuffle(rows)
    i, j = S.near_pairs(*map(list, zip(*rows)))
    got = [frozenset((rows[x][0], rows[y][0])) for x, y in zip(i, j)]
    assert len(got) == len(set(got))        # one path a pair
    assert set(got) == one_edit(words)


def test_acceptor_is_minimal_and_numbers_its_words():
    import numpy as np
    words = sorted({a + b + c for a in ("un", "re", "") for b in ("do", "load") for c in ("s", "ing", "ed", "")})
    chars = np.array([ord(c) for w in words for c in w], np.int64)
    off = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    a = S.Acceptor(np.zeros(len(words), np.int64), chars, off)
    found = []

    def walk(q, text, index):
        if a.final[q]:
            found.append((text, index))
        for e in range(a.first[q], a.first[q + 1]):
            walk(a.target[e], text + chr(a.label[e]), index + a.skip[e])

    walk(a.roots[0], "", 0)
    assert found == [(w, i) for i, w in enumerate(words)]
    # distinct right languages, the minimal number of states
    rights = {frozenset(w[len(p):] for w in words if w.startswith(p)) for w in words for p in (w[:k] for k in range(len(w) + 1))}
    assert len(a.final) == len(rights)


def by_hand(rows, length=S.LENGTH):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += len(run) >= length
    n = {w: c for w, c in n.items() if c >= 2}
    near = {w: set() for w in n}
    for a, b in map(tuple, one_edit(n)):
        near[a].add(b)
        near[b].add(a)
    best = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: b for w, b in best.items() if n[b] >= 10 * n[w]}
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return out


COLS = ("word", "form", "root", "n", "n_near", "form_n")


def corpus(seed=5, docs=120):
    r = random.Random(seed)
    base = ["".join(r.choice("abcdeéÿ") for _ in range(r.randint(7, 11))) for _ in range(40)] + ["grossartig", "aaaaaaaa"]
    rows = []
    for i in range(docs):
        words = [r.choice(base[:r.choice((3, 42))]) for _ in range(30)]
        for _ in range(6):
            w = r.choice(words)
            p = r.randrange(len(w))
            words.append(r.choice((w[:p] + w[p + 1:], w[:p] + r.choice("abcX") + w[p + 1:], w[:p] + r.choice("abÀ") + w[p:])))
        rows.append((i, " ".join(words) + ", Short x×yÀÿz."))
    return rows


@pytest.mark.parametrize("limit, bucket", [(20_000, 60_000), (3, 50)])
def test_variants_equal_brute_force(spark, limit, bucket):
    """Also where every group of more than three words has to be halved."""
    rows = corpus()
    got = S.variants(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", limit=limit, bucket=bucket)
    assert {tuple(r[c] for c in COLS) for r in got.collect()} == by_hand(rows)


def test_hot_groups_are_halved_until_they_fit(spark):
    """A third of the vocabulary shares its first half: no group above the limit stays that could be split."""
    words = [f"gemeinsam{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(2000)]
    words += ["".join(random.Random(i).choice("abcdefghijkl") for _ in range(12)) for i in range(4000)]
    v = spark.createDataFrame([(w, 2) for w in sorted(set(words))], "word string, n long")
    sizes = S.groups(v, limit=100).groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("b") - F.col("a")).alias("width"))
    assert sizes.filter("rows > 100 AND width > 1").isEmpty()
    assert sizes.filter("rows > 26 AND width = 1").isEmpty()
    assert S.near_words(v, limit=100, bucket=500).agg(F.sum("n_near")).first()[0] == 2 * len(one_edit(set(words)))


def test_chains_of_forms_reach_the_last(spark):
    text = " ".join(["wandern"] * 2 + ["wandere"] * 20 + ["wandered"] * 200 + ["wanderer"] * 2000 + ["wanderern"] * 20_000)
    rows = [(k, text) for k in range(2)]
    got = {tuple(r[c] for c in COLS) for r in S.variants(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", every=1 << 40).collect()}
    assert {(w, r) for w, _, r, *_ in got} == {(w, "wanderern") for w in ("wandern", "wandere", "wandered", "wanderer", "wanderern")}
    assert {w: f for w, f, *_ in got}["wanderern"] is None


def test_query_equals_sql(spark, oracle):
    same_rows(QUERIES["op12_spelling_variants"](spark, SF_SMALL), *oracle(SF_SMALL, ORACLE["op12_spelling_variants"]))


def test_edge_cases(spark):
    schema = "doc_id long, text string, word string, n int, key string, root string"
    assert S.variants(spark.createDataFrame([], schema), "doc_id", "text").collect() == []
    none = [(1, None), (2, ""), (None, "short wörd 1234567 Ābcdefgh")]
    assert S.variants(spark.createDataFrame([(*r, "w", 1, "k", "r") for r in none], schema), "doc_id", "text").collect() == []
    long_word = "ab" * 5000
    rows = [(None, "tiefgang tiefgang"), (None, "tiefgang tiefgang"), (7, f"{long_word} {long_word} {long_word}x {long_word}x"), (7, "TIEFGANG Äpfelbaum äpfelbaum")]
    got = S.variants(spark.createDataFrame([(*r, "w", 1, "k", "r") for r in rows], schema), "doc_id", "text", bucket=4)
    assert {tuple(r[c] for c in COLS) for r in got.collect()} == by_hand(rows)
