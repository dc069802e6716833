import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from airq.llm import ppm, token_counts, toxicity
from airq.llm.queries import QUERIES, id_remainder

from ..conftest import SF_SMALL

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0d]+")
SCHEMA = "id long, body string, text string, key long, held_out int"


def texts(n=60, seed=0):
    rng = random.Random(seed)
    words = ["the", "Cat", "sat", "on", "a", "mat", "naïve", "日本", "zzz", "and"]
    out = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30))), "clash", 1, 2) for i in range(n)]
    return out + [(100, None, None, None, None), (101, "", "", 0, 0), (None, "the end", "x", 5, 1), (3, out[3][1], "x", 5, 1), (102, "q" * 5000, "x", 1, 1)]


def held(i, n=10):
    return zlib.crc32((str(i) if i is not None else "").encode()) % n == 0


def slow_ppm(train, text, order):
    """log10 P(text), symbol by symbol, from plain dictionaries."""
    trie = {}
    for t in train:
        s = [256] * order + list(t.translate(LOW).encode()) + [256]
        for p in range(order, len(s)):
            for k in range(order + 1):
                trie.setdefault(tuple(s[p - k:p]), Counter())[s[p]] += 1
    s = [256] * order + list(text.translate(LOW).encode()) + [256]
    total = 0.0
    for p in range(order, len(s)):
        out = set()
        for k in range(order, -1, -1):
            node = trie.get(tuple(s[p - k:p]))
            if node is None:
                continue
            left = {x: n for x, n in node.items() if x not in out}
            size = sum(left.values())
            if s[p] in left:
                total += math.log10((left[s[p]] - 0.5) / size)
                break
            if left:
                total += math.log10(0.5 * len(left) / size)
            out = set(node)
        else:
            total -= math.log10(257 - len(out))
    return total


@pytest.mark.parametrize("order", [3, 5])
def test_ppm_matches_brute_force(spark, order):
    rows = texts()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = ppm.score_documents(df, "id", "body", id_remainder("id", 10) == 0, order=order, block_bytes=500).collect()
    train = [t or "" for i, t, *_ in rows if not held(i)]
    known = Counter(w for t in train for w in WORD.findall(t.translate(LOW)))
    want = []
    for i, t, *_ in rows:
        w = WORD.findall((t or "").translate(LOW))
        want.append((i is None, i or 0, held(i), len(w), sum(1 for x in w if known[x]), sum(math.log10(known[x] + 0.1) for x in w), slow_ppm(train, t or "", order)))
    got = sorted((r["key"] is None, r["key"] or 0, r["held_out"], r["n_words"], r["n_known_words"], r["log10_counts"], r["log10_p"]) for r in got)
    for g, w in zip(got, sorted(want)):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=2e-6, abs=1e-5)


def test_ppm_vocabulary_is_counted_once(spark):
    rows = texts()
    got = ppm.score_documents(spark.createDataFrame(rows, SCHEMA), "id", "body", id_remainder("id", 10) == 0, block_bytes=400).agg(F.sum("new_words")).first()[0]
    assert got == len({w for i, t, *_ in rows if not held(i) for w in WORD.findall((t or "").translate(LOW))})


def test_ppm_probabilities_sum_to_one():
    train = ["abracadabra", "alakazam", "abba"]
    codes = [ppm.symbol_codes(pa.array(train), 5)[0]]
    g, n = ppm._counted(codes[0])
    shared = ppm.shared_levels(*(lambda m: (m.grams, m.counts))(ppm.marginal(g, n, 2)))
    import numpy as np

    for ctx in {int(x) >> 9 for x in g[::3]} | {0x1FF}:
        q = (np.uint64(ctx << 9) | np.arange(257, dtype=np.uint64))
        assert abs(10 ** ppm.log10_probability(q, g, n, shared, 5) @ np.ones(257) - 1) < 1e-9


def test_ppm_without_training_rows_and_empty(spark):
    df = spark.createDataFrame([(1, "abc")], "id long, body string")
    row = ppm.score_documents(df, "id", "body", F.lit(True)).first()
    assert row["log10_p"] == pytest.approx(-4 * math.log10(257)) and row["n_known_words"] == 0
    assert ppm.score_documents(df.limit(0), "id", "body", F.lit(True)).collect() == []


def test_adaptive_code_length_learns(spark):
    df = spark.createDataFrame([(1, "abcabcabcabc" * 20), (2, "abcabcabcabc"), (3, None)], "id long, body string")
    got = {r["key"]: r for r in ppm.adaptive_code_lengths(df, "id", "body").collect()}
    assert got[1]["log10_p"] / 241 > got[2]["log10_p"] / 13 and got[3]["log10_p"] == pytest.approx(-math.log10(257))


def test_op5_contract(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    train = [WORD.findall((r["text"] or "").translate(LOW)) for r in rows if not held(r["doc_id"])]
    c = Counter(w for t in train for w in t)
    c["\0"] = len(train)
    n, v = sum(c.values()), len(c)
    got = {r["doc_id"]: r for r in QUERIES["op5_ppm_score"](spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    for r in rows:
        w = WORD.findall((r["text"] or "").translate(LOW)) + ["\0"]
        g = got[r["doc_id"]]
        assert (g["n_tokens"], g["n_known"], g["train_tokens"], g["held_out"]) == (len(w), sum(1 for x in w if c[x]), n, held(r["doc_id"]))
        assert g["base_score"] == pytest.approx(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), rel=1e-9)


ODD = ["", "aaa aaaa aaaaaaaaaaaaa", "a<|endoftext|>b <|endoftext|> ", "  x\u0085 y\x1c\x1dz\t\n  \r\n", "²³½ⅷ x①", "é é 日本語 👍🏽 ​", "'s 'S don't I'LL we've",
       " 　 end  ", "x" * 5000, " " * 300, "\x00\x01", "ab́cd 12 34_5", "a\n\n\n b\n", "<|endoftext|><|endoftext|>", "ʼs ʰ ǅ ٣", "foo_bar __x__ a_"]


def test_token_counts_match_the_library(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(token_counts.VOCABULARY)
    docs = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()]
    rows = [(i, t, "c", 1, 1) for i, t in enumerate(ODD + docs)] + [(-1, None, "c", 1, 1), (None, "x y", "c", 1, 1), (0, "", "c", 1, 1)]
    got = token_counts.count_tokens(spark.createDataFrame(rows, SCHEMA), "id", "body", path, limit=7).collect()
    tok = Tokenizer.from_file(path)
    want = []
    for i, t, *_ in rows:
        k = len(tok.encode(t or "", add_special_tokens=False).ids)
        want.append((str(i), len((t or "").encode()), k, k > 7))
    assert sorted((str(r["key"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == sorted(want)
    assert token_counts.count_tokens(spark.createDataFrame([], SCHEMA), "id", "body", path).collect() == []


def test_token_counts_cache_limit_changes_nothing(monkeypatch):
    path = public_tokenizers.path(token_counts.VOCABULARY)
    want = token_counts.Counter(path).count(ODD)
    monkeypatch.setattr(token_counts, "CACHE", 3)
    monkeypatch.setattr(token_counts, "ROWS", 2)
    c = token_counts.Counter(path)
    assert [x for t in ODD for x in c.count([t])] == want


def planted(n=500, seed=2):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("abcdeinorst", k=rng.randint(2, 8))) for _ in range(600)]
    rude = ["gruxxo", "gruxxa", "gruxxor", "vlomp", "vlompish"]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.choice([5, 40, 400]))
        toxic = int(rng.random() < 0.2)
        if toxic:
            for _ in range(max(1, len(words) // 20)):
                words.insert(rng.randint(0, len(words)), rng.choice(rude))
        docs.append((i, " ".join(words), "x", 1, 1))
        labels.append((i, toxic))
    return docs, labels


def test_toxicity_finds_planted_expressions(spark):
    docs, labels = planted()
    d = spark.createDataFrame(docs + [(900, None, "x", 1, 1), (901, "", "x", 1, 1), (None, "gruxxo", "x", 1, 1), (902, "gruxx " * 20000, "x", 1, 1), docs[5]], SCHEMA)
    lab = spark.createDataFrame(labels + [(7, None), (None, 1), (5000, 1), labels[9]], "id long, toxic int")
    model = toxicity.fit(d, lab, "id", "body", "toxic", F.col("id") % 4 != 2)
    out = toxicity.score(d, "body", model)
    assert out.columns == ["id", "body", "text", "key", "held_out", "score"]
    got = [(r["id"], r["score"]) for r in out.collect()]
    assert len(got) == len(docs) + 5 and all(0 <= s <= 1 for _, s in got)
    score = dict(got)
    heldout = [i for i, _ in labels if i % 4 == 2]
    toxic, clean = [i for i in heldout if labels[i][1]], [i for i in heldout if not labels[i][1]]
    assert sum(score[i] >= 0.3 for i in toxic) >= 0.95 * len(toxic)
    assert sum(score[i] >= 0.3 for i in clean) <= 0.05 * len(clean)
    assert score[900] == score[901] < 0.3 and score[902] > 0.3 and score[None] > 0.3
    assert [s for i, s in got if i == docs[5][0]] == [score[docs[5][0]]] * 2


def test_toxicity_without_labels(spark):
    d = spark.createDataFrame([(1, "a b"), (2, None)], "id long, body string")
    lab = spark.createDataFrame([], "id long, toxic int")
    model = toxicity.fit(d, lab, "id", "body", "toxic", F.lit(True))
    assert [r["score"] for r in toxicity.score(d, "body", model).collect()] == [0.0, 0.0]
    assert toxicity.score(d.limit(0), "body", model).collect() == []


def test_kneser_ney_levels_are_distributions():
    import numpy as np

    codes, _ = toxicity.symbol_codes(pa.array(["banana", "bandana", "cabana", "ban"]), toxicity.ORDER)
    g, n = np.unique(codes, return_counts=True)
    m = toxicity.Model(g, n, np.where(np.arange(len(g)) % 3 == 0, n, 0))
    m.build()
    for ctx in {int(x) >> 9 for x in g[::4]}:
        q = np.uint64(ctx << 9) | np.arange(257, dtype=np.uint64)
        p = np.full(257, 1 / 257)
        for k, level in enumerate(m.shared):
            p = level.blend(q & toxicity._mask(min(k + 1, toxicity.ORDER + 1)), p)
        for level in m.classes:
            assert abs(level.blend(q, p).sum() - 1) < 1e-9
