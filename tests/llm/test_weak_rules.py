import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from airq.llm import weak_rules as R
from airq.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import same_rows

SCHEMA = "doc_id long, text string, word int, quality string"
PROSE = "Some words that differ stand here, one after the other. " + " ".join(f"term{chr(97 + k % 26)}{chr(97 + k // 26)}." for k in range(60))


def by_hand(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n = Counter(windows)
    repeated = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated))


def rows(spark, texts):
    return spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(texts)], SCHEMA)


TEXTS = [None, "", " \t\n", "one", "a b c d e f g", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "x " * 40, "a\nb\na\n \na", "#$ é|<é> ",
         "l1 w\n\nl1 w\nl2", "Größe über\x0ballem\x0cund mehr", ("p q r s t u v w " * 3 + "z ") * 2, "ab " * 7 + "c", "w" * 5000, "k l m n o p q r " * 3000]


def test_counts_equal_brute_force(spark):
    got = {r["key"]: tuple(r[c] for c in R.COUNTS) for r in R.counts(rows(spark, TEXTS), "doc_id", "text").collect()}
    assert got == {i: by_hand(t) for i, t in enumerate(TEXTS)}


def test_query_equals_sql(spark, oracle):
    same_rows(QUERIES["op11_weak_rules"](spark, SF_SMALL), *oracle(SF_SMALL, ORACLE["op11_weak_rules"]))


def test_rules_abstain_on_missing_features(spark):
    r = R.counts(rows(spark, [None, ""]), "doc_id", "text").select(*R.votes()).collect()
    assert all([x["vote_short"], sum(x)] == [True, 1] for x in r)


def patterns(spark, counted):
    rows = [tuple(name in p for name, *_ in R.RULES) + (n,) for p, n in counted.items()]
    return spark.createDataFrame(rows, ", ".join(f"{v} boolean" for v in R.VOTES) + ", n long")


MERITS = ("long_enough", "sentences", "varied", "usual_word_length")


def test_estimates_find_planted_rates(spark):
    """Votes drawn from known rates: the estimates come near, without a label."""
    import itertools
    rates = {"symbols": (0.01, 0.7), "capitals": (0.02, 0.6), "monotone": (0.01, 0.5), "varied": (0.95, 0.2), "sentences": (0.9, 0.3)}
    counted = {}
    for on in itertools.product((0, 1), repeat=len(rates)):
        good = bad = 1.0
        for k, (g, b) in zip(on, rates.values()):
            good, bad = good * (g if k else 1 - g), bad * (b if k else 1 - b)
        counted[tuple(n for n, k in zip(rates, on) if k)] = round(100_000 * (0.75 * good + 0.25 * bad))
    model = R.fit(patterns(spark, counted), iterations=60)
    acc = R.accuracies(model)
    got = {name: r for (name, *_), r in zip(R.RULES, model["rates"])}
    # evidence from abstentions isn't used: the share comes out smaller, the order of the rules doesn't change
    assert 0.5 < model["good"] < 0.9
    for name in ("symbols", "capitals", "monotone"):
        assert acc[name] > 0.9 and got[name][1] > 10 * got[name][0]
    assert got["varied"][0] > got["varied"][1] and got["sentences"][0] > got["sentences"][1]


def test_a_rule_that_clean_documents_set_off_is_outvoted(spark):
    """All-must-pass would reject every document the noisy rule votes on."""
    clean, faults = MERITS, ("symbols", "capitals")
    counted = {clean: 8000, (*clean, "long_word"): 900, ("symbols", "capitals", "long_word"): 5, faults: 600, ("symbols", "monotone"): 400}
    model = R.fit(patterns(spark, counted))
    q = {r["n"]: r["q"] for r in patterns(spark, counted).withColumn("q", R.posterior(model)).collect()}
    assert q[8000] > 0.9 and q[900] > 0.5 and q[600] < 0.1 and q[400] < 0.1
    assert R.accuracies(model)["long_word"] < 0.5 < R.accuracies(model)["symbols"]


def test_order_and_partitions_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    one = R.judge(docs, "doc_id", "text").collect()
    many = R.judge(docs.repartition(13).sort(F.rand(3)), "doc_id", "text").collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


def test_empty_table_repeated_rows_null_ids_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert R.judge(empty, "doc_id", "text").collect() == []
    docs = spark.createDataFrame([(None, PROSE, 1, "q"), (None, PROSE, 1, "q"), (5, None, None, None)], SCHEMA)
    docs = docs.withColumns({c: F.lit("own") for c in ("key", "n", "vote_short", "t", "h")})
    got = R.judge(docs, "doc_id", "text").collect()
    assert sorted((r["key"] is None, r["n_words"]) for r in got) == [(False, 0), (True, by_hand(PROSE)[0]), (True, by_hand(PROSE)[0])]
    assert len({r["quality"] for r in got if r["key"] is None}) == 1


@pytest.mark.parametrize("text, bad", [("||| " * 60, True), (PROSE, False)])
def test_planted_documents(spark, text, bad):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").union(
        spark.createDataFrame([(-1, text)], "doc_id long, text string"))
    q = R.judge(docs, "doc_id", "text").filter("key = -1").first()["quality"]
    assert (q < R.KEEP_AT) == bad
