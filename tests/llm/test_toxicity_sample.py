import random

from pyspark.sql import functions as F

from airq.llm import toxicity


def long_texts(spark, n=120, n_toxic=6):
    """Few toxic texts among many, about 4 KB each: two in a hundred of their words are rude."""
    rng = random.Random(4)
    plain = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(60)]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=700)
        toxic = int(i < n_toxic)
        for _ in range(14 * toxic):
            words.insert(rng.randint(0, len(words)), rng.choice(["gruxxo", "vlorpz", "zhrunk"]))
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    return (spark.createDataFrame(docs, "id long, body string").repartition(4), spark.createDataFrame(labels, "id long, toxic int"), docs)


def test_byte_bound_leaves_toxic_texts(spark):
    d, lab, docs = long_texts(spark)
    size = sum(len(t) for _, t in docs)
    model = toxicity.fit(d, lab, "id", "body", "toxic", F.lit(True), sample_bytes=size // 10)
    assert model.weights is not None  # both labels are in the sample
    score = {r["id"]: r["score"] for r in toxicity.score(d, "body", model).collect()}
    assert min(score[i] for i in range(6)) >= 0.3 > max(score[i] for i in range(6, 120))


def test_thinned_sample_per_label(spark):
    d = spark.createDataFrame([(i, "x" * 100, int(i % 10 == 0)) for i in range(200)] + [(500, "y" * 100_000, 1)], "k_ long, text string, toxic int")
    size = {0: 18_000, 1: 102_000}
    kept, weight = toxicity.thinned(d, size, 10_000)
    n = {r["toxic"]: r["count"] for r in kept.groupBy("toxic").count().collect()}
    assert n == {0: 50, 1: 20} and weight == {0: 180 / 50, 1: 21 / 20}  # one long text doesn't take its label's bytes
    kept, weight = toxicity.thinned(d.filter("k_ <> 500"), {0: 18_000, 1: 2_000}, 10_000)
    n = {r["toxic"]: r["count"] for r in kept.groupBy("toxic").count().collect()}
    assert n == {0: 80, 1: 20} and weight == {0: 180 / 80, 1: 1.0}  # toxic rows last
    kept, weight = toxicity.thinned(d, size, 10)
    assert {r["toxic"] for r in kept.collect()} == {0, 1}


def test_sample_is_not_cut():
    assert (toxicity.SAMPLE_ROWS, toxicity.SAMPLE_BYTES) == (16_000, 48 << 20)
