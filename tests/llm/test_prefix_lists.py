from collections import Counter

import pytest
from pyspark.sql import functions as F

from airq.llm import ngram_join

SPLIT = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}


@pytest.fixture
def split(spark):
    old = {k: spark.conf.get(k, None) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_list_is_no_single_task(spark, split):
    # 6,000 sets share shingle 7; every two share another; copies and sets without a prefix add nothing
    sets = [(i, 10, 1000 + i, [100_000 + i // 2, 7, 200_000 + i]) for i in range(6000)]
    rows = spark.createDataFrame(sets + sets[:50] + [(9, 10, 1000, []), (10, 0, 0, [])], "key long, n long, fp long, tokens array<long>").repartition(8)
    lists = ngram_join.prefix_lists(rows)
    got = [(r["token"], r["fp"], r["len"], r["n"], r["pos"]) for r in lists.collect()]
    want = [(t, fp, 6000 if t == 7 else 2, n, pos) for _, n, fp, tokens in sets for pos, t in enumerate(tokens) if t < 200_000]
    assert Counter(got) == Counter(want)
    lists = lists.withColumn("task", F.spark_partition_id()).collect()
    per_task = Counter(r["task"] for r in lists if r["token"] == 7)
    assert sum(per_task.values()) == 6000 and max(per_task.values()) < 3000
    assert "Window" not in ngram_join.prefix_lists(rows)._jdf.queryExecution().executedPlan().toString()
