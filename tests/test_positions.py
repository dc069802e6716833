import random

import pytest
from pyspark.sql import functions as F

from airq.operators.positions import sorted_by_ranges, with_global_position
from airq.operators.profile import factor_quantiles
from airq.plans.catalog import CATALOG
from airq.plans.checker import compare, duck
from airq.plans.oracle import ORACLE

from .conftest import SF_SMALL


@pytest.mark.parametrize("n", [0, 1, 7, 3000])
def test_positions_equal_a_global_sort(spark, n):
    r = random.Random(n)
    rows = [(r.choice([None, 1, 2, 3, 3, 3]), i, r.random()) for i in range(n)]
    df = spark.createDataFrame(rows, "a int, b long, c double").repartition(6)
    got = with_global_position(df, [F.col("a").desc_nulls_last(), "b"], "at", total="of").collect()
    want = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    assert [x[1] for x in sorted(got, key=lambda x: x["at"]) for x in [(0, x["b"])]] == [x[1] for x in want]
    assert sorted(x["at"] for x in got) == list(range(1, n + 1)) and {x["of"] for x in got} <= {n}


def test_a_value_that_all_rows_share_is_dealt_to_several_tasks(spark):
    df = spark.range(20_000).select(F.lit(1).alias("same"), "id")
    got = with_global_position(df, ["same"])
    assert got.agg(F.countDistinct("position")).first()[0] == 20_000
    assert got.select(F.max("position")).first()[0] == 20_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")    # 20,000 rows would fit one task
    try:
        parts = sorted_by_ranges(df, ["same"]).groupBy(F.shiftright("__place", 33)).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 1 and max(r["count"] for r in parts) < 15_000


def test_quantiles_stay_within_the_stated_error(spark):
    """A coarse sketch over many rows: ranks within n / accuracy of the exact ones."""
    r = random.Random(3)
    values = [round(r.random() ** 3 * 500, 3) for _ in range(40_000)]
    df = spark.createDataFrame([(v, 55.0, 1.0, 2.0, 10.0) for v in values], "pm2_5 double, relative_humidity_2m double, rain double, wind_speed_10m double, wind_direction_10m double")
    for accuracy in (100, 10_000):
        values.sort()
        for row in factor_quantiles(df.repartition(8), accuracy=accuracy).collect():
            for q, v in ((0.5, row["median"]), (0.9, row["p90"])):
                below, upto = sum(x < v for x in values), sum(x <= v for x in values)
                assert below - len(values) / accuracy <= q * len(values) <= upto + len(values) / accuracy


@pytest.mark.parametrize("name", ["sorted_readings", "global_split", "factor_quantiles", "aqi_vn_sql_functions"])
def test_queries_equal_sql(spark, name):
    r = compare(CATALOG[name](spark, SF_SMALL), duck(SF_SMALL), ORACLE[name])
    assert r["exact"], r
