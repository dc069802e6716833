"""Golden values for every rule profile (expected values derived by hand
from the published tables, written here as plain arithmetic)."""

import math

import pytest
from pyspark.sql import functions as F

from airq.functions.labels import epa_category, health_advice, vn_category, vn_color
from airq.functions.subindex import sub_index

NAN = float("nan")


def run(spark, values, pollutant, profile):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c double")
    rows = df.select("i", sub_index("c", pollutant, profile).alias("s")).orderBy("i").collect()
    return [r.s for r in rows]


def test_vn_stream_pm25(spark):
    vals = [None, -1.0, 0.0, 12.25, 25.0, 25.01, 37.5, 50.0, 80.0, 499.99, 500.0, 500.01, NAN]
    # 12.25 -> 2*12.25 = 24.5 -> half-even 24; 25 -> 50 (first bracket wins);
    # 25.01 -> 2*(0.01)+50 = 50.02 -> 50; 37.5 -> 75; 50 -> 100; 80 -> 150;
    # 499.99 -> (100/150)*149.99+400 = 499.99.. -> 500; above/NaN -> 500
    assert run(spark, vals, "pm25", "vn_stream") == [0, 0, 0, 24, 50, 50, 75, 100, 150, 500, 500, 500, 500]


def test_vn_o3_8h_top(spark):
    vals = [100.0, 400.0, 400.5, 210.0]
    assert run(spark, vals, "o3_8h", "vn_stream") == [50, 300, 500, 200]


def test_vn_keeps_missing(spark):
    assert run(spark, [None, 30.0], "pm10", "vn") == [None, 30]


def test_vn_batch_quirks(spark):
    # no NULL/negative guard: both fall through to 500; float results
    assert run(spark, [None, -1.0, 25.0, 60.0], "pm25", "vn_batch") == [500.0, 500.0, 50.0, 117.0]


def test_vn_warehouse_half_open(spark):
    got = run(spark, [0.0, 24.999, 25.0, 499.0, 500.0, -0.1, NAN, None], "pm25", "vn_warehouse")
    exp = [0.0, 24.999 * 50 / 25, 50.0, (499.0 - 350) * 100 / 150 + 400, None, None, None, None]
    for g, e in zip(got, exp):
        assert (g is None and e is None) or math.isclose(g, e, rel_tol=1e-12)


def test_epa_stepped_gaps(spark):
    # 12.05 sits in the gap between 12.0 and 12.1 -> 500; 0 counts as no data
    vals = [0.0, 12.0, 12.05, 12.1, 35.4, 600.0, None]
    assert run(spark, vals, "pm25", "epa_stepped") == [0, 50, 500, 51, 100, 500, 0]


def test_epa_pm25_continuous(spark):
    got = run(spark, [6.0, 12.0, 20.0, 600.0, -12.0], "pm25", "epa_pm25")
    exp = [25.0, 50.0, (49.0 / 23.4) * 8.0 + 51, 500.0, -50.0]
    assert all(math.isclose(g, e, rel_tol=1e-12) for g, e in zip(got, exp))


def test_labels(spark):
    df = spark.createDataFrame([(v,) for v in [None, 0, 1, 50, 51, 100, 150, 200, 300, 301]], "a int")
    rows = df.select(vn_category("a").alias("c"), vn_color("a").alias("k"), health_advice("a").alias("h"),
                     epa_category("a").alias("e")).collect()
    assert [r.c for r in rows] == ["Không xác định", "Không xác định", "Tốt", "Tốt", "Trung bình",
                                   "Trung bình", "Kém", "Xấu", "Rất xấu", "Nguy hại"]
    assert rows[2].k == "#00E400" and rows[-1].k == "#7E0023" and rows[0].k == "#CCCCCC"
    assert rows[-1].e == "Hazardous" and rows[0].h == "Không có dữ liệu"


@pytest.mark.parametrize("profile", ["vn_stream", "vn"])
def test_monotone_and_bounded(spark, profile):
    vals = [i * 7.3 for i in range(120)]
    got = [g for g in run(spark, vals, "pm10", profile)]
    assert all(0 <= g <= 500 for g in got)
    assert all(a <= b for a, b in zip(got, got[1:]))


def test_no_python_in_plan(spark):
    df = spark.range(10).select(sub_index(F.col("id").cast("double"), "co", "vn_stream"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
