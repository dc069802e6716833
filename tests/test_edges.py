"""Edge rows listed in FIXTURES.md §2."""

import math

import pytest
from pyspark.sql import functions as F

from airq.functions.profiles import VN_CONC_EDGES, VN_INDEX_EDGES
from airq.functions.subindex import sub_index
from airq.operators import aqi as A
from airq.operators import daily as D
from airq.operators.rolling import nowcast_12h, ozone_8h


@pytest.mark.parametrize("pollutant", sorted(VN_CONC_EDGES))
def test_every_breakpoint_and_neighbours(spark, pollutant):
    edges = VN_CONC_EDGES[pollutant]
    vals = []
    for e in edges:
        vals += [float(e), e + 0.01, max(e - 0.01, 0.0)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, c double")
    got = [r.s for r in df.select("i", sub_index("c", pollutant, "vn_stream").alias("s")).orderBy("i").collect()]
    for k, e in enumerate(edges):
        assert got[3 * k] == VN_INDEX_EDGES[k]            # a breakpoint scores its own index edge
    assert got[3 * (len(edges) - 1) + 1] == 500           # just above the top
    by_value = [g for _, g in sorted(zip(vals, got))]
    assert all(a <= b for a, b in zip(by_value, by_value[1:]))   # monotone in the concentration


def _nc(spark, values):
    rows = [("p", "d", t, v) for t, v in enumerate(values)]
    df = spark.createDataFrame(rows, "province string, district string, ep long, v double")
    return nowcast_12h(df, {"v": "nc"}).orderBy("ep").collect()[-1].nc


def test_nowcast_weight_ratio(spark):
    # min/max below 1/2 -> w = 1/2; at 1/2 -> 1/2; above -> the ratio itself
    assert _nc(spark, [10.0, 40.0]) == round((40 + 0.5 * 10) / 1.5, 2)
    assert _nc(spark, [20.0, 40.0]) == round((40 + 0.5 * 20) / 1.5, 2)
    w = 30.0 / 40.0
    assert math.isclose(_nc(spark, [30.0, 40.0]), round((40 + w * 30) / (1 + w), 2))


def test_nowcast_full_12h_window_only(spark):
    # the 13th hour back is outside the window
    vals = [1000.0] + [50.0] * 12
    assert _nc(spark, vals) == 50.0


def test_ozone_8h_all_null_frame_is_zero(spark):
    rows = [("p", "d", t, v) for t, v in enumerate([5.0, None, None, None, None, None, None, None, None, None])]
    df = spark.createDataFrame(rows, "province string, district string, ep long, o3 double")
    out = [r.o3_8h for r in ozone_8h(df).orderBy("ep").collect()]
    assert out[1] == 1.0 and out[-1] == 0.0          # 5/8 -> 1 (half-even of 0.625); empty frame -> 0


def test_daily_ozone_8h_above_400_is_dropped(spark):
    # 8-hour means of 900 exceed 400: the 8 h sub-index is dropped, the 1 h one stays
    rows = [("p", "d", t, None, None, 900.0, None, None, None) for t in range(10)]
    df = spark.createDataFrame(rows, "province string, district string, ep long, pm2_5 double, pm10 double, "
                                     "o3 double, no2 double, so2 double, co double")
    df = df.withColumn("event_time", F.expr("timestampadd(HOUR, ep, TIMESTAMP_NTZ'2024-01-01 00:00:00')"))
    out = D.daily_aqi(df).first()
    assert out.aqi_ozone == 350.0                    # 1 h: 900 in 800-1000 -> 300 + (100/200)*100
    assert out.aqi_daily == 500                      # PM missing -> 500 under the batch rule


def test_both_pm_missing_is_filtered(spark):
    df = spark.createDataFrame([("p", "d", 1, None, None, 10.0, None, None, None),
                                ("p", "d", 2, 5.0, None, 10.0, None, None, None)],
                               "province string, district string, ep long, pm2_5 double, pm10 double, "
                               "o3 double, no2 double, so2 double, co double")
    assert A.with_pm_present(df).count() == 1
