"""Sliced per-station windows equal whole-station windows, and a hot station
is spread over many (station, slice) groups."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from airq.operators import features as FE
from airq.operators import rolling as R
from airq.operators.slicing import N, RN, SLICE, own_rows, sliced_window, with_row_index, with_slices
from airq.sources.adapter import STATION_KEY, hourly_readings

from .conftest import SF_SMALL

KEY = STATION_KEY


@pytest.fixture(scope="module")
def readings(spark):
    return hourly_readings(spark, SF_SMALL).cache()


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("size", [1, 3, 50, 100000])
def test_row_index_equals_row_number(spark, readings, size):
    got = with_row_index(readings, KEY, "ep", size=size, count=True)
    w = Window.partitionBy(*KEY).orderBy("ep")
    want = readings.select(*KEY, "ep", F.row_number().over(w).alias(RN),
                           F.count(F.lit(1)).over(Window.partitionBy(*KEY)).alias(N))
    assert _rows(got, [*KEY, "ep", RN, N]) == _rows(want, [*KEY, "ep", RN, N])


@pytest.mark.parametrize("size", [1, 4, 13])
def test_sliced_operators_equal_unsliced(spark, readings, size):
    big = 10 ** 7      # one slice per station = the plain per-station window
    ops = [
        (lambda d, s: R.nowcast_12h(d, {"pm2_5": "nc"}, size=s), ["nc"]),
        (lambda d, s: R.nowcast_batch(d, {"pm10": "nb"}, size=s), ["nb"]),
        (lambda d, s: R.ozone_8h(d, size=s), ["o3_8h"]),
        (lambda d, s: R.trailing_mean(d, [("pm2_5", 24), ("co", 8)], size=s), ["avg_pm2_5_24h", "avg_co_8h"]),
        (lambda d, s: R.trailing_mean(d, [("no2", 3)], by="hours", size=s), ["avg_no2_3h"]),
    ]
    for op, cols in ops:
        a = _rows(op(readings, size), [*KEY, "ep", *cols])
        b = _rows(op(readings, big), [*KEY, "ep", *cols])
        assert a == b


def test_sliced_lead_and_lag(spark, readings):
    """Forward (lead) and backward (lag) frames across slice edges."""
    d = with_slices(with_row_index(readings, KEY, "ep", size=2), RN, back=3, fwd=2, size=2)
    w = sliced_window(KEY, RN)
    got = own_rows(d.select(*KEY, "ep", SLICE, "__own", F.lag("pm2_5", 3).over(w).alias("l3"),
                            F.lead("pm2_5", 2).over(w).alias("f2")))
    pw = Window.partitionBy(*KEY).orderBy("ep")
    want = readings.select(*KEY, "ep", F.lag("pm2_5", 3).over(pw).alias("l3"),
                           F.lead("pm2_5", 2).over(pw).alias("f2"))
    assert _rows(got, [*KEY, "ep", "l3", "f2"]) == _rows(want, [*KEY, "ep", "l3", "f2"])


def test_hot_station_is_split(spark, readings):
    """One station given a third of all rows (long history) is cut into
    slices: no (station, slice) group holds more than size + halo rows."""
    p, d = readings.select(*KEY).orderBy(*KEY).first()
    one = readings.filter((F.col("province") == p) & (F.col("district") == d))
    n_other = readings.count()
    n_one = one.count()
    copies = max(1, n_other // (2 * n_one))        # the station becomes ~1/3 of all rows
    span = 10 ** 5
    hot = one.withColumn("__k", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))) \
             .withColumn("ep", F.col("ep") + F.col("__k") * span).drop("__k")
    data = readings.unionByName(hot.select(*readings.columns))
    size = 168
    d = with_slices(with_row_index(data, KEY, "ep", size=size), RN, back=11, size=size)
    biggest = d.groupBy(*KEY, SLICE).count().agg(F.max("count")).first()[0]
    assert biggest <= size + 11
    out = FE.chronological_split(data)
    assert out.count() == data.count()


def test_window_exchange_is_sliced(spark, readings):
    df = R.nowcast_12h(readings, {"pm2_5": "nc"})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "__slice" in plan and "hashpartitioning(province" in plan
