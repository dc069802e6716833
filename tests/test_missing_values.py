"""NaN counts as missing; names that collide; whole-set schema; inverse scaling; forecast."""

import math

import pytest
from pyspark.sql import functions as F

from airq.functions.labels import vn_rgb
from airq.operators import clean as C
from airq.operators import features as FE
from airq.operators import profile as P
from airq.operators import rolling as R

NAN = float("nan")
SERIES = "province string, district string, ep long, v double"


def test_rolling_operators_skip_nan(spark):
    base = [("p", "d", t, float(10 + t)) for t in range(20)]
    gaps = [(p, d, t, None if t % 4 == 0 else v) for p, d, t, v in base]
    nans = [(p, d, t, NAN if t % 4 == 0 else v) for p, d, t, v in base]
    for run in (lambda x: R.nowcast_12h(x, {"v": "o"}), lambda x: R.nowcast_batch(x, {"v": "o"}), lambda x: R.ozone_8h(x, "v", "o"),
                lambda x: R.trailing_mean(x, [("v", 5)]).withColumnRenamed("avg_v_5h", "o")):
        a, b = ([r.o for r in run(spark.createDataFrame(rows, SERIES)).orderBy("ep").collect()] for rows in (gaps, nans))
        assert a == b and any(x is not None for x in a)


def test_imputation_and_statistics_skip_nan(spark):
    df = spark.createDataFrame([("n", 1.0), ("n", NAN), ("n", 3.0), ("n", None), (None, NAN), ("s", 0.123456789)], "region string, v double")
    got = P.mean_impute(df, ["v"], digits=9).collect()
    assert sorted((str(r.region), r.v) for r in got if r.v is not None) == [("n", 1.0), ("n", 2.0), ("n", 2.0), ("n", 3.0), ("s", 0.123456789)]
    assert [r.v for r in got if r.region is None] == [None]
    stats = {r.region: r for r in P.numeric_stats(df, ["v"]).collect()}
    assert (stats["n"]["mean"], stats["n"]["std"]) == (2.0, 1.0)


def test_names_that_collide_are_an_error(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "`PM 2.5 (ug/m3)` double, `Wind  Speed (km/h (avg))` double")
    assert C.normalize_columns(df).columns == ["pm_2.5", "wind_speed"]
    with pytest.raises(ValueError):
        C.normalize_columns(spark.createDataFrame([(1, 2)], "`a (x)` int, `A (y)` int"))


def test_schema_sees_every_message(spark):
    rows = [(f'{{"a": {i}, "b": null}}',) for i in range(300)] + [('{"a": 1.5, "b": "x", "late": {"k": [1, 2]}}',)]
    schema = C.infer_schema(spark.createDataFrame(rows, "value string"))
    assert schema.simpleString() == "struct<a:double,b:string,late:struct<k:array<bigint>>>"


def test_rename_and_time_between(spark):
    df = spark.createDataFrame([(i, 2.0) for i in range(5)], "`the hour` int, `v (x)` double")
    out = C.time_between(C.rename(df, {"the hour": "h", "v (x)": "v"}), 1, 3, "h")
    assert out.columns == ["h", "v"] and [r.h for r in out.orderBy("h").collect()] == [1, 2, 3]


def test_malformed_messages_are_kept(spark):
    msgs = spark.createDataFrame([('{"province": "a", "pm10": 1}',), ('{"province": "a", "pm',), ("",), (None,), ("[1]",)], "value string")
    good, bad = C.split_malformed(msgs)
    assert good.count() == 1 and sorted(str(r.raw) for r in bad.collect()) == ["", "None", "[1]", '{"province": "a", "pm']


def test_rgb(spark):
    got = spark.createDataFrame([(None,), (0,), (50,), (51,), (301,)], "a int").select(vn_rgb("a").alias("c")).collect()
    assert [r.c for r in got] == [None, "0;228;0", "0;228;0", "255;255;0", "126;0;35"]


def test_inverse_scaling(spark):
    df = spark.createDataFrame([(float(i), 4.0) for i in range(5)], "x double, k double")
    back = FE.inverse_standardize(FE.standardize(df, ["x", "k"], "_z").drop("x", "k"), df, {"x_z": "x", "k_z": "k"})
    assert sorted((round(r.x, 9), r.k) for r in back.collect()) == [(float(i), 4.0) for i in range(5)]
