"""Daily warehouse AQI: the one-aggregation form equals the original
bracket-join / tie-keeping-max / seven-inner-join form."""

from pyspark.sql import functions as F

from airq.operators import daily as D
from airq.sources.adapter import STATION_KEY, hourly_readings

from .conftest import SF_SMALL


def warehouse_joins(spark, readings):
    """J3 + J4 + W10 + J5 step by step: bracket join, per-pollutant tie-keeping
    daily maximum, seven inner joins."""
    long = D.bracket_join(spark, D.warehouse_averages(readings)).withColumn("day", D.day_of())
    joined = None
    for _, table, out in D.WAREHOUSE_INPUTS:
        one = D.daily_max_rows(long.filter(F.col("pollutant") == table), "c").select("day", *STATION_KEY, F.col("aqi").alias(out))
        joined = one if joined is None else joined.join(one, ["day", *STATION_KEY])
    return joined.withColumn("AQI", F.greatest(*[o for _, _, o in D.WAREHOUSE_INPUTS])).distinct()


def test_warehouse_forms_agree(spark):
    r = hourly_readings(spark, SF_SMALL)
    outs = [o for _, _, o in D.WAREHOUSE_INPUTS] + ["AQI"]
    a = D.daily_aqi_warehouse(r).select("day", "province", "district", *[F.round(o, 9).alias(o) for o in outs])
    b = warehouse_joins(spark, r).select("day", "province", "district", *[F.round(o, 9).alias(o) for o in outs])
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_tie_keeping_max(spark):
    df = spark.createDataFrame([("p", "d", "2024-01-01", 5.0), ("p", "d", "2024-01-01", 5.0),
                                ("p", "d", "2024-01-01", 3.0)], "province string, district string, day string, c double")
    assert D.daily_max_rows(df, "c").count() == 2


def test_calendar_spine_fills_gaps(spark):
    df = spark.createDataFrame([("p", "d", "2024-01-01"), ("p", "d", "2024-01-04"), ("q", "e", "2024-01-02")],
                               "province string, district string, day string")
    got = sorted((r.district, r.day) for r in D.calendar_spine(df).collect())
    assert got == [("d", "2024-01-01"), ("d", "2024-01-02"), ("d", "2024-01-03"), ("d", "2024-01-04"),
                   ("e", "2024-01-02")]


def test_fill_missing_days(spark):
    df = spark.createDataFrame([("p", "d", "2024-01-01", 1.0), ("p", "d", "2024-01-04", 4.0),
                                ("q", "e", "2024-01-02", 2.0)],
                               "province string, district string, day string, v double")
    got = sorted((r.district, r.day, r.v) for r in D.fill_missing_days(df).collect())
    assert got == [("d", "2024-01-01", 1.0), ("d", "2024-01-02", None), ("d", "2024-01-03", None),
                   ("d", "2024-01-04", 4.0), ("e", "2024-01-02", 2.0)]
