"""The readings adapter has one plan at every size: the rows are the same
whether Spark broadcasts the sensor map or sort-merges; events without a station
are counted."""

from airq.sources import adapter as AD

from .conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_rows_do_not_depend_on_the_join(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    a_r, a_w = _rows(AD.hourly_readings(spark, SF_SMALL)), _rows(AD.hourly_weather(spark, SF_SMALL))
    spark.conf.set(key, "-1")
    try:
        assert _rows(AD.hourly_readings(spark, SF_SMALL)) == a_r
        assert _rows(AD.hourly_weather(spark, SF_SMALL)) == a_w
    finally:
        spark.conf.set(key, old)


def test_unmatched_events_are_counted(spark):
    r = AD.unmatched_events(spark, SF_SMALL).first()
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert r["n_events"] == n and r["n_unmatched"] == 0
