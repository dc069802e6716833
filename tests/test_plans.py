"""Plan checks on the plans that ran: a query's own (collected through the very
query execution that is inspected, so the adaptive plan is final) and those of
the tables it writes on the way."""

import re

import pytest

from airq import session
from airq.plans.catalog import CATALOG
from airq.plans.plan_report import final_plan, nodes

from .conftest import SF_SMALL

BAD = ["BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin", "CartesianProduct"]
REPLAYS = {"stream_enrich", "stream_dedup", "stream_latest", "stream_nowcast", "stream_daily", "stream_quarantine", "stream_throughput"}
# the air and weather stand-ins are two aggregations of events (two sources in a
# real deployment): these queries read events once for each
TWO_SOURCES = {"single_station_join", "district_time_join", "factor_corr", "factor_bins", "air_weather_join", "lag_features", "scaled_features",
               "inverse_scaled", "sequence_windows", "naive_forecast_error", "future_spine", "forecast_24h", "forecast_eval", "forecast_windows_24h", "scaling_stats", "factor_quantiles"}


@pytest.fixture
def jobs(monkeypatch):
    """DataFrames that a query writes to the scratch folder while it is built."""
    written, plain = [], session.materialize

    def spy(df, name):
        written.append(df)
        return plain(df, name)

    monkeypatch.setattr(session, "materialize", spy)
    return written


def scans(plan, table):
    return [n for n in nodes(plan) if n.nodeName().startswith("Scan") and f"{table}.parquet" in n.toString()]


@pytest.mark.parametrize("name", sorted(set(CATALOG) - REPLAYS))
def test_plan_shape(spark, jobs, name):
    df = CATALOG[name](spark, SF_SMALL)
    own = final_plan(df)
    plans = [own, *(final_plan(j) for j in jobs)]
    for plan in plans:
        text = plan.toString()
        assert not text.startswith("AdaptiveSparkPlan isFinalPlan=false"), name
        for bad in BAD:
            assert bad not in text, (name, bad)
        # every window is partitioned (an unpartitioned window moves all rows to one task)
        for node in nodes(plan):
            if node.nodeName() == "Window":
                assert not node.partitionSpec().isEmpty(), (name, node.toString())
    read = sum(len(scans(p, "events")) for p in plans)
    assert read <= (2 if name in TWO_SOURCES else 1), (name, read)


def test_scan_is_pruned(spark):
    plan = final_plan(CATALOG["hourly_aqi"](spark, SF_SMALL))
    (events,), (customer,) = scans(plan, "events"), scans(plan, "customer")
    columns = lambda n: set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<([^>]*)>", n.toString())[1]))
    assert columns(events) == {"user_id", "ts", "event_type", "value", "props"}
    assert columns(customer) == {"c_custkey", "c_nationkey"}


def test_nowcast_sums_once(spark):
    """The weighted sums appear once per pollutant, not once per use in the rounding."""
    for name, pollutants in (("nowcast_pm25", 1), ("hourly_aqi", 2)):
        text = CATALOG[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("aggregate(") <= 2 * pollutants, name


def test_history_is_pruned_by_day(spark):
    from airq.sources import files as FS

    path = session.scratch_path(spark, "pruned")
    FS.write_partitioned(CATALOG["hourly_aqi"](spark, SF_SMALL).withColumn("event_time", __import__("pyspark.sql.functions", fromlist=["x"]).expr(
        "timestamp_ntz'1970-01-01' + make_interval(0, 0, 0, 0, ep)")), path)
    days = spark.read.parquet(path).select("year", "month", "day").distinct().count()
    one = spark.read.parquet(path).agg({"event_time": "max"}).first()[0].replace(hour=0)
    df = FS.read_history(spark, path, one, one.replace(hour=23))
    rows = df.count()
    files = len({r[0] for r in df.selectExpr("input_file_name()").collect()})
    scan = next(n for n in nodes(final_plan(df)) if n.nodeName().startswith("Scan"))
    listed = int(scan.metrics().apply("numFiles").value())
    assert days > 2 and rows and listed == files
