"""Driver tables -> hourly station readings (the engine's input shape).

Mapping (all rows of ``events`` are used):

* a sensor is a customer (``events.user_id = customer.c_custkey``); its
  station is the customer's nation: district = ``n_name``, province =
  ``r_name``; region tag north for region keys 0-1, central 2, south 3-4;
* the hour is ``ts`` truncated to the hour, also kept as epoch hours ``ep``;
* pollutant = mean event value of one event type in the station-hour, times
  a factor; ``co`` = mean of ``props.k`` times 1600 (so every table also has
  values above its top breakpoint);
* a station-hour without events of a type has NULL for that pollutant.

Plan shape, the same at every size: events are first reduced to
per-(sensor, hour) partial sums and counts (map-side combine), so a sensor
holding a third of all events shrinks to at most one row per hour before any
join; the sensor -> station join runs on the reduced table (Spark picks
broadcast or sort-merge by size), and the partials are merged per
(station, hour).  ``unmatched_events`` counts events whose sensor has no
station, which the inner join leaves out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

# ---------------------------------------------------------------------------
# FIXED VALUES of the mapping (pollutant, event type, factor).
# ---------------------------------------------------------------------------
POLLUTANT_EVENTS = [
    ("pm2_5", "view", 1.1),
    ("pm10", "click", 1.3),
    ("o3", "purchase", 2.6),
    ("no2", "signup", 8.0),
    ("so2", "error", 5.5),
]
CO_FACTOR = 1600.0
DIGITS = 6
# ---------------------------------------------------------------------------

POLLUTANT_COLS = ["pm2_5", "pm10", "o3", "no2", "so2", "co"]
STATION_KEY = ["province", "district"]
EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_hour(ts) -> F.Column:
    """Whole hours since 1970-01-01 of a TIMESTAMP_NTZ.

    Day number * 24 + hour of day: both parts are read from the wall-clock
    value, so the result does not depend on the session time zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return (F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 24
            + F.hour(ts))


def hour_ts(ep_col: str = "ep") -> F.Column:
    """Epoch hours -> TIMESTAMP_NTZ (inverse of ``epoch_hour``)."""
    ep = F.col(ep_col)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(ep / 24).cast("int"))
    return F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day),
                                F.pmod(ep, F.lit(24)).cast("int"), F.lit(0), F.lit(0))


def _safe_div(s, n):
    return F.when(n > 0, s / n)


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station dimension: one row per nation (fixed 25-row TPC-H dimension)."""
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
            .select(
                F.col("n_nationkey").alias("station_id"),
                F.col("r_name").alias("province"),
                F.col("n_name").alias("district"),
                F.when(F.col("r_regionkey") <= 1, "north")
                 .when(F.col("r_regionkey") == 2, "central").otherwise("south").alias("region"),
                F.round(F.lit(8.5) + F.col("n_nationkey") * F.lit(0.6), 4).alias("lat"),
                F.round(F.lit(102.5) + F.col("n_nationkey") * F.lit(0.3), 4).alias("lon"),
            ))


def _sensor_station(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    return c.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("station_id"))


def per_station_hour(spark: SparkSession, sf_dir: str, ev: DataFrame, aggs: list,
                     merge: dict) -> DataFrame:
    """(station_id, ep, aggregates) of events keyed by (user_id, ep).

    ``aggs`` are the aggregates over events; ``merge`` maps each output
    column to the function that merges its partials (sum, min, max)."""
    sensors = _sensor_station(spark, sf_dir)
    cells = ev.groupBy("user_id", "ep").agg(*aggs)
    return (cells.join(sensors, "user_id").groupBy("station_id", "ep")
            .agg(*[fn(F.col(c)).alias(c) for c, fn in merge.items()]))


def unmatched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n_events, n_unmatched): events whose sensor is in no station."""
    ev = table(spark, sf_dir, "events", "user_id").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    j = ev.join(_sensor_station(spark, sf_dir), "user_id", "left")
    return j.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_events"),
                 F.coalesce(F.sum(F.when(F.col("station_id").isNull(), F.col("n"))), F.lit(0)).alias("n_unmatched"))


def _events(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events", "user_id", "ts", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k").try_cast("double")
    return e.select("user_id", "ts", "event_type", "value", k.alias("k"))


def hourly_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(province, district, region, lat, lon, ep, event_time, pm2_5 .. co)."""
    ev = _events(spark, sf_dir).withColumn("ep", epoch_hour("ts"))
    sums = []
    for name, etype, _ in POLLUTANT_EVENTS:
        v = F.when(F.col("event_type") == etype, F.col("value"))
        sums += [F.sum(v).alias(f"s_{name}"), F.count(v).alias(f"n_{name}")]
    sums += [F.sum("k").alias("s_k"), F.count("k").alias("n_k")]
    names = [f"{p}_{n}" for n in [*(x[0] for x in POLLUTANT_EVENTS), "k"] for p in ("s", "n")]
    merged = per_station_hour(spark, sf_dir, ev, sums, {c: F.sum for c in names})
    vals = [F.round(_safe_div(F.col(f"s_{n}"), F.col(f"n_{n}")) * F.lit(f), DIGITS).alias(n)
            for n, _, f in POLLUTANT_EVENTS]
    vals.append(F.round(_safe_div(F.col("s_k"), F.col("n_k")) * F.lit(CO_FACTOR), DIGITS).alias("co"))
    hourly = merged.select("station_id", "ep", *vals)
    return (hourly.join(stations(spark, sf_dir), "station_id")
            .select("province", "district", "region", "lat", "lon", "ep",
                    hour_ts("ep").alias("event_time"), *POLLUTANT_COLS))


def hourly_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather stand-in with the same station keys.

    Built from the same events bucketed to the hour of ``ts + 30 min`` (so
    its time range differs from the air table by one hour):
    temperature_2m = 15 + mean value / 25, relative_humidity_2m = mean k,
    rain = sum of 'error' values / 100, wind_speed_10m = min value / 10,
    wind_speed_100m = max value / 8, wind_direction_10m = (sum k * 37) mod 360.
    """
    ev = _events(spark, sf_dir).withColumn(
        "ep", epoch_hour(F.col("ts") + F.expr("INTERVAL 30 MINUTES")))
    aggs = [F.sum("value").alias("sv"), F.count("value").alias("nv"),
            F.sum("k").alias("sk"), F.count("k").alias("nk"),
            F.sum(F.when(F.col("event_type") == "error", F.col("value"))).alias("se"),
            F.min("value").alias("mn"), F.max("value").alias("mx")]
    merge = {"sv": F.sum, "nv": F.sum, "sk": F.sum, "nk": F.sum, "se": F.sum, "mn": F.min, "mx": F.max}
    merged = per_station_hour(spark, sf_dir, ev, aggs, merge)
    w = merged.select(
        "station_id", "ep",
        F.round(F.lit(15.0) + _safe_div(F.col("sv"), F.col("nv")) / F.lit(25.0), DIGITS).alias("temperature_2m"),
        F.round(_safe_div(F.col("sk"), F.col("nk")), DIGITS).alias("relative_humidity_2m"),
        F.round(F.coalesce(F.col("se"), F.lit(0.0)) / F.lit(100.0), DIGITS).alias("rain"),
        F.round(F.col("mn") / F.lit(10.0), DIGITS).alias("wind_speed_10m"),
        F.round(F.col("mx") / F.lit(8.0), DIGITS).alias("wind_speed_100m"),
        F.pmod(F.col("sk") * F.lit(37.0), F.lit(360.0)).alias("wind_direction_10m"))
    return (w.join(stations(spark, sf_dir), "station_id")
            .select("province", "district", "region", "ep", hour_ts("ep").alias("event_time"),
                    "temperature_2m", "relative_humidity_2m", "rain", "wind_speed_10m",
                    "wind_speed_100m", "wind_direction_10m"))
