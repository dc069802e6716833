"""Hourly AQI enrichment: NowCast -> sub-indices -> overall index -> labels.

The same DataFrame -> DataFrame function serves batch and streaming input
(``nowcast='passthrough'`` is stream-safe; the 12-hour NowCast uses a window
and is for batch / foreachBatch use, the stream form is in ``streaming``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import dominant_pollutant, epa_category, health_advice, vn_category, vn_color
from ..functions.subindex import overall_index, sub_index
from ..sources.adapter import STATION_KEY
from .clean import present
from .rolling import nowcast_12h, nowcast_passthrough

# output column -> (input column, pollutant table)
VN_SUBINDEX = {
    "aqi_o3": ("o3", "o3_1h"),
    "aqi_co": ("co", "co"),
    "aqi_so2": ("so2", "so2"),
    "aqi_no2": ("no2", "no2"),
    "aqi_pm10": ("nowcast_pm10", "pm10"),
    "aqi_pm25": ("nowcast_pm25", "pm25"),
}


def with_pm_present(df: DataFrame) -> DataFrame:
    """Keep rows with at least one of the two particulate readings."""
    return df.filter(present("pm2_5").isNotNull() | present("pm10").isNotNull())


def add_nowcast(df: DataFrame, mode: str = "12h", key=STATION_KEY) -> DataFrame:
    if mode == "12h":
        return nowcast_12h(df, {"pm2_5": "nowcast_pm25", "pm10": "nowcast_pm10"}, key=key)
    if mode == "passthrough":
        return df.withColumns({"nowcast_pm25": nowcast_passthrough("pm2_5"),
                               "nowcast_pm10": nowcast_passthrough("pm10")})
    raise ValueError(mode)


def add_subindices(df: DataFrame, profile: str = "vn_stream") -> DataFrame:
    subs = {out: sub_index(src, table, profile) for out, (src, table) in VN_SUBINDEX.items()}
    df = df.withColumns(subs)
    return df.withColumn("aqi_final", overall_index(*VN_SUBINDEX.keys()))


def add_labels(df: DataFrame, scale: str = "vn") -> DataFrame:
    a = F.col("aqi_final")
    if scale == "epa":
        return df.withColumn("aqi_category", epa_category(a))
    return df.withColumns({"aqi_category": vn_category(a), "aqi_color": vn_color(a),
                           "health_advice": health_advice(a)})


def enrich(readings: DataFrame, nowcast: str = "12h", profile: str = "vn_stream") -> DataFrame:
    """T1 / hourly_aqi: P7 -> W3 (or W6) -> F1 x6 -> F6 -> F8, F11, F12."""
    df = with_pm_present(readings)
    df = add_nowcast(df, nowcast)
    df = add_subindices(df, profile)
    return add_labels(df)


EPA_INPUTS = {"aqi_pm25": ("pm2_5", "pm25"), "aqi_pm10": ("pm10", "pm10"), "aqi_o3": ("o3", "o3_1h"),
              "aqi_no2": ("no2", "no2"), "aqi_so2": ("so2", "so2"), "aqi_co": ("co", "co")}


def enrich_epa(readings: DataFrame) -> DataFrame:
    """Older streaming job: US EPA stepped tables on raw values + EPA labels.

    Gas tables are in ppb/ppm; inputs are assumed already converted."""
    df = readings.withColumns({o: sub_index(s, t, "epa_stepped") for o, (s, t) in EPA_INPUTS.items()})
    df = df.withColumn("aqi_final", overall_index(*EPA_INPUTS.keys()))
    return add_labels(df, "epa")


def with_dominant(df: DataFrame) -> DataFrame:
    """which sub-index equals the overall index (first listed wins ties)."""
    order = {"pm25": "aqi_pm25", "pm10": "aqi_pm10", "o3": "aqi_o3", "no2": "aqi_no2",
             "so2": "aqi_so2", "co": "aqi_co"}
    return df.withColumn("dominant", dominant_pollutant(order))
