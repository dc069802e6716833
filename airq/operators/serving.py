"""Serving queries over enriched readings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.adapter import STATION_KEY


def latest_per_station(df: DataFrame, key=STATION_KEY, order=("ep",), tie_break=()) -> DataFrame:
    """Newest row per station (row_number = 1; planned as a group limit).

    ``tie_break`` columns (e.g. ingested_at) decide between duplicate times."""
    w = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in (*order, *tie_break)])
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def last_n_per_station(df: DataFrame, n: int = 24, key=STATION_KEY, order: str = "ep") -> DataFrame:
    """The last n rows of every station (a group limit: each task passes on at most n
    rows of a station).

    Also what goes in front of a window that reaches ``h`` hours back when only the newest
    ``k`` rows are wanted: times are unique per station, so the k + h newest rows hold
    every row that such a window can see, without joining a station's newest hour back."""
    w = Window.partitionBy(*key).orderBy(F.col(order).desc())
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def province_summary(latest: DataFrame) -> DataFrame:
    """A1: per (province, region) over the latest rows."""
    return latest.groupBy("province", "region").agg(
        F.countDistinct("district").alias("district_count"),
        F.round(F.avg(F.col("aqi_final").cast("double")), 6).alias("avg_aqi"),
        F.max("aqi_final").alias("max_aqi"),
        F.min("aqi_final").alias("min_aqi"),
        F.max("ep").alias("last_updated_ep"))


def top_polluted(latest: DataFrame, n: int = 10) -> DataFrame:
    """K1: the n most polluted stations (ties broken by province, district)."""
    return latest.orderBy(F.col("aqi_final").desc(), "province", "district").limit(n)


def top_pm25(latest: DataFrame, n: int = 5) -> DataFrame:
    """K2: the n highest PM2.5 readings, missing counted as 0."""
    return latest.orderBy(F.coalesce(F.col("pm2_5"), F.lit(0.0)).desc(), "province", "district").limit(n)


def station_history(df: DataFrame, hours: int = 24, as_of_ep=None, key=STATION_KEY) -> DataFrame:
    """K4 for every station: rows in the last ``hours`` hours up to ``as_of``.

    ``as_of_ep`` (epoch hours) is the clock; by default the newest reading in
    the data, taken as a scalar subquery (no join, no driver round trip).
    """
    as_of = F.lit(as_of_ep) if as_of_ep is not None else df.agg(F.max("ep")).scalar()
    return (df.withColumn("__asof", as_of).filter(F.col("ep") >= F.col("__asof") - hours)
            .drop("__asof").orderBy(*key, "ep"))


def union_all(dfs: list) -> DataFrame:
    """Union by column name (missing columns become NULL)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def station_list(df: DataFrame) -> DataFrame:
    """Sorted distinct (province, district) pairs."""
    return df.select("province", "district").distinct().orderBy("province", "district")
