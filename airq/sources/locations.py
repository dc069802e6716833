"""Station dimension from the regional location CSVs.

Each region file has a header ``district,city,lat,lon``.  Values are trimmed
and cast (``try_cast``: a bad coordinate becomes NULL instead of failing the
load), tagged with the region and unioned by name.  The station key is
(province, district): the same district name may exist in several provinces,
and a (province, district) pair may repeat -- ``resolve_duplicates`` keeps
one row per key deterministically and reports the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.serving import union_all

RAW_SCHEMA = "district string, city string, lat string, lon string"


def load_locations(spark: SparkSession, files: dict) -> DataFrame:
    """``files`` maps region name -> CSV path (or list of paths)."""
    parts = []
    for region, path in files.items():
        raw = spark.read.option("header", True).schema(RAW_SCHEMA).csv(path)
        parts.append(raw.select(
            F.trim("city").alias("province"), F.trim("district").alias("district"),
            F.lit(region).alias("region"),
            F.trim("lat").try_cast("double").alias("lat"), F.trim("lon").try_cast("double").alias("lon")))
    return union_all(parts)


def resolve_duplicates(locations: DataFrame):
    """-> (one row per (province, district), rows dropped as duplicates).

    The kept row is the first by (region, lat, lon), so reruns agree."""
    w = Window.partitionBy("province", "district").orderBy("region", "lat", "lon")
    ranked = locations.withColumn("__rn", F.row_number().over(w))
    return (ranked.filter("__rn = 1").drop("__rn"),
            ranked.filter("__rn > 1").drop("__rn"))


def count_by_region(locations: DataFrame) -> DataFrame:
    """Stations per region plus a total row."""
    return (locations.rollup("region").agg(F.count(F.lit(1)).alias("n_stations"))
            .select(F.coalesce("region", F.lit("total")).alias("region"), "n_stations"))
