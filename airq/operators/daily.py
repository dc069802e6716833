"""Daily rollups (A5-A8) and the breakpoint bracket join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.profiles import vn_segments
from ..functions.subindex import sub_index
from ..sources.adapter import STATION_KEY
from .rolling import ozone_8h, trailing_mean


def day_of(ts_col: str = "event_time"):
    """Calendar day of a TIMESTAMP_NTZ as 'yyyy-MM-dd' text."""
    return F.date_format(F.col(ts_col), "yyyy-MM-dd")


def calendar_spine(daily: DataFrame, key=STATION_KEY, day_col: str = "day") -> DataFrame:
    """(key, day) for every day between each station's first and last day.

    One row per station-day of its own span: sparse stations do not grow the
    spine beyond their span, and no cross product of stations x days is made.
    """
    span = daily.groupBy(*key).agg(F.min(F.to_date(day_col)).alias("d0"),
                                   F.max(F.to_date(day_col)).alias("d1"))
    days = span.select(*key, F.explode(F.sequence("d0", "d1")).alias("__d"))
    return days.select(*key, F.date_format("__d", "yyyy-MM-dd").alias(day_col))


def fill_missing_days(daily: DataFrame, key=STATION_KEY, day_col: str = "day") -> DataFrame:
    """Add an all-NULL row for each day missing between a station's first
    and last day.

    The per-station calendar spine (a small aggregate, each station's span
    exploded into days) is left-joined with the daily rows on (station, day).
    Both sides are keyed by the day as well, so a station with a long history
    spreads over many tasks; no window runs over a whole station."""
    return calendar_spine(daily, key, day_col).join(daily, [*key, day_col], "left")


def daily_aqi(readings: DataFrame, profile: str = "vn_batch", key=STATION_KEY) -> DataFrame:
    """Daily VN AQI of the vectorised batch job.

    PM from daily means, gases from daily 1-hour maxima; ozone = larger of
    the 1-hour sub-index and the 8-hour one (the latter dropped when the daily
    8-hour maximum exceeds 400); AQI = largest sub-index, rounded half-even,
    only when a PM sub-index exists.  Days with no rows between a station's
    first and last day are kept (as the resampler does): under the
    ``vn_batch`` rule their missing inputs score 500, as in the original.
    """
    from ..session import materialize
    r = ozone_8h(readings)  # W4 per station, before bucketing by day
    daily = (r.withColumn("day", day_of())
             .groupBy(*key, "day")
             .agg(F.avg("pm2_5").alias("pm25_24h"), F.avg("pm10").alias("pm10_24h"),
                  F.max("so2").alias("so2_1h_max"), F.max("no2").alias("no2_1h_max"),
                  F.max("co").alias("co_1h_max"), F.max("o3").alias("o3_1h_max"),
                  F.max("o3_8h").alias("o3_8h_max")))
    # the spine and the rows both read the daily table: written once
    return daily_index(fill_missing_days(materialize(daily, "daily"), key), profile, key)


def daily_index(full: DataFrame, profile: str = "vn_batch", key=STATION_KEY, extra=()) -> DataFrame:
    """Sub-indices and the daily AQI of rows that hold a day's means and maxima."""
    o3_8 = F.when(~(F.col("o3_8h_max") > 400) | F.col("o3_8h_max").isNull(),
                  sub_index("o3_8h_max", "o3_8h", profile))
    out = full.select(
        *key, "day", *extra,
        sub_index("pm25_24h", "pm25", profile).alias("aqi_pm2_5"),
        sub_index("pm10_24h", "pm10", profile).alias("aqi_pm10"),
        sub_index("so2_1h_max", "so2", profile).alias("aqi_sulphur_dioxide"),
        sub_index("no2_1h_max", "no2", profile).alias("aqi_nitrogen_dioxide"),
        sub_index("co_1h_max", "co", profile).alias("aqi_carbon_monoxide"),
        F.greatest(sub_index("o3_1h_max", "o3_1h", profile), o3_8).alias("aqi_ozone"))
    subs = ["aqi_pm2_5", "aqi_pm10", "aqi_sulphur_dioxide", "aqi_nitrogen_dioxide",
            "aqi_carbon_monoxide", "aqi_ozone"]
    pm = F.col("aqi_pm2_5").isNotNull() | F.col("aqi_pm10").isNotNull()
    return out.withColumn("aqi_daily", F.when(pm, F.bround(F.greatest(*subs), 0).cast("int")))


WAREHOUSE_INPUTS = [  # (rolling-average column, table, output)
    ("avg_pm25_24h", "pm25", "aqi_pm25_24h"),
    ("avg_pm10_24h", "pm10", "aqi_pm10_24h"),
    ("avg_co_1h", "co", "aqi_co_1h"),
    ("avg_so2_1h", "so2", "aqi_so2_1h"),
    ("avg_no2_1h", "no2", "aqi_no2_1h"),
    ("avg_o3_1h", "o3_1h", "aqi_o3_1h"),
    ("avg_o3_8h", "o3_8h", "aqi_o3_8h"),
]


def warehouse_averages(readings: DataFrame, key=STATION_KEY) -> DataFrame:
    """W2 as the warehouse job uses it (per station, row frames)."""
    specs = [("pm2_5", 24), ("pm10", 24), ("o3", 1), ("o3", 8), ("co", 1), ("so2", 1), ("no2", 1)]
    df = trailing_mean(readings, specs, key)
    return df.withColumnsRenamed({"avg_pm2_5_24h": "avg_pm25_24h"})


def daily_aqi_warehouse(readings: DataFrame, key=STATION_KEY) -> DataFrame:
    """A8 / J5 / W10 as one conditional aggregation.

    Per pollutant, the bracket join keeps only values inside the table
    (0 <= c < top); the day's maximum of those is scored with the half-open,
    unrounded rule.  The seven inner joins of the original keep a day only if
    every pollutant has such a value -- here a filter on seven non-NULLs, with
    one row per day (tied maxima are not multiplied).
    """
    avgs = warehouse_averages(readings, key).withColumn("day", day_of())
    aggs = []
    for src, table, _ in WAREHOUSE_INPUTS:
        top = vn_segments(table)[-1].hi
        c = F.col(src)
        aggs.append(F.max(F.when((c >= 0) & (c < top), c)).alias(f"max_{src}"))
    daily = avgs.groupBy(*key, "day").agg(*aggs)
    scored = daily.select(*key, "day", *[sub_index(f"max_{src}", table, "vn_warehouse").alias(out)
                                         for src, table, out in WAREHOUSE_INPUTS])
    outs = [o for _, _, o in WAREHOUSE_INPUTS]
    complete = scored.dropna(subset=outs)
    return complete.withColumn("AQI", F.greatest(*outs))


def daily_max_rows(df: DataFrame, value: str, key=STATION_KEY, day_col: str = "day") -> DataFrame:
    """W10 as written in the warehouse job: keep every row whose value equals
    the (station, day) maximum -- tied hours are all kept."""
    w = Window.partitionBy(day_col, *key)
    return df.withColumn("__max", F.max(value).over(w)).filter(F.col("__max") == F.col(value)).drop("__max")


def breakpoint_table(spark: SparkSession) -> DataFrame:
    """Bracket table (pollutant, lo, hi, ilo, ihi) built from the rule data.

    Its size is fixed by the rule tables (49 rows), so broadcasting it is safe
    at any data size."""
    rows = [(t, float(s.lo), float(s.hi), float(s.ilo), float(s.ihi))
            for _, t, _ in WAREHOUSE_INPUTS for s in vn_segments(t)]
    return spark.createDataFrame(rows, "pollutant string, lo double, hi double, ilo double, ihi double")


def bracket_join(spark: SparkSession, averages: DataFrame, key=STATION_KEY) -> DataFrame:
    """Long form of the seven averages joined to their bracket.

    Each table row is pre-paired (lo, hi) so exactly one bracket can match;
    the join is an equi-join on the pollutant plus a range condition against
    a broadcast table -- no nested-loop join and no tightest-bracket window.
    Values outside every bracket (negative, NaN, above the top) drop out,
    as with the original inner filtering.
    """
    pairs = ", ".join(f"'{t}', {src}" for src, t, _ in WAREHOUSE_INPUTS)
    long = averages.select(*key, "ep", "event_time",
                           F.expr(f"stack({len(WAREHOUSE_INPUTS)}, {pairs}) AS (pollutant, c)"))
    bp = F.broadcast(breakpoint_table(spark))
    j = long.join(bp, (long.pollutant == bp.pollutant) & (long.c >= bp.lo) & (long.c < bp.hi))
    return j.select(*key, "ep", "event_time", long.pollutant, "c",
                    ((F.col("c") - F.col("lo")) * (F.col("ihi") - F.col("ilo")) / (F.col("hi") - F.col("lo"))
                     + F.col("ilo")).alias("aqi"))
