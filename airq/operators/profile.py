"""Data-quality and factor profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.adapter import POLLUTANT_COLS, STATION_KEY
from .clean import present


def rounded_avg(c: str, digits: int = 6):
    """Mean of the present values (NULL and NaN skipped), rounded.  Summed as
    DECIMAL with 15 decimals, finer than a double of a reading's size: the sum
    doesn't depend on how rows were split across tasks."""
    return F.round(F.avg(present(c).try_cast("decimal(38,15)")), digits).cast("double")


def station_counts(df: DataFrame, key=STATION_KEY) -> DataFrame:
    """Distinct stations per region plus a total row (ROLLUP)."""
    st = F.concat_ws("|", *key)
    return (df.rollup("region").agg(F.countDistinct(st).alias("n_stations"))
            .select(F.coalesce("region", F.lit("total")).alias("region"), "n_stations"))


def null_profile(df: DataFrame, cols=POLLUTANT_COLS, by: str = "region") -> DataFrame:
    """A3: per group and column the NULL/NaN count and rate, ranked (top-3 flag)."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.sum(F.when(F.col(c).isNull() | F.isnan(c), 1).otherwise(0)).alias(c) for c in cols]
    wide = df.groupBy(by).agg(*aggs)
    long = wide.unpivot([by, "n_rows"], list(cols), "column", "n_null")
    w = Window.partitionBy(by).orderBy(F.col("n_null").desc(), "column")
    return (long.withColumn("rate", F.round(F.col("n_null") / F.col("n_rows"), 6))
            .withColumn("rank", F.row_number().over(w))
            .withColumn("top3", F.col("rank") <= 3))


def numeric_stats(df: DataFrame, cols=POLLUTANT_COLS, by: str = "region") -> DataFrame:
    """A4: mean and population standard deviation per group and column.

    One wide aggregation (partial aggregation on every column at once), then
    a small explode to long form."""
    aggs = []
    for c in cols:
        aggs += [rounded_avg(c).alias(f"m_{c}"), F.stddev_pop(present(c)).alias(f"s_{c}")]
    wide = df.groupBy(by).agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m_{c}").alias("mean"),
                               F.col(f"s_{c}").alias("std")) for c in cols])
    return (wide.select(by, F.inline(pairs))
            .select(by, "column", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std")))


def mean_impute(df: DataFrame, cols=POLLUTANT_COLS, by: str = "region", digits: int = 6) -> DataFrame:
    """Fill each missing value (NULL or NaN) with its group's mean (rounded).

    The means are one small map, group -> means, bound as a scalar subquery:
    the rows are not shuffled by a key of a few values.  Rows without a group
    keep their gaps."""
    means = (df.filter(F.col(by).isNotNull()).groupBy(by)
             .agg(F.struct(*[rounded_avg(c, digits).alias(c) for c in cols]).alias("m"))
             .agg(F.map_from_entries(F.collect_list(F.struct(by, "m")))).scalar())
    j = df.withColumn("__means", means).withColumn("__m", F.col("__means")[F.col(by)])
    return j.withColumns({c: F.coalesce(present(c), F.col("__m")[c]) for c in cols}).drop("__means", "__m")


FACTORS = ["temperature_2m", "relative_humidity_2m", "rain", "wind_speed_10m",
           "wind_speed_100m", "wind_direction_10m"]


def safe_corr(x: str, y: str):
    """Pearson r = cov_pop / (sd_x * sd_y); NULL (not an error) when one
    side is constant in the group (plain ``corr`` divides by zero under ANSI)."""
    both = present(x).isNotNull() & present(y).isNotNull()
    xx, yy = F.when(both, present(x)), F.when(both, present(y))
    return F.try_divide(F.covar_pop(xx, yy), F.stddev_pop(xx) * F.stddev_pop(yy))


def factor_corr(joined: DataFrame, target: str = "pm2_5", factors=FACTORS) -> DataFrame:
    """Pearson correlation of the target with each weather factor,
    overall and per station (GROUPING SETS)."""
    aggs = [F.count(target).alias("n")] + [F.round(safe_corr(target, f), 6).alias(f"corr_{f}") for f in factors]
    p, d = F.col("province"), F.col("district")
    return joined.groupingSets([[p, d], []], p, d).agg(*aggs)


QUANTILE_ACCURACY = 10_000


def factor_bins(joined: DataFrame, target: str = "pm2_5") -> DataFrame:
    """Target statistics per band of humidity (10 %), rain (yes/no),
    wind speed (5 km/h) and wind direction (45 degree sectors)."""
    return _banded(joined, target).groupBy("factor", "bin").agg(
        F.count(target).alias("n"), F.round(F.min(target), 6).alias("min"),
        rounded_avg(target).alias("avg"), F.round(F.max(target), 6).alias("max"))


def factor_quantiles(joined: DataFrame, target: str = "pm2_5", shares=(0.5, 0.9), names=("median", "p90"),
                     accuracy: int = QUANTILE_ACCURACY) -> DataFrame:
    """Quantiles of the target per band, from one mergeable sketch a band: tasks
    sketch their rows and the sketches are merged, so a band's values are never sorted in one place.

    A result is a value of the band whose rank lies within n / ``accuracy`` of the
    exact one (so it is exact for bands of up to ``accuracy`` rows); a sketch holds a number of values
    that grows with ``accuracy`` and the logarithm of n."""
    q = F.percentile_approx(target, list(shares), accuracy)
    return (_banded(joined, target).groupBy("factor", "bin").agg(F.count(target).alias("n"), q.alias("q"))
            .select("factor", "bin", "n", *[F.get("q", F.lit(i)).alias(name) for i, name in enumerate(names)]))


def _banded(joined: DataFrame, target: str) -> DataFrame:
    """(target, factor, bin): each row in its band of every factor."""
    bands = F.array(
        F.struct(F.lit("humidity").alias("factor"),
                 F.floor(F.col("relative_humidity_2m") / 10).cast("long").alias("bin")),
        F.struct(F.lit("rain").alias("factor"), (F.col("rain") > 0).cast("long").alias("bin")),
        F.struct(F.lit("wind").alias("factor"), F.floor(F.col("wind_speed_10m") / 5).cast("long").alias("bin")),
        F.struct(F.lit("direction").alias("factor"),
                 F.floor(F.col("wind_direction_10m") / 45).cast("long").alias("bin")))
    return joined.filter(present(target).isNotNull()).select(target, F.inline(bands))
