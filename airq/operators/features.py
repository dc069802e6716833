"""Forecast features (W7, W8, W11, F13, F20, M1) and baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import ui_level
from ..functions.subindex import epa_pm25_continuous
from ..sources.adapter import STATION_KEY
from .clean import clip, future_hours
from .slicing import N, OWN, RN, SLICE, own_rows, sliced_window, with_row_index, with_slices

FEATURES = ["pm10", "co", "no2", "so2", "o3",
            "temperature_2m", "relative_humidity_2m", "wind_speed_10m", "rain",
            "aqi_lag1", "aqi_lag3", "aqi_lag6", "aqi_lag24", "hour", "dayofweek"]
LAGS = (1, 3, 6, 24)


def join_air_weather(air: DataFrame, weather: DataFrame, key=STATION_KEY) -> DataFrame:
    """Inner equi-join on (station, hour); AQE picks broadcast or
    sort-merge from the measured sizes."""
    w = weather.drop("region", "event_time")
    return air.join(w, [*key, "ep"], "inner")


def lag_features(joined: DataFrame, key=STATION_KEY, ep: str = "ep") -> DataFrame:
    """M1: target = continuous EPA PM2.5 index; hour, weekday (Mon=0) and
    lags 1/3/6/24 rows per station; rows with any missing feature dropped."""
    df = joined.withColumn("aqi", epa_pm25_continuous("pm2_5"))
    df = with_slices(with_row_index(df, key, ep), RN, back=max(LAGS))
    w = sliced_window(key, RN)          # dense positions: lag k = row k back
    df = df.withColumns({f"aqi_lag{k}": F.lag("aqi", k).over(w) for k in LAGS})
    df = own_rows(df).drop(RN).withColumns({"hour": F.hour("event_time"), "dayofweek": F.weekday("event_time")})
    return df.dropna(subset=[*FEATURES, "aqi"])


def standardize(df: DataFrame, cols, suffix: str = "") -> DataFrame:
    """(x - mean) / population std.

    All statistics come from ONE aggregate, used as a single scalar subquery
    returning a struct: one extra pass over the input, no join, nothing
    collected to the driver."""
    stats = df.agg(F.struct(*[F.avg(c).alias(f"m_{c}") for c in cols],
                            *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).alias("st")).scalar()
    st = F.col("__st")
    out = {f"{c}{suffix}": F.try_divide(F.col(c) - st[f"m_{c}"], st[f"s_{c}"]) for c in cols}
    return df.withColumn("__st", stats).withColumns(out).drop("__st")


def inverse_standardize(df: DataFrame, fitted_on: DataFrame, cols: dict) -> DataFrame:
    """F20 back: x = z * population std + mean, with the statistics of
    ``fitted_on``; ``cols`` maps a standardised column to the original name."""
    stats = fitted_on.agg(F.struct(*[F.avg(c).alias(f"m_{c}") for c in cols.values()],
                                   *[F.stddev_pop(c).alias(f"s_{c}") for c in cols.values()]).alias("st")).scalar()
    st = F.col("__st")
    out = {c: F.when(st[f"s_{c}"] == 0, st[f"m_{c}"]).otherwise(F.col(z) * st[f"s_{c}"] + st[f"m_{c}"]) for z, c in cols.items()}
    return df.withColumn("__st", stats).withColumns(out).drop("__st")


def chronological_split(df: DataFrame, frac: float = 0.8, key=STATION_KEY, ep: str = "ep") -> DataFrame:
    """Per station, the first int(n*frac) rows are 'train', the rest 'test'.

    Positions and counts come from per-slice counts (``with_row_index``), so
    no task holds a whole station.
    Also adds ``split_pos`` (0-based position within the station's split)
    and ``split_n`` (rows in it), which ``sequence_windows`` uses instead of
    numbering the rows again."""
    d = with_row_index(df, key, ep, count=True)
    n_train = F.floor(F.col(N) * frac)
    train = F.col(RN) <= n_train
    return (d.withColumns({"split": F.when(train, "train").otherwise("test"),
                           "split_pos": F.when(train, F.col(RN) - 1).otherwise(F.col(RN) - n_train - 1),
                           "split_n": F.when(train, n_train).otherwise(F.col(N) - n_train)})
            .drop(RN, N))


def sequence_windows(df: DataFrame, target: str = "aqi", window: int = 24, horizon: int = 24,
                     key=STATION_KEY, ep: str = "ep", group=("split",)) -> DataFrame:
    """Sample i = rows [i, i+window) as x (feature structs) and the next
    ``horizon`` targets as y; a group of n rows yields n - window - horizon
    samples (as the original loop).  Frames are bounded (48 rows)."""
    part = [*key, *group]
    if tuple(group) == ("split",) and "split_pos" in df.columns:
        # positions within (station, split) already given by chronological_split
        df = df.withColumns({RN: F.col("split_pos") + 1, N: F.col("split_n")})
    else:
        df = with_row_index(df, part, ep, count=True)
    df = with_slices(df, RN, fwd=window + horizon - 1)
    w = sliced_window(part, RN)          # dense positions: range = rows
    feat = F.struct(*[F.col(c).cast("double").alias(c) for c in FEATURES])
    df = (df.withColumn("i", F.col(RN) - 1)
            .withColumn("x", F.collect_list(feat).over(w.rangeBetween(0, window - 1)))
            .withColumn("y", F.collect_list(F.col(target).cast("double"))
                        .over(w.rangeBetween(window, window + horizon - 1))))
    return own_rows(df.filter(F.col("i") < F.col(N) - window - horizon)).drop(RN, N)


def persistence_errors(df: DataFrame, target: str = "aqi", horizon: int = 24,
                       key=STATION_KEY, ep: str = "ep") -> DataFrame:
    """A15 / M2 baseline: forecast y(t+h) = y(t); MAE and MSE per horizon.

    All 24 leads come from one window pass, then a small unpivot."""
    d = with_slices(with_row_index(df.select(*key, ep, target), key, ep), RN, fwd=horizon)
    w = sliced_window(key, RN)
    leads = own_rows(d.select(target, SLICE, OWN,
                              *[F.lead(target, h).over(w).alias(f"h{h}") for h in range(1, horizon + 1)]))
    pairs = ", ".join(f"{h}, h{h}" for h in range(1, horizon + 1))
    long = leads.select(target, F.expr(f"stack({horizon}, {pairs}) AS (horizon, actual)"))
    err = (F.col("actual") - F.col(target))
    return (long.filter(F.col("actual").isNotNull())
            .groupBy("horizon")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.abs(err)), 6).alias("mae"),
                 F.round(F.avg(err * err), 6).alias("mse")))


def future_spine(df: DataFrame, value: str = "aqi", hours: int = 24, key=STATION_KEY,
                 ep: str = "ep", ts: str = "event_time") -> DataFrame:
    """F19 + P16 + F16 + F10: next 24 hours per station after its newest row,
    carrying the newest value forward (persistence), clipped to [0, 300],
    formatted 'HH:mm', rounded to 2 decimals and labelled with its level."""
    w = Window.partitionBy(*key).orderBy(F.col(ep).desc())
    last = df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1")
    spine = last.select(*key, F.posexplode(future_hours(F.col(ts), hours)).alias("step", "t"), value)
    v = clip(F.col(value), 0.0, 300.0)
    lvl = ui_level(v)
    return spine.select(*key, (F.col("step") + 1).alias("step"),
                        F.date_format("t", "HH:mm").alias("time"),
                        F.round(v, 2).alias("aqi"), lvl["level"].alias("level"), lvl["color"].alias("color"))
