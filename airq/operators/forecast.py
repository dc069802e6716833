"""24-hour forecast.

The original trains a single-machine LSTM on 24-row windows of 15 features.  Here the
next 24 hours are forecast by least squares, each hour (horizon) with coefficients of its own,
in two forms:

* ``window=1``: from the newest row's 15 features, 16 coefficients a horizon;
* ``window=24``: from the newest 24 rows, flattened to 360 inputs.

Rows are never multiplied by horizons: a row carries its 24 targets as an array, and one
pass gathers the normal equations of all horizons (`least_squares`).  A model is two
small tables, the coefficients and the scaling statistics, which are also its saved form.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..functions.labels import ui_level
from ..sources.adapter import STATION_KEY
from .clean import clip, future_hours
from .features import FEATURES
from .least_squares import block_gram, gram, list_matrix, solve
from .slicing import RN, own_rows, sliced_window, with_slices

HORIZON = 24
#: Ridge per window length, as a share of the number of rows (inputs have variance 1).
RIDGE = {1: 1e-6, 24: 0.1}


@dataclass
class Model:
    """``scaling``: per feature (mean, population standard deviation) of the training rows;
    ``coefficients``: (1 + window * features) x horizons, the intercept first."""

    scaling: dict[str, tuple[float, float]]
    coefficients: np.ndarray
    window: int


def scaling(train: DataFrame, features=FEATURES) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation of every feature, in one pass."""
    aggs = [f(F.col(c).cast("double")) for c in features for f in (F.avg, F.stddev_pop)]
    row = train.agg(*aggs).first()
    return {c: (row[2 * k] or 0.0, row[2 * k + 1] or 0.0) for k, c in enumerate(features)}


def scaled(stats: dict[str, tuple[float, float]]) -> list[Column]:
    """The standardised features (a constant feature is 0)."""
    return [(F.col(c).cast("double") - F.lit(m)) / F.lit(s) if s else F.lit(0.0) for c, (m, s) in stats.items()]


def samples(split: DataFrame, stats: dict, window: int = 1, target: str = "aqi", key=STATION_KEY) -> DataFrame:
    """(split, past, y, z or x): one row per row with 24 rows of its station's split up to it
    and 24 after it.  ``past``: the 24 values up to now; ``y``: the next 24; ``z``: its
    standardised features; ``x`` (``window`` > 1): those of the last ``window`` rows, flattened."""
    d = split.select(*key, "split", (F.col("split_pos") + 1).alias(RN), F.col(target).cast("double").alias("t"), F.array(*scaled(stats)).alias("z"))
    d = with_slices(d, RN, back=HORIZON - 1, fwd=HORIZON)
    w = sliced_window([*key, "split"], RN)          # dense positions: range = rows
    cols = {"past": F.collect_list("t").over(w.rangeBetween(1 - HORIZON, 0)), "y": F.collect_list("t").over(w.rangeBetween(1, HORIZON))}
    if window > 1:
        cols["x"] = F.flatten(F.collect_list("z").over(w.rangeBetween(1 - window, 0)))
    rows = own_rows(d.withColumns(cols)).filter((F.size("y") == HORIZON) & (F.size("past") == HORIZON))
    return rows.select("split", "past", "y", "x" if window > 1 else "z")


def fit(split: DataFrame, window: int = 1, target: str = "aqi", features=FEATURES) -> Model:
    """Least squares on the rows of ``split`` marked 'train' (`chronological_split`)."""
    train = split.filter("split = 'train'")
    stats = scaling(train, features)
    rows = samples(train, stats, window, target)
    if window == 1:
        xx, xy, n = gram(rows, [F.lit(1.0), *[F.get("z", F.lit(i)) for i in range(len(stats))]], [F.get("y", F.lit(h)) for h in range(HORIZON)])
    else:
        p = 1 + window * len(stats)
        xx, xy, n = block_gram(rows.select(F.concat(F.array(F.lit(1.0)), "x").alias("x"), "y"), "x", "y", p, HORIZON)
    return Model(stats, solve(xx, xy, n, RIDGE[window]), window)


def predict(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (with ``z``, or ``x`` for windows) with ``forecast``: an array of 24 values."""
    b = model.coefficients
    if model.window == 1:
        z = [F.get("z", F.lit(i)) for i in range(len(b) - 1)]
        hours = []
        for h in range(HORIZON):
            v = F.lit(float(b[0, h]))
            for i, zi in enumerate(z, 1):
                v = v + F.lit(float(b[i, h])) * zi
            hours.append(v)
        return rows.withColumn("forecast", F.array(*hours))

    at, names, matrix = rows.columns.index("x"), [*rows.columns, "forecast"], list_matrix()
    hours = HORIZON

    def run(batches):
        for batch in batches:
            y = b[0] + matrix(batch.column(at), len(b) - 1) @ b[1:]
            off = pa.array(np.arange(0, (len(batch) + 1) * hours, hours, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(off, pa.array(y.ravel()))], names)

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("forecast", ArrayType(DoubleType()))]))


def evaluate(models: dict[str, Model], split: DataFrame, target: str = "aqi") -> DataFrame:
    """(h, n, and mae and mse per forecast) on the held-out rows: each of ``models`` (by suffix of the
    column names), the current value carried forward (``_persistence``), and the value one
    day before the hour forecast (``_seasonal``).  All forecasts are judged on the same rows.

    One row of sums per model, then one row per horizon: nothing is multiplied before."""
    tables = []
    for k, (suffix, model) in enumerate(models.items()):
        rows = predict(samples(split.filter("split = 'test'"), model.scaling, model.window, target), model)
        guess = {suffix: lambda h: F.get("forecast", F.lit(h))}
        if not k:
            guess |= {"_persistence": lambda h: F.element_at("past", -1), "_seasonal": lambda h: F.get("past", F.lit(h))}
        errors = {f"{m}{s}{h}": f(g(h) - F.get("y", F.lit(h))) for s, g in guess.items() for h in range(HORIZON)
                  for m, f in (("mae", F.abs), ("mse", lambda e: e * e))}
        sums = rows.agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(e), 4).alias(c) for c, e in errors.items()])
        per_hour = [F.struct(F.lit(h + 1).alias("h"), "n", *[F.col(f"{m}{s}{h}").alias(f"{m}{s}") for s in guess for m in ("mae", "mse")]) for h in range(HORIZON)]
        t = sums.select(F.inline(F.array(*per_hour))).filter("n > 0")
        tables.append(t if not k else t.drop("n"))
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, "h")      # 24 rows each
    return out


def score_next_24h(model: Model, feat: DataFrame, key=STATION_KEY, ep: str = "ep", ts: str = "event_time") -> DataFrame:
    """M4: for every station its newest rows -> the next 24 hours, clipped to [0, 300],
    with the hour 'HH:mm' and the level.  A station with fewer than ``window`` rows has no
    forecast."""
    w = Window.partitionBy(*key).orderBy(F.col(ep).desc())
    rows = feat.select(*key, ep, ts, F.array(*scaled(model.scaling)).alias("z"))
    newest = rows.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= model.window).drop("__rn")      # a group limit
    if model.window == 1:
        newest = newest.select(*key, ts, "z")
    else:
        series = newest.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(ep, ts, "z"))).alias("s")).filter(F.size("s") == model.window)
        newest = series.select(*key, F.element_at("s", -1)[ts].alias(ts), F.flatten(F.transform("s", lambda r: r["z"])).alias("x"))
    p = predict(newest, model)
    p = p.select(*key, F.posexplode(F.arrays_zip(future_hours(F.col(ts), HORIZON).alias("t"), F.col("forecast").alias("v"))).alias("step", "r"))
    v = clip(F.col("r.v"), 0.0, 300.0)
    lvl = ui_level(v)
    return p.select(*key, (F.col("step") + 1).alias("step"), F.date_format("r.t", "HH:mm").alias("time"),
                    F.round(v, 2).alias("aqi"), lvl["level"].alias("level"), lvl["color"].alias("color"))


def save(spark: SparkSession, model: Model, path: str) -> None:
    """M5: the model as two Parquet tables, ``coefficients`` (a row per horizon) and ``scaling``
    (a row per feature)."""
    b = model.coefficients
    spark.createDataFrame([(h + 1, model.window, float(b[0, h]), b[1:, h].tolist()) for h in range(HORIZON)],
                          "h int, window int, intercept double, slopes array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/coefficients")
    spark.createDataFrame([(i, c, float(m), float(s)) for i, (c, (m, s)) in enumerate(model.scaling.items())],
                          "i int, feature string, mean double, std double").coalesce(1).write.mode("overwrite").parquet(f"{path}/scaling")


def load(spark: SparkSession, path: str) -> Model:
    lines = spark.read.parquet(f"{path}/coefficients").orderBy("h").collect()
    stats = spark.read.parquet(f"{path}/scaling").orderBy("i").collect()
    b = np.array([[r["intercept"], *r["slopes"]] for r in lines]).T
    return Model({r["feature"]: (r["mean"], r["std"]) for r in stats}, b, lines[0]["window"])
