"""M2-M5: least squares per horizon from one pass, equal to numpy's on the same samples."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from airq.operators import features as FE
from airq.operators import forecast as FC
from airq.operators import least_squares as LS
from airq.plans import catalog as CAT
from airq.plans.checker import compare, duck
from airq.plans.oracle import ORACLE
from airq.session import scratch_path

from .conftest import SF_SMALL

CYCLE = ["aqi", "aqi_lag24"]


def cycle(spark, days=60, stations=1):
    """Hourly daily cycles with a little noise, split by time."""
    rows = [(f"p{s}", "d", t, 50 + 40 * math.sin(2 * math.pi * (t + 3 * s) / 24) + (t * 2654435761 >> 7) % 100 / 50) for s in range(stations) for t in range(24 * days)]
    df = spark.createDataFrame(rows, "province string, district string, ep long, aqi double")
    lagged = df.select("province", "district", (F.col("ep") + 24).alias("ep"), F.col("aqi").alias("aqi_lag24"))
    df = df.join(lagged, ["province", "district", "ep"]).withColumn("event_time", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, int(ep))"))
    return FE.chronological_split(df)


def by_numpy(split, features, window):
    """The same model from collected rows."""
    train = split.filter("split = 'train'").collect()
    stats = {c: (np.mean([r[c] for r in train]), np.std([r[c] for r in train])) for c in features}
    x, y = [], []
    for key in {(r["province"], r["district"]) for r in train}:
        own = sorted((r for r in train if (r["province"], r["district"]) == key), key=lambda r: r["ep"])
        z = [[(r[c] - m) / s if s else 0.0 for c, (m, s) in stats.items()] for r in own]
        for i in range(23, len(own) - 24):
            x.append([1.0, *sum(z[i - window + 1:i + 1], [])])
            y.append([r["aqi"] for r in own[i + 1:i + 25]])
    x, y = np.array(x), np.array(y)
    hold = np.eye(x.shape[1]) * FC.RIDGE[window] * len(x)
    hold[0, 0] = 0
    return np.linalg.solve(x.T @ x + hold, x.T @ y)


@pytest.mark.parametrize("window", [1, 24])
def test_coefficients_equal_numpy(spark, window):
    split = cycle(spark, 12, stations=3).withColumn("same", F.lit(4.0)).cache()
    got = FC.fit(split, window, features=[*CYCLE, "same"])
    assert np.allclose(got.coefficients, by_numpy(split, [*CYCLE, "same"], window), rtol=1e-6, atol=1e-6)


def test_horizons_have_their_own_slopes_and_beat_the_baselines(spark):
    split = cycle(spark).cache()
    model = FC.fit(split, features=CYCLE)
    assert len({round(b, 3) for b in model.coefficients[1]}) > 5
    ev = {r.h: r for r in FC.evaluate({"": model, "_window": FC.fit(split, 24, features=CYCLE)}, split).collect()}
    assert len(ev) == 24
    assert all(r.mae <= r.mae_persistence + 1e-6 for r in ev.values()) and ev[12].mae < 0.7 * ev[12].mae_persistence
    assert ev[24].mae_seasonal == ev[24].mae_persistence
    assert sum(r.mae_window for r in ev.values()) < 0.5 * sum(r.mae_persistence for r in ev.values())


def test_query_beats_both_baselines(spark):
    ev = CAT.q_forecast_eval(spark, "/root/testdata/sf0.01").collect()
    mean = lambda c: sum(r[c] for r in ev) / len(ev)
    assert len(ev) == 24 and mean("mae") < min(mean("mae_persistence"), mean("mae_seasonal"))
    assert mean("mse") < min(mean("mse_persistence"), mean("mse_seasonal"))


@pytest.mark.parametrize("window", [1, 24])
def test_save_load_and_score(spark, window):
    split = cycle(spark, 8, stations=2).cache()
    model, path = FC.fit(split, window, features=CYCLE), scratch_path(spark, "model-test")
    FC.save(spark, model, path)
    again = FC.load(spark, path)
    assert again.scaling == model.scaling and (again.coefficients == model.coefficients).all() and again.window == window
    a, b = (sorted(map(tuple, FC.score_next_24h(m, split).collect())) for m in (model, again))
    assert a == b and len(a) == 48 and all(0.0 <= r[4] <= 300.0 for r in a)
    # by hand for one station
    own = sorted((r for r in split.collect() if r["province"] == "p1"), key=lambda r: r["ep"])[-window:]
    x = np.array([1.0, *((r[c] - m) / s for r in own for c, (m, s) in model.scaling.items())])
    want = np.round(np.clip(x @ model.coefficients, 0, 300), 2)
    assert np.allclose([r[4] for r in a if r[0] == "p1"], want, atol=0.011)


def test_short_stations_and_empty_tables(spark):
    split = cycle(spark, 8).cache()
    model = FC.fit(split, 24, features=CYCLE)
    few = split.orderBy("ep").limit(23)
    assert FC.score_next_24h(model, few).count() == 0
    empty = split.limit(0)
    for window in (1, 24):
        none = FC.fit(empty, window, features=CYCLE)
        assert not none.coefficients.any() and FC.score_next_24h(none, empty).count() == 0
        assert FC.evaluate({"": none}, empty).count() == 0


def test_gram_forms_agree(spark):
    rows = [(float(i % 7), float(i * i % 11), [float(i), 1.0]) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, y array<double>").repartition(5)
    one = LS.gram(df, [F.lit(1.0), F.col("a"), F.col("b")], [F.get("y", F.lit(0)), F.get("y", F.lit(1))])
    two = LS.block_gram(df.select(F.array(F.lit(1.0), "a", "b").alias("x"), "y"), "x", "y", 3, 2)
    assert np.array_equal(one[0], two[0]) and np.array_equal(one[1], two[1]) and one[2] == two[2] == 200


@pytest.mark.parametrize("name", ["forecast_24h", "scaling_stats"])
def test_queries_equal_sql(spark, name):
    r = compare(CAT.CATALOG[name](spark, SF_SMALL), duck(SF_SMALL), ORACLE[name])
    assert r["exact"], r
