"""Exact Python-style rounding (half-even on the binary value) in Spark."""

import random

from pyspark.sql import functions as F

from airq.functions.rounding import round_binary_half_even


def test_matches_python_round(spark):
    rnd = random.Random(11)
    vals = [18.115, 44.785, 2.675, 0.125, 18.125, 1.005, 0.0, 99.995, -2.675, -0.125]
    vals += [round(rnd.uniform(0, 600), 3) for _ in range(1500)] + [k / 8 for k in range(0, 2000, 3)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = [r.y for r in df.select("i", round_binary_half_even(F.col("x"), 2).alias("y")).orderBy("i").collect()]
    assert got == [round(v, 2) for v in vals]
    assert spark.range(1).select(round_binary_half_even(F.lit(None).cast("double"), 2)).first()[0] is None
