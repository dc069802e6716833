"""Rounding that matches Python's ``round(x, d)`` on doubles.

Python rounds the exact binary value half-even (so 18.115, stored as
18.11499999..., becomes 18.11), while Spark's ``bround`` rounds the shortest
decimal text (18.12).  ``round_binary_half_even`` splits x*10^d into the
rounded product p and its exact error (Dekker's TwoProduct, plain double
arithmetic) and only breaks a tie of p by the sign of that error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2^27 + 1 (Veltkamp split of a double into 26-bit halves)


def round_binary_half_even(x: Column, digits: int) -> Column:
    s = F.lit(float(10 ** digits))
    p = x * s
    c = x * F.lit(_SPLIT)
    hi = c - (c - x)
    lo = x - hi
    err = (hi * s - p) + lo * s          # x * 10^d == p + err exactly
    fl = F.floor(p).cast("double")
    frac = p - fl
    tie = (F.when(err > 0, fl + 1).when(err < 0, fl)
           .otherwise(F.when(F.pmod(fl, F.lit(2.0)) == 0, fl).otherwise(fl + 1)))
    r = F.when(frac > 0.5, fl + 1).when(frac < 0.5, fl).otherwise(tie)
    return F.when(x.isNull() | F.isnan(x), x).otherwise(r / s)
