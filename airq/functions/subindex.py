"""Pollutant sub-index and overall index as native expressions.

``sub_index(col, pollutant, profile)`` returns a Spark Column built from a
``when`` chain, so it stays inside whole-stage codegen (no Python worker).
``sub_index_sql`` renders the same rule as SQL text, for SQL functions in Spark.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .profiles import EPA_PM25_CASCADE, EPA_PM25_TOP_VALUE, PROFILES, Profile, segments_for


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _round(x: Column, rounding: str | None) -> Column:
    if rounding == "int":
        return F.bround(x, 0).cast("int")
    if rounding == "float":
        return F.bround(x, 0)
    return x


def _lit(v, rounding):
    if v is None:
        return F.lit(None).cast("int" if rounding == "int" else "double")
    return F.lit(int(v)) if rounding == "int" else F.lit(float(v))


def _warehouse_value(c: Column, s) -> Column:
    # warehouse form: (C - BP_lo) * (I_hi - I_lo) / (BP_hi - BP_lo) + I_lo
    return (c - F.lit(float(s.lo))) * F.lit(float(s.ihi - s.ilo)) / F.lit(float(s.hi - s.lo)) + F.lit(float(s.ilo))


def _linear_value(c: Column, s) -> Column:
    # rule form: ((I_hi - I_lo) / (BP_hi - BP_lo)) * (C - BP_lo) + I_lo
    return F.lit(s.slope) * (c - F.lit(float(s.lo))) + F.lit(float(s.ilo))


def sub_index(c, pollutant: str, profile: str = "vn_stream") -> Column:
    """Sub-index of one pollutant concentration under a named rule set."""
    c = _col(c)
    if profile == "epa_pm25":
        return epa_pm25_continuous(c)
    p: Profile = PROFILES[profile]
    if pollutant not in p.pollutants:
        raise ValueError(f"profile {profile} has no table for {pollutant}")
    r = p.rounding
    expr = F.when(c.isNull(), _lit(p.null, r))
    if p.zero is not None:
        expr = expr.when(c == 0, _lit(p.zero, r))
    if p.negative != "segments":
        expr = expr.when(c < 0, _lit(p.negative, r))
    value_of = _warehouse_value if p.closed == "left" else _linear_value
    for s in segments_for(profile, pollutant):
        upper = (c < s.hi) if p.closed == "left" else (c <= s.hi)
        val = _round(value_of(c, s), r)
        expr = expr.when((c >= s.lo) & upper, val)
    return expr.otherwise(_lit(p.above, r))


def epa_pm25_continuous(c) -> Column:
    """Continuous PM2.5 cascade (first C <= upper wins; negatives extrapolate)."""
    c = _col(c)
    expr = None
    for hi, num, den, c0, i0 in EPA_PM25_CASCADE:
        val = F.lit(num / den) * (c - F.lit(c0)) + F.lit(i0)
        expr = F.when(c <= hi, val) if expr is None else expr.when(c <= hi, val)
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(expr.otherwise(F.lit(EPA_PM25_TOP_VALUE)))


def overall_index(*cols) -> Column:
    """Overall index = largest sub-index (``greatest`` skips NULLs)."""
    cs = [_col(c) for c in cols]
    return F.greatest(*cs) if len(cs) > 1 else cs[0]


# ---------------------------------------------------------------------------
# SQL rendering, for Spark SQL functions
# ---------------------------------------------------------------------------

def _dbl(v: float) -> str:
    return f"{float(v)!r}D"


def _sql_round(x: str, rounding: str | None) -> str:
    if rounding == "int":
        return f"CAST(bround({x}, 0) AS INT)"
    if rounding == "float":
        return f"bround({x}, 0)"
    return x


def _sql_lit(v, rounding):
    if v is None:
        return "CAST(NULL AS INT)" if rounding == "int" else "CAST(NULL AS DOUBLE)"
    return str(int(v)) if rounding == "int" else _dbl(v)


def sub_index_sql(c: str, pollutant: str, profile: str = "vn_stream") -> str:
    if profile == "epa_pm25":
        parts = []
        for hi, num, den, c0, i0 in EPA_PM25_CASCADE:
            val = f"{_dbl(num / den)} * ({c} - {_dbl(c0)}) + {_dbl(i0)}"
            parts.append(f"WHEN {c} <= {_dbl(hi)} THEN {val}")
        return (f"(CASE WHEN {c} IS NULL THEN CAST(NULL AS DOUBLE) {' '.join(parts)} "
                f"ELSE {_dbl(EPA_PM25_TOP_VALUE)} END)")
    p = PROFILES[profile]
    r = p.rounding
    parts = [f"WHEN {c} IS NULL THEN {_sql_lit(p.null, r)}"]
    if p.zero is not None:
        parts.append(f"WHEN {c} = 0 THEN {_sql_lit(p.zero, r)}")
    if p.negative != "segments":
        parts.append(f"WHEN {c} < 0 THEN {_sql_lit(p.negative, r)}")
    for s in segments_for(profile, pollutant):
        lo, hi = _dbl(s.lo), _dbl(s.hi)
        if p.closed == "left":
            val = (f"({c} - {lo}) * {_dbl(s.ihi - s.ilo)} / {_dbl(s.hi - s.lo)}"
                   f" + {_dbl(s.ilo)}")
            cond = f"{c} >= {lo} AND {c} < {hi}"
        else:
            val = f"{_dbl(s.slope)} * ({c} - {lo}) + {_dbl(s.ilo)}"
            cond = f"{c} >= {lo} AND {c} <= {hi}"
        parts.append(f"WHEN {cond} THEN {_sql_round(val, r)}")
    return f"(CASE {' '.join(parts)} ELSE {_sql_lit(p.above, r)} END)"
