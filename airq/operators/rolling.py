"""Per-station rolling operators.

Every window is partitioned by (station, slice) with a halo of the rows the
frames reach across the slice edge (``slicing``), so a station with a huge
share of the rows is still spread over many tasks; frames hold at most
12/24 rows, so memory per row is constant whatever the data size.  Row-based
frames run on the exact per-station row position, as range frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import round_binary_half_even
from ..sources.adapter import STATION_KEY
from .clean import present
from .slicing import RN, own_rows, sliced_window, with_row_index, with_slices


def _nowcast_value(pts: Column, t: Column, n3: Column, cmin: Column, cmax: Column) -> Column:
    w = F.greatest(F.lit(0.5), F.try_divide(cmin, cmax))

    def weight(p):
        return F.pow(w, (t - p["e"]).cast("double"))

    num = F.aggregate(pts, F.lit(0.0), lambda acc, p: acc + weight(p) * p["v"])
    den = F.aggregate(pts, F.lit(0.0), lambda acc, p: acc + weight(p))
    return F.when(n3 < 2, F.lit(None).cast("double")).when(cmax == 0, F.lit(0.0)).otherwise(F.try_divide(num, den))


def _rounded(x: Column) -> Column:
    """Half-even rounding to 2 digits with its argument bound once: the rule
    names it many times, and would repeat a whole weighted sum each time."""
    return F.get(F.transform(F.array(x), lambda v: round_binary_half_even(v, 2)), F.lit(0))


def nowcast_12h_expr(pts: Column, t: Column) -> Column:
    """NowCast from a list of (e=epoch hour, v=value) of the last 12 hours,
    newest first.

    At least 2 of the newest 3 hours must be present, else NULL; if the
    largest value is 0 the result is 0; otherwise w = max(1/2, min/max) and
    the result is sum(w^i c_i) / sum(w^i) over present hours (i = hours
    back), rounded to 2 decimals as Python's ``round`` does (half-even on the
    exact binary value).
    """
    n3 = F.size(F.filter(pts, lambda p: p["e"] >= t - 2))
    vs = F.transform(pts, lambda p: p["v"])
    return _rounded(_nowcast_value(pts, t, n3, F.array_min(vs), F.array_max(vs)))


def nowcast_12h(df: DataFrame, cols: dict, key=STATION_KEY, ep_col: str = "ep",
                hours: int = 12, size: int | None = None) -> DataFrame:
    """Add NowCast columns; ``cols`` maps input column -> output column.

    The frame is a time range (``rangeBetween`` on epoch hours), so missing
    hours count as missing, not as the previous row.  The 2-of-3 count and
    the min/max are native window aggregates; only the weighted sums walk the
    collected (at most 12-element) list."""
    df = with_slices(df, ep_col, back=hours - 1, size=size)
    base = sliced_window(key, ep_col)
    w12 = base.rangeBetween(-(hours - 1), 0)
    w3 = base.rangeBetween(-2, 0)
    tmp = {}
    for src, out in cols.items():
        v = present(src)
        pt = F.when(v.isNotNull(), F.struct(F.col(ep_col).alias("e"), v.alias("v")))
        # newest first, the order in which the weights are accumulated
        tmp[f"__pts_{out}"] = F.sort_array(F.collect_list(pt).over(w12), asc=False)
        tmp[f"__n3_{out}"] = F.count(v).over(w3)
        tmp[f"__mn_{out}"] = F.min(v).over(w12)
        tmp[f"__mx_{out}"] = F.max(v).over(w12)
    df = df.withColumns(tmp)
    df = df.withColumns({out: _rounded(_nowcast_value(F.col(f"__pts_{out}"), F.col(ep_col), F.col(f"__n3_{out}"),
                                                      F.col(f"__mn_{out}"), F.col(f"__mx_{out}")))
                         for out in cols.values()})
    return own_rows(df).drop(*tmp.keys())


def nowcast_batch(df: DataFrame, cols: dict, key=STATION_KEY, ep_col: str = "ep",
                  size: int | None = None) -> DataFrame:
    """The vectorised batch variant (row-positional, oldest-first weights).

    For each row but the first of a station: take the last 12 rows, drop
    missing values (oldest first); none -> NULL, one -> that value; max 0 ->
    0; w = max(min/max, 1/2); if w == 1/2 the result is sum(c_j * w^(j+1))
    (not normalised), else sum(c_j w^j) / sum(w^j).
    """
    df = with_slices(with_row_index(df, key, ep_col, size), RN, back=11, size=size)
    w = sliced_window(key, RN).rangeBetween(-11, 0)   # = the last 12 rows
    tmp = {}
    for src, out in cols.items():
        v = present(src)
        pt = F.when(v.isNotNull(), F.struct(F.col(ep_col).alias("e"), v.alias("v")))
        tmp[f"__vals_{out}"] = F.transform(F.sort_array(F.collect_list(pt).over(w)), lambda p: p["v"])
        tmp[f"__n_{out}"] = F.count(v).over(w)
        tmp[f"__mn_{out}"] = F.min(v).over(w)
        tmp[f"__mx_{out}"] = F.max(v).over(w)
    df = df.withColumns(tmp)
    outs = {}
    for out in cols.values():
        vals = F.col(f"__vals_{out}")
        n, cmin, cmax = F.col(f"__n_{out}"), F.col(f"__mn_{out}"), F.col(f"__mx_{out}")
        wt = F.greatest(F.try_divide(cmin, cmax), F.lit(0.5))
        half = F.aggregate(F.transform(vals, lambda x, j: x * F.pow(F.lit(0.5), (j + 1).cast("double"))),
                           F.lit(0.0), lambda a, b: a + b)
        num = F.aggregate(F.transform(vals, lambda x, j: x * F.pow(wt, j.cast("double"))),
                          F.lit(0.0), lambda a, b: a + b)
        den = F.aggregate(F.transform(vals, lambda x, j: F.pow(wt, j.cast("double"))),
                          F.lit(0.0), lambda a, b: a + b)
        outs[out] = (F.when((F.col(RN) == 1) | (n == 0), F.lit(None).cast("double"))
                     .when(n == 1, cmax)
                     .when(cmax == 0, F.lit(0.0))
                     .when(wt == 0.5, half)
                     .otherwise(F.try_divide(num, den)))
    return own_rows(df.withColumns(outs)).drop(RN, *tmp.keys())


def ozone_8h(df: DataFrame, src: str = "o3", out: str = "o3_8h", key=STATION_KEY,
             ep_col: str = "ep", size: int | None = None) -> DataFrame:
    """Sum of up to 8 trailing rows (missing skipped) always divided by 8,
    rounded half-even to an integer; the first row of a station is NULL and an
    all-missing frame gives 0."""
    df = with_slices(with_row_index(df, key, ep_col, size), RN, back=7, size=size)
    s = F.sum(present(src)).over(sliced_window(key, RN).rangeBetween(-7, 0))
    val = F.bround(F.coalesce(s, F.lit(0.0)) / F.lit(8.0), 0)
    return own_rows(df.withColumn(out, F.when(F.col(RN) > 1, val))).drop(RN)


def trailing_mean(df: DataFrame, specs: list, key=STATION_KEY, ep_col: str = "ep",
                  by: str = "rows", size: int | None = None) -> DataFrame:
    """``avg_{col}_{n}h`` over the last n rows (``by='rows'``) or the last
    n hours (``by='hours'``) of each station.  ``specs`` = [(col, n), ...]."""
    back = max(n for _, n in specs) - 1
    order = RN if by == "rows" else ep_col
    if by == "rows":
        df = with_row_index(df, key, ep_col, size)
    df = with_slices(df, order, back=back, size=size)
    w = sliced_window(key, order)
    cols = {f"avg_{c}_{n}h": F.avg(present(c)).over(w.rangeBetween(1 - n, 0)) for c, n in specs}
    out = own_rows(df.withColumns(cols))
    return out.drop(RN) if by == "rows" else out


def nowcast_passthrough(c) -> Column:
    """The live job's simplification -- current value, missing -> 0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("double"), F.lit(0.0))
