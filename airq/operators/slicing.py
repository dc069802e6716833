"""Skew-safe per-station windows: slices plus a halo of boundary rows.

A window partitioned by station alone sends a station's whole series to one
task, so a station holding a third of all rows would be one third of the job
in a single task.  Every rolling operator here only looks a bounded distance
back (and sometimes forward), so the series can be cut instead:

* the order value (epoch hour, or the row's position) is cut into slices of
  ``size`` consecutive values;
* each row is also copied into every neighbouring slice whose frames reach
  it (``back`` values before the slice start, ``fwd`` values after its end);
* the window is partitioned by (station, slice) and only each slice's own
  rows are kept afterwards.

This is exact for frames bounded by ``back``/``fwd`` and costs one Generate
(no extra shuffle); the copies are (back + fwd) / size of the rows.

Row-based frames ("the previous 8 rows") need the row's position in its
station.  ``with_row_index`` computes it without a whole-station window:
one window per (station, time slice) numbers the rows and counts the slice,
a prefix sum over the small table of slice counts gives each slice's offset.
That table has one row per station per time slice, so its per-station groups
are bounded by the time span, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Default slice length (hours for time order, rows for position order):
# 30 days of hourly readings.  A halo of 24 rows costs 3 % extra rows, and a
# station with ten years of history still spreads over about 120 slices.
DEFAULT_SLICE = 720
CONF_KEY = "spark.airq.window.slice"

SLICE = "__slice"
OWN = "__own"
RN = "__rn"
N = "__n"


def slice_size(spark: SparkSession | None = None) -> int:
    """Slice length from the session (``spark.airq.window.slice``), else the default."""
    spark = spark or SparkSession.getActiveSession()
    if spark is not None:
        v = spark.conf.get(CONF_KEY, None)
        if v:
            return int(v)
    return DEFAULT_SLICE


def _floor_div(c: Column, size: int) -> Column:
    return F.floor(c / F.lit(size)).cast("long")


def with_slices(df: DataFrame, order: str, back: int = 0, fwd: int = 0,
                size: int | None = None) -> DataFrame:
    """Copy each row into every slice whose frames can reach it.

    A row with order value ``o`` is needed by rows whose value lies in
    [o - fwd, o + back], i.e. by slices floor((o - fwd)/size) ..
    floor((o + back)/size).  Adds ``__slice`` and ``__own`` (True for the
    copy in the row's own slice)."""
    size = size or slice_size(df.sparkSession)
    o = F.col(order)
    slices = F.sequence(_floor_div(o - F.lit(fwd), size), _floor_div(o + F.lit(back), size))
    return (df.withColumn(SLICE, F.explode(slices))
              .withColumn(OWN, F.col(SLICE) == _floor_div(o, size)))


def sliced_window(key, order: str) -> Window:
    """Window over one (station, slice), ordered by ``order``."""
    return Window.partitionBy(*key, SLICE).orderBy(order)


def own_rows(df: DataFrame) -> DataFrame:
    """Keep each row's copy from its own slice; drop the halo copies."""
    return df.filter(F.col(OWN)).drop(SLICE, OWN)


def with_row_index(df: DataFrame, key, ep: str = "ep", size: int | None = None,
                   count: bool = False, written: bool = False) -> DataFrame:
    """Add ``__rn``: 1-based position of the row in its station's ``ep``
    order (``ep`` unique per station), and ``__n`` (rows of the station) when
    ``count``.

    Equal to ``row_number() over (partition by key order by ep)`` but no task
    holds more than one time slice of a station: one window per (station,
    time slice) gives the row number within the slice and the slice's size;
    the slices' first rows form a small table whose prefix sums are the
    offsets, joined back on (station, slice).

    The two branches need different columns, so Spark could not share their
    shuffles and would compute the input twice (an upstream event scan
    included).  The input is therefore written once to the shared checkpoint
    folder (``materialize``) and both branches read that table; this also
    cuts the lineage.  Pass ``written=True`` when ``df`` already is such a
    table."""
    from ..session import materialize
    size = size or slice_size(df.sparkSession)
    if not written:
        df = materialize(df, "rowindex")
    ts = "__ts"
    w = Window.partitionBy(*key, ts)
    local = (df.withColumn(ts, _floor_div(F.col(ep), size))
               .withColumn("__loc", F.row_number().over(w.orderBy(ep)))
               .withColumn("__c", F.count(F.lit(1)).over(w)))
    firsts = local.filter(F.col("__loc") == 1).select(*key, ts, "__c")
    wk = Window.partitionBy(*key).orderBy(ts)
    cols = [*key, ts, F.coalesce(F.sum("__c").over(wk.rowsBetween(Window.unboundedPreceding, -1)),
                                 F.lit(0)).alias("__off")]
    if count:
        cols.append(F.sum("__c").over(Window.partitionBy(*key)).alias(N))
    offsets = firsts.select(*cols)
    return (local.join(offsets, [*key, ts])
                 .withColumn(RN, F.col("__off") + F.col("__loc"))
                 .drop("__off", "__loc", "__c", ts))
