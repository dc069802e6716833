"""Global row positions without a global window.

``row_number() over (order by ...)`` sends every row to one task.  Here the rows are
sorted by ranges instead: Spark samples the order, deals the rows to tasks by range and
sorts each range.  Every row then carries its place within its range, and the small
table of range sizes (one row per task) gives the offsets by prefix sums, on the driver.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

_PLACE, _TIE = "__place", "__tie"
_LOCAL_BITS = 33    # of monotonically_increasing_id: the row within its partition


def sorted_by_ranges(df: DataFrame, order) -> DataFrame:
    """K3: ``df`` in the global order of ``order``, as a written table with the row's place
    (task and row within the task) in ``__place``.

    Rows that are equal in ``order`` follow each other in any order and may lie in
    neighbouring ranges, so that a value that many rows share doesn't fill one task."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    d = df.withColumn(_TIE, F.monotonically_increasing_id())
    d = d.repartitionByRange(*order, F.col(_TIE)).sortWithinPartitions(*order, _TIE)
    return materialize(d.drop(_TIE).withColumn(_PLACE, F.monotonically_increasing_id()), "ranges")


def with_global_position(df: DataFrame, order, name: str = "position", total: str | None = None) -> DataFrame:
    """``df`` with the 1-based position of each row in the order of ``order`` (columns
    or sort expressions) and, if ``total`` names one, a column with the number of rows.

    An empty table gives an empty result; nulls stand where the sort puts them."""
    placed = sorted_by_ranges(df, order)
    task: Column = F.shiftright(F.col(_PLACE), _LOCAL_BITS)
    sizes = sorted(tuple(r) for r in placed.groupBy(task.alias("t")).agg(F.count(F.lit(1))).collect())      # one row per task
    before = accumulate((n for _, n in sizes), initial=0)
    offsets = df.sparkSession.createDataFrame([(t, b) for (t, _), b in zip(sizes, before)], "__task long, __before long")
    out = placed.withColumn("__task", task).join(offsets, "__task")
    own = F.col(_PLACE).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    cols = [c for c in df.columns if c not in (name, total)]
    extra = [F.lit(sum(n for _, n in sizes)).cast("long").alias(total)] if total else []
    return out.select(*cols, (F.col("__before") + own + 1).alias(name), *extra)
