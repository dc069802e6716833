"""A keyed table that micro-batches upsert into, with a log that is folded away.

A batch only adds its changed rows to a log, under its batch id.  Reading takes each
key's newest version.  So that neither files nor reading grow with the number of
batches, every ``fold_every`` batches the log is folded into a new base:

    base/<version>/              one row per key
    log/batch_id=<id>/           changed rows of a batch
    _versions/<version>-<id>     marker: this base holds all batches up to <id>

A fold writes the new base first and then makes its marker, one atomic step of the file
system; readers take the base of the newest marker and the log behind it.  A crash in
between leaves a base without a marker, which nobody reads and the next fold
overwrites.  What a fold replaces is deleted by the fold after it, so a reader that
took the marker before keeps its files meanwhile.

A batch that runs again after a failure replaces its own log folder; if it has been
folded already, its new folder lies before the marker and isn't read.  There is one writer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import _hadoop_path

BATCH = "batch_id"


class UpsertTable:
    """``key``: columns that identify a row; a batch holds a key once."""

    def __init__(self, spark: SparkSession, path: str, key, fold_every: int = 16):
        self.spark, self.path, self.key, self.fold_every = spark, path.rstrip("/"), list(key), fold_every

    def _names(self, folder: str) -> list[str]:
        fs, p = _hadoop_path(self.spark, f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _delete(self, name: str) -> None:
        fs, p = _hadoop_path(self.spark, f"{self.path}/{name}")
        fs.delete(p, True)

    def versions(self) -> list[tuple[int, int]]:
        """(version, last batch id it holds), oldest first."""
        return [(int(v), int(b)) for v, b in (n.split("-") for n in self._names("_versions") if not n.startswith("."))]

    def batches(self) -> list[int]:
        """Batch ids in the log."""
        return sorted(int(n.split("=")[1]) for n in self._names("log") if n.startswith(f"{BATCH}="))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Add a batch's rows, in place of what an earlier attempt of it wrote."""
        batch.write.mode("overwrite").parquet(f"{self.path}/log/{BATCH}={batch_id}")
        last = max((b for _, b in self.versions()), default=-1)
        if sum(b > last for b in self.batches()) >= self.fold_every:
            self.fold()

    def sink(self):
        """A function for ``foreachBatch``."""
        return lambda batch, batch_id: self.write(batch, batch_id)

    def read(self, before: int | None = None) -> DataFrame | None:
        """Every key's newest row; None if nothing has been written.  With ``before`` only
        log batches below that id count (a batch that runs again doesn't see itself)."""
        version, last = max(self.versions(), default=(None, -1))
        log = [b for b in self.batches() if b > last and (before is None or b < before)]
        parts = [] if version is None else [self.spark.read.parquet(f"{self.path}/base/{version:010d}")]
        if log:
            parts.append(self.spark.read.option("basePath", f"{self.path}/log").parquet(*[f"{self.path}/log/{BATCH}={b}" for b in log])
                         .withColumn(BATCH, F.col(BATCH).cast("long")))
        if not parts:
            return None
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        cols = [c for c in rows.columns if c not in (*self.key, BATCH)]
        newest = rows.groupBy(*self.key).agg(F.max_by(F.struct(*cols, F.col(BATCH).alias("b_")), BATCH).alias("r"))
        return newest.select(*self.key, *[F.col(f"r.{c}").alias(c) for c in cols], F.col("r.b_").alias(BATCH))

    def rows(self) -> DataFrame | None:
        """`read` without the batch ids."""
        df = self.read()
        return df if df is None else df.drop(BATCH)

    def fold(self) -> None:
        """Put base and log into a new base, and delete what the fold before replaced."""
        self._publish(*self._new_base())
        self._clean()

    def _new_base(self) -> tuple[int, int]:
        batches, versions = self.batches(), self.versions()
        version = max((v for v, _ in versions), default=0) + 1
        last = max([b for _, b in versions] + batches)
        # rebalanced: as many files as the rows need
        self.read().hint("rebalance").write.mode("overwrite").parquet(f"{self.path}/base/{version:010d}")
        return version, last

    def _publish(self, version: int, last: int) -> None:
        fs, p = _hadoop_path(self.spark, f"{self.path}/_versions/{version:010d}-{last:012d}")
        if not fs.createNewFile(p):
            raise RuntimeError(f"another writer published {p}")

    def _clean(self) -> None:
        versions = self.versions()
        if len(versions) < 2:
            return
        version, last = versions[-2]        # still readable; what it replaced isn't needed
        for b in self.batches():
            if b <= last:
                self._delete(f"log/{BATCH}={b}")
        for name in self._names("base"):
            if int(name) < version:
                self._delete(f"base/{name}")
        for v, b in versions[:-2]:
            self._delete(f"_versions/{v:010d}-{b:012d}")
