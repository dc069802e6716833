"""Session helpers: recommended configuration and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # readings are keyed by naive local time; keep the session zone fixed
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "airq", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.enabled"] = "false"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    On a cluster this is the folder named by ``spark.checkpoint.dir``; without
    one an error is raised, as executors could not see a folder of the driver's.
    Only a session with a local master gets a local folder when it names none.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="airq-ckpt-")
        sc.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


_SESSION_FOLDERS: dict[str, str] = {}


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def session_folder(spark: SparkSession) -> str:
    """This application's own folder below the checkpoint folder.  It is marked
    for deletion when the application ends, with all that queries wrote to it."""
    key = f"{spark.sparkContext.applicationId}|{checkpoint_root(spark)}"
    if key not in _SESSION_FOLDERS:
        folder = f"{checkpoint_root(spark)}/airq-{uuid.uuid4().hex[:12]}"
        fs, p = _hadoop_path(spark, folder)
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        _SESSION_FOLDERS[key] = folder
    return _SESSION_FOLDERS[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the session's folder (with its scheme)."""
    return f"{session_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession) -> None:
    """Delete what this application's queries have written so far.  DataFrames
    that still read such tables must not be used afterwards."""
    for key in [k for k in _SESSION_FOLDERS if k.startswith(spark.sparkContext.applicationId + "|")]:
        fs, p = _hadoop_path(spark, _SESSION_FOLDERS.pop(key))
        fs.delete(p, True)


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage (a lost executor re-reads files instead of
    recomputing the plan) and lets several consumers share one computation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
