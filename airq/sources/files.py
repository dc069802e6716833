"""File sources and sinks (S3-S7, S11, S12, S15, S16) and JDBC helpers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_partitioned(df: DataFrame, path: str, layout: str = "ymd", mode: str = "overwrite") -> None:
    """S11 (region/year/month/day) or S12 (region/date) Parquet layout.

    Rows are clustered by the partition columns first so each task writes
    few files per partition; the rebalance lets Spark split a partition that
    is much larger than others over several tasks and files."""
    if layout == "ymd":
        df = df.withColumns({"year": F.year("event_time"), "month": F.month("event_time"),
                             "day": F.dayofmonth("event_time")})
        parts = ["region", "year", "month", "day"]
    else:
        df = df.withColumn("date", F.to_date("event_time"))
        parts = ["region", "date"]
    # K3: rows sorted by time inside each file (tight min/max statistics for
    # row-group skipping on time filters)
    (df.hint("rebalance", *parts).sortWithinPartitions(*parts, "event_time").write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path))


def read_history(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Read the S11 layout back; a time range also prunes the year/month/day
    folders by their date, not only rows."""
    df = spark.read.parquet(path)
    day = F.make_date("year", "month", "day")
    if start is not None:
        s = F.lit(start).cast("timestamp_ntz")
        df = df.filter((F.col("event_time") >= s) & (day >= s.cast("date")))
    if end is not None:
        e = F.lit(end).cast("timestamp_ntz")
        df = df.filter((F.col("event_time") <= e) & (day <= e.cast("date")))
    return df


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV sink (overwrite)."""
    df.write.mode("overwrite").option("header", header).csv(path)


def read_csv(spark: SparkSession, path, schema: T.StructType | None = None) -> DataFrame:
    """S3 (explicit schema) / S4 (no schema: every column is text; convert
    with ``typed`` -- ``try_cast`` keeps a bad cell from failing the job)."""
    r = spark.read.option("header", True)
    return r.schema(schema).csv(path) if schema is not None else r.csv(path)


def typed(df: DataFrame, types: dict) -> DataFrame:
    return df.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in types.items()})


def read_station_files(spark: SparkSession, paths, schema: T.StructType | None = None) -> DataFrame:
    """Many per-station files '<district>_<city>.csv' -> one table with
    district and city taken from each file name."""
    df = read_csv(spark, paths, schema)
    name = F.url_decode(F.regexp_extract(F.input_file_name(), r"([^/]+)\.csv$", 1))
    return df.withColumns({"district": F.regexp_extract(name, r"^(.*)_[^_]*$", 1),
                           "city": F.regexp_extract(name, r"_([^_]*)$", 1)})


def _without_first_lines(n: int, file: str, offset: str):
    """A function over Arrow batches that drops the first ``n`` lines of every file.

    Rows of a split come in file order, and a split at offset 0 begins with its file's first
    lines; a task may read several splits, one after the other.  (Made here, it travels
    to the workers by value.)"""
    def run(batches):
        split, left = None, 0
        for batch in batches:
            path, start = batch.column(file), batch.column(offset)
            size = len(batch)
            if not size:
                continue
            code = pc.dictionary_encode(path).indices.to_numpy(zero_copy_only=False).astype(np.int64)
            at = start.to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((code[1:] != code[:-1]) | (at[1:] != at[:-1])) + 1
            keep = np.ones(size, bool)
            for a, b in zip([0, *turns], [*turns, size]):
                own = (path[int(a)].as_py(), int(at[a]))
                if own != split:
                    split, left = own, n if own[1] == 0 else 0
                k = min(left, b - a)
                keep[a:a + k] = False
                left -= k
            yield batch.filter(pa.array(keep))

    return run


def read_preamble_csv(spark: SparkSession, path: str, header_index: int, schema: T.StructType) -> DataFrame:
    """CSV files whose header sits at line ``header_index`` after some
    metadata lines; the lines after the header are the rows.

    One scan, line by line and in parallel (large files are split like any text
    file).  Every line knows its split's file and offset; the metadata lines and the header are the
    first lines of the split at offset 0 (which must hold them all) and are dropped as the lines
    pass, the rest is parsed with ``from_csv``.  Partition folders (``key=value``) under
    ``path`` come back as columns."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    lines = spark.read.text(path)
    extra = [c for c in lines.columns if c != "value"]
    lines = lines.select("value", *extra, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__offset"))
    body = lines.mapInArrow(_without_first_lines(header_index + 1, "__file", "__offset"), lines.schema).filter(F.length("value") > 0)
    return body.select(F.from_csv("value", ddl).alias("__r"), *extra).select("__r.*", *extra)


def write_preamble_csv(df: DataFrame, path: str, parts, chunk: str, order: str, data_cols,
                       meta: dict) -> None:
    """S5 writer: one CSV per (``parts``, ``chunk``) shaped like an API
    download -- a metadata header and value line (``meta``: name -> column,
    one value per chunk), an empty line, then the column header and the rows
    sorted by ``order``.  A chunk (a bounded time range of one station) is
    one task's file, so no task holds a whole station."""
    cols = [order, *data_cols]
    def txt(c):
        return F.coalesce(c.cast("string"), F.lit(""))
    rows = df.select(*parts, chunk, F.lit(1).alias("__sec"), F.col(order).cast("string").alias("__ord"),
                     F.concat_ws(",", *[txt(F.col(c)) for c in cols]).alias("value"))
    keys = df.groupBy(*parts, chunk).agg(*[F.max(v).alias(k) for k, v in meta.items()])
    lines = [",".join(meta), F.concat_ws(",", *[txt(F.col(k)) for k in meta]), "", ",".join(cols)]
    head = keys.select(*parts, chunk, F.lit(0).alias("__sec"), F.posexplode(F.array(
        *[F.lit(x) if isinstance(x, str) else x for x in lines])).alias("__i", "value"))
    head = head.select(*parts, chunk, "__sec", F.col("__i").cast("string").alias("__ord"), "value")
    (head.unionByName(rows).repartition(*parts, chunk)
     .sortWithinPartitions(*parts, chunk, "__sec", "__ord")
     .select(*parts, chunk, "value").write.mode("overwrite").partitionBy(*parts, chunk).text(path))


def write_snapshot(df: DataFrame, path: str, ts_col: str = "snapshot") -> None:
    """JSON snapshot files, one folder per snapshot minute (append)."""
    (df.withColumn("snapshot_minute", F.date_format(ts_col, "yyyyMMdd_HHmm"))
     .write.mode("append").partitionBy("snapshot_minute").json(path))


def jdbc_read_options(url: str, table: str, user: str | None = None, password: str | None = None,
                      partition_column: str | None = None, lower=None, upper=None,
                      num_partitions: int = 8, fetchsize: int = 10000) -> dict:
    """JDBC scan options; with a partition column the table is read by
    ``num_partitions`` parallel range queries instead of one connection."""
    o = {"url": url, "dbtable": table, "fetchsize": str(fetchsize)}
    if user:
        o.update(user=user, password=password or "")
    if partition_column:
        o.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                 numPartitions=str(num_partitions))
    return o


def jdbc_write(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 1000,
               num_partitions: int | None = None, truncate: bool = True, **props) -> None:
    """Append (micro-batches) or overwrite with TRUNCATE (keeps
    the table definition); ``num_partitions`` caps concurrent connections."""
    w = (df.coalesce(num_partitions) if num_partitions else df).write.format("jdbc")
    w = w.option("url", url).option("dbtable", table).option("batchsize", batchsize)
    if mode == "overwrite":
        w = w.option("truncate", str(truncate).lower())
    for k, v in props.items():
        w = w.option(k, v)
    w.mode(mode).save()
