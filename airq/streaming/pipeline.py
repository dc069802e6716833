"""Structured Streaming jobs.

Source: Kafka in production (``kafka_options``); the connector jar is not
part of the local image, so tests replay the same JSON messages from files
(``readStream.json``) -- the operators downstream are identical.
"""

from __future__ import annotations

import time
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators import aqi as A
from ..operators import clean as C
from ..sources.adapter import STATION_KEY, epoch_hour


def kafka_options(bootstrap: str, topic: str, starting: str = "latest", ending: str | None = None,
                  fail_on_data_loss: bool = False) -> dict:
    """Options for ``readStream``/``read`` ``.format('kafka')``."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if ending:
        opts["endingOffsets"] = ending
    return opts


def read_kafka_batch(spark: SparkSession, bootstrap: str, topic: str, starting: str = "earliest", ending: str = "latest") -> DataFrame:
    """A bounded read of a topic, parsed; needs the Kafka connector."""
    raw = spark.read.format("kafka").options(**kafka_options(bootstrap, topic, starting, ending)).load()
    return C.parse_json(raw.select("value"))


def kafka_sink_options(bootstrap: str, topic: str) -> dict:
    """Producer options (all replicas acknowledge, compressed batches)."""
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic, "kafka.acks": "all",
            "kafka.compression.type": "zstd", "kafka.batch.size": str(1 << 20)}


def write_kafka(df: DataFrame, bootstrap: str, topic: str, cols=None) -> None:
    """Rows as JSON values keyed by 'province_district', so that a
    station's messages keep their order in one partition of the topic."""
    C.encode_messages(df, cols).write.format("kafka").options(**kafka_sink_options(bootstrap, topic)).save()


def read_messages(spark: SparkSession, kind: str, **opts) -> DataFrame:
    """Streaming message source: ``kind='kafka'`` (value bytes) or ``'files'``
    (one JSON message per line in ``opts['path']``)."""
    if kind == "kafka":
        raw = spark.readStream.format("kafka").options(**opts).load()
        return C.parse_json(raw.select("value"))
    if kind == "files":
        return (spark.readStream.schema(C.MESSAGE_SCHEMA)
                .option("maxFilesPerTrigger", opts.get("max_files", 1000)).json(opts["path"]))
    raise ValueError(kind)


def read_raw(spark: SparkSession, kind: str, **opts) -> DataFrame:
    """The same source before parsing: the message text as ``value``."""
    if kind == "kafka":
        return spark.readStream.format("kafka").options(**opts).load().select("value")
    if kind == "files":
        return spark.readStream.option("maxFilesPerTrigger", opts.get("max_files", 1000)).text(opts["path"])
    raise ValueError(kind)


def quarantining(writer, quarantine_path: str, counts_path: str):
    """A foreachBatch function over raw messages.  Messages that are no JSON object
    (reason 'json') or have no readable time ('time') go to a quarantine folder with
    their text; ``writer(parsed rows with event_time, batch id)`` gets the others.  One row per batch
    counts all three, so no message is lost without a count.  A batch that runs again replaces
    what it wrote."""
    def write(batch: DataFrame, batch_id: int):
        text = F.col("value").cast("string")
        no_json = F.try_parse_json(text).isNull() | ~F.coalesce(text.startswith("{"), F.lit(False))
        d = batch.select(text.alias("raw"), no_json.alias("no_json"), F.from_json(text, C.MESSAGE_SCHEMA).alias("d"))
        d = d.withColumn("event_time", F.col("d.timestamp").try_cast("timestamp_ntz"))
        d = d.withColumn("reason", F.when(F.col("no_json"), "json").when(F.col("event_time").isNull(), "time")).persist()
        try:
            bad = d.filter(F.col("reason").isNotNull()).select("raw", "reason")
            bad.coalesce(FILES).write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={batch_id}")
            (d.agg(F.count(F.lit(1)).alias("n_messages"), F.count_if(F.col("reason").isNull()).alias("n_parsed"),
                   F.count_if(F.col("reason") == "json").alias("n_bad_json"), F.count_if(F.col("reason") == "time").alias("n_bad_time"))
             .write.mode("overwrite").parquet(f"{counts_path}/batch_id={batch_id}"))
            writer(d.filter(F.col("reason").isNull()).select("d.*", "event_time").drop("timestamp"), batch_id)
        finally:
            d.unpersist()

    return write


def enrich_stream(msgs: DataFrame) -> DataFrame:
    """Parse time, keep rows with a PM value, passthrough NowCast (W6),
    sub-indices, overall index, labels, ingestion stamp (P15)."""
    return enrich_parsed(C.parse_event_time(msgs).drop("timestamp"))


def enrich_parsed(df: DataFrame) -> DataFrame:
    """`enrich_stream` behind the time parse."""
    df = A.enrich(df, nowcast="passthrough")
    return df.withColumn("ep", epoch_hour("event_time")).withColumn("ingested_at", F.current_timestamp())


FILES = 4   # files a batch writes into one day's folder, at most


def clustered(df: DataFrame, *folders: str) -> DataFrame:
    """``df`` dealt by its output folders, each to ``FILES`` tasks by station, so that a
    batch writes a few files a folder (not one per task) and a full folder still has
    several writers."""
    return df.repartition(*folders, F.pmod(F.xxhash64(*STATION_KEY), F.lit(FILES)))


DAY_FOLDERS = ("region", "year", "month", "day")


def history_writer(out_path: str, serving_path: str):
    """One foreachBatch feeding both sinks.

    The batch is persisted once (a single source read for two sinks) and
    written with dynamic partition overwrite keyed by the batch id, so a
    replayed epoch after a failure replaces its own files (exactly-once
    effect) instead of appending duplicates."""
    def write(batch: DataFrame, epoch_id: int):
        b = batch.withColumn("batch_id", F.lit(epoch_id)).persist()
        try:
            if b.isEmpty():
                return
            hist = b.withColumns({"year": F.year("event_time"), "month": F.month("event_time"),
                                  "day": F.dayofmonth("event_time")})
            (clustered(hist, *DAY_FOLDERS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*DAY_FOLDERS, "batch_id").parquet(out_path))
            # serving copy (the JDBC table in production; see sources.jdbc)
            (b.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(serving_path))
        finally:
            b.unpersist()
    return write


def run_enrich(spark: SparkSession, src: str, out_path: str, serving_path: str, ckpt: str,
               trigger: dict | None = None):
    q = (enrich_stream(read_messages(spark, "files", path=src)).writeStream
         .foreachBatch(history_writer(out_path, serving_path))
         .option("checkpointLocation", ckpt)
         .trigger(**(trigger or {"availableNow": True})).start())
    return q


def with_event_ts(df: DataFrame) -> DataFrame:
    """Watermarks need a TIMESTAMP column; ``event_ts`` is the NTZ event time
    read in the session zone (keep the session zone fixed, e.g. UTC)."""
    return df.withColumn("event_ts", F.col("event_time").cast("timestamp"))


def replay_delay(messages: DataFrame) -> str:
    """Watermark delay under which no message of a bounded replay is late,
    whatever the order of its files and however many a micro-batch takes: the
    span of the replay's event times.  (A live source uses the lateness it
    tolerates instead, and watches ``late_rows``.)"""
    e = C.parse_event_time(messages).agg(F.min("event_time").alias("a"), F.max("event_time").alias("b")).first()
    hours = (e["b"] - e["a"]).total_seconds() // 3600 + 1 if e["a"] else 1
    return f"{int(hours)} hours"


def late_rows(query) -> int:
    """Rows that the query's watermark has dropped so far."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def dedup_stream(msgs: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Drop repeated (station, hour) messages, keeping the state of ``delay``.

    Messages older than the newest one minus ``delay`` are late and dropped
    (``late_rows`` counts them): a replay passes ``replay_delay``."""
    df = with_event_ts(C.parse_event_time(msgs))
    return (df.withWatermark("event_ts", delay)
            .dropDuplicatesWithinWatermark([*STATION_KEY, "event_time"])
            .drop("event_ts"))


def latest_stream(enriched: DataFrame) -> DataFrame:
    """Live latest row per station (``max_by`` keeps one row per key in
    state; ties on time are broken by ingestion time)."""
    cols = [c for c in enriched.columns if c not in STATION_KEY]
    order = F.struct("event_time", "ingested_at")
    return (enriched.groupBy(*STATION_KEY)
            .agg(F.max_by(F.struct(*cols), order).alias("r"))
            .select(*STATION_KEY, "r.*"))


def run_two_queries(spark: SparkSession, src: str, out_path: str, serving_path: str, ckpt_root: str,
                    triggers=({"availableNow": True}, {"availableNow": True})):
    """The original layout -- two independent queries over the same
    source, each with its own checkpoint and trigger (e.g. 60 s / 30 s with
    ``processingTime``).  ``run_enrich`` is the cheaper single-read form."""
    enriched = enrich_stream(read_messages(spark, "files", path=src))

    def history(batch, epoch_id):
        if batch.isEmpty():
            return
        hist = batch.withColumns({"batch_id": F.lit(epoch_id), "year": F.year("event_time"),
                                  "month": F.month("event_time"), "day": F.dayofmonth("event_time")})
        (clustered(hist, *DAY_FOLDERS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*DAY_FOLDERS, "batch_id").parquet(out_path))

    def serving(batch, epoch_id):
        if batch.isEmpty():
            return
        (batch.withColumn("batch_id", F.lit(epoch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(serving_path))

    q1 = (enriched.writeStream.foreachBatch(history).option("checkpointLocation", f"{ckpt_root}/history")
          .trigger(**triggers[0]).start())
    q2 = (enriched.writeStream.foreachBatch(serving).option("checkpointLocation", f"{ckpt_root}/serving")
          .trigger(**triggers[1]).start())
    return q1, q2


def await_any(spark: SparkSession, timeout_s: float | None = None) -> bool:
    """T5: block until any active query stops (or the timeout passes)."""
    return spark.streams.awaitAnyTermination(timeout_s) if timeout_s else spark.streams.awaitAnyTermination()


def run_on_clock(stream: DataFrame, sink, ckpt: str, every: str):
    """``stream`` into a foreachBatch sink, a micro-batch every ``every`` (e.g. '60 seconds')."""
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).trigger(processingTime=every).start()


def stop_gracefully(query, timeout_s: float = 60.0, poll_s: float = 0.1) -> bool:
    """Stop a query between two micro-batches: wait until it has nothing to do, at most
    ``timeout_s``.  True if it was idle; either way the checkpoint says where to go on."""
    end = time.monotonic() + timeout_s
    idle = False
    while query.isActive and not idle and time.monotonic() < end:
        s = query.status
        idle = not s["isTriggerActive"] and not s["isDataAvailable"]
        if not idle:
            time.sleep(poll_s)
    query.stop()
    return idle


def observed(df: DataFrame, name: str = "throughput", value_col: str = "value") -> DataFrame:
    """counts messages and bytes of every micro-batch as they pass, without a job of its own."""
    return df.observe(name, F.count(F.lit(1)).alias("n_msgs"), F.coalesce(F.sum(F.octet_length(value_col)), F.lit(0)).alias("n_bytes"))


class RateListener(StreamingQueryListener):
    """a row (query id, batch id, messages, bytes, seconds, messages a second, MB a second)
    per micro-batch of every query that passes through `observed`.  ``keep`` rows are
    held for inspection; ``report`` gets each one."""

    def __init__(self, name: str = "throughput", report=None, keep: int = 1000):
        self.name, self.report, self.rows = name, report, deque(maxlen=keep)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        seen = p.observedMetrics.get(self.name)
        if seen is None or not seen["n_msgs"]:
            return
        seconds = p.batchDuration / 1000
        rate = lambda x: x / seconds if seconds else None
        row = {"query": str(p.id), "batch_id": p.batchId, "n_msgs": seen["n_msgs"], "n_bytes": seen["n_bytes"], "seconds": seconds,
               "msgs_per_second": rate(seen["n_msgs"]), "mb_per_second": rate(seen["n_bytes"] / 1e6)}
        self.rows.append(row)
        if self.report:
            self.report(row)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
