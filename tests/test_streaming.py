"""Streaming: restart from the checkpoint adds nothing; replayed epochs overwrite."""

import pytest

from airq.plans import catalog as CAT
from airq.session import scratch_path
from airq.streaming import pipeline as SP

from .conftest import SF_SMALL


def test_restart_is_idempotent(spark):
    src = CAT._message_files(spark, SF_SMALL)
    out, serving, ckpt = (scratch_path(spark, n) for n in ("h", "s", "c"))
    SP.run_enrich(spark, src, out, serving, ckpt).awaitTermination()
    n1 = spark.read.parquet(serving).count()
    SP.run_enrich(spark, src, out, serving, ckpt).awaitTermination()   # same checkpoint
    assert spark.read.parquet(serving).count() == n1
    # replaying epoch 0 by hand (as after a crash before the commit) replaces its files
    writer = SP.history_writer(out, serving)
    batch = spark.read.parquet(serving).drop("batch_id", "year", "month", "day")
    writer(batch.filter("true"), 0)
    assert spark.read.parquet(serving).count() == n1


def test_latest_stream_matches_batch(spark):
    got = {(r.province, r.district): r.ep for r in CAT.q_stream_latest(spark, SF_SMALL).collect()}
    exp = {(r.province, r.district): r.ep for r in CAT.q_latest_per_station(spark, SF_SMALL).collect()}
    assert got == exp


def test_two_queries_and_await_any(spark):
    src = CAT._message_files(spark, SF_SMALL)
    out, serving, ckpt = (scratch_path(spark, n) for n in ("h2", "s2", "c2"))
    q1, q2 = SP.run_two_queries(spark, src, out, serving, ckpt)
    SP.await_any(spark, 120)
    q1.awaitTermination()
    q2.awaitTermination()
    assert spark.read.parquet(out).count() == spark.read.parquet(serving).count() > 0


def test_stream_nowcast_ignores_repeated_messages(spark):
    """Every message delivered twice: the ring sees one reading per
    station-hour, so the NowCast equals the single-delivery run."""
    def run(copies):
        out = CAT.nowcast_replay(spark, CAT._message_files(spark, SF_SMALL, copies=copies))
        return sorted((tuple(r) for r in out.select("province", "district", "ep", "nowcast").collect()), key=repr)
    once = run(1)
    assert once and run(2) == once


def test_replays_keep_every_row_whatever_the_files(spark):
    """16 files in no time order, 4 per micro-batch: nothing is late or lost."""
    src = scratch_path(spark, "scattered")
    spark.read.text(CAT._message_files(spark, SF_SMALL)).repartition(16).write.text(src)
    n = CAT.readings(spark, SF_SMALL).count()
    assert spark.read.parquet(CAT.dedup_replay(spark, src, max_files=4)).count() == n
    got = CAT.nowcast_replay(spark, src, max_files=4).select("province", "district", "ep", "nowcast")
    want = CAT.q_nowcast_pm25(spark, SF_SMALL).select("province", "district", "ep", "nowcast_pm25")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_late_rows_are_counted(spark):
    """With a short watermark the same replay drops rows, and says how many."""
    src = scratch_path(spark, "late")
    spark.read.text(CAT._message_files(spark, SF_SMALL)).repartition(16).write.text(src)
    out, ckpt = scratch_path(spark, "late-out"), scratch_path(spark, "late-ckpt")
    q = (SP.dedup_stream(SP.read_messages(spark, "files", path=src, max_files=4), "1 hours").writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    n = CAT.readings(spark, SF_SMALL).count()
    assert SP.late_rows(q) == n - spark.read.parquet(out).count() > 0


def test_kafka_options_and_missing_connector(spark):
    opts = SP.kafka_options("h:9092", "t", "earliest", "latest")
    assert opts["endingOffsets"] == "latest" and opts["subscribe"] == "t" and opts["failOnDataLoss"] == "false"
    sink = SP.kafka_sink_options("h:9092", "t")
    assert sink["topic"] == "t" and sink["kafka.acks"] == "all"
    for use in (lambda: SP.read_kafka_batch(spark, "h:9092", "t"),
                lambda: SP.write_kafka(CAT.readings(spark, SF_SMALL).select("province", "district", "pm2_5"), "h:9092", "t")):
        with pytest.raises(Exception, match="(?i)kafka"):   # the image has no connector; nothing is contacted
            use()
