"""Streams with state per station: they equal the batch whatever the order of the messages."""

import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from airq.operators import clean as C
from airq.operators.daily import daily_aqi
from airq.operators.rolling import nowcast_12h
from airq.plans import catalog as CAT
from airq.session import scratch_path
from airq.streaming import pipeline as SP
from airq.streaming import stations as ST
from airq.streaming.upserts import UpsertTable

from .conftest import SF_SMALL


def readings(seed, hours=200, stations=3):
    """(province, district, hour, pm2_5, o3) with gaps, missing values and repeats."""
    r = random.Random(seed)
    rows = []
    for s in range(stations):
        for e in range(480000, 480000 + hours):
            if r.random() < 0.7 and not (s == 1 and 480060 <= e < 480140):      # station 1 pauses for days
                rows.append(("p", f"d{s}", e, None if r.random() < 0.2 else round(r.random() * 90, 1), None if r.random() < 0.2 else float(round(r.random() * 300))))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "province string, district string, ep long, pm2_5 double, o3 double")
    t = F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_interval(0, 0, 0, 0, int(ep))")
    none = {c: F.lit(None).cast("double") for c in ("pm10", "no2", "so2", "co", "lat", "lon")}
    return df.withColumns({"event_time": t, "timestamp": F.date_format(t, "yyyy-MM-dd'T'HH:mm"), "region": F.lit("north"), **none})


def as_files(spark, rows, order, parts):
    path = scratch_path(spark, "messages")
    rows = {"time": lambda x: x, "back": lambda x: x[::-1], "mixed": lambda x: random.Random(4).sample(x, len(x))}[order](sorted(rows, key=lambda r: r[2]))
    size = -(-len(rows) // parts)
    for k in range(0, len(rows), size):
        text = frame(spark, rows[k:k + size]).select(F.to_json(F.struct(*[f.name for f in C.MESSAGE_SCHEMA.fields])).alias("value"))
        text.coalesce(1).write.mode("append").text(path)
    return path


@pytest.mark.parametrize("order", ["time", "back", "mixed"])
def test_ring_nowcast_equals_batch_in_any_order(spark, order):
    rows = readings(1)
    got = CAT.nowcast_replay(spark, as_files(spark, rows + rows[::5], order, 6), max_files=1)
    want = nowcast_12h(frame(spark, rows), {"pm2_5": "nowcast"})
    cols = ["province", "district", "ep", "nowcast"]
    assert sorted(map(tuple, got.select(cols).collect()), key=repr) == sorted(map(tuple, want.select(cols).collect()), key=repr)


def test_ring_state_has_one_row_per_station(spark):
    src, rows = None, readings(2)
    src = as_files(spark, rows, "mixed", 5)
    table = UpsertTable(spark, scratch_path(spark, "ring"), ["province", "district", "ep"], fold_every=2)
    q = (ST.ring_stream(SP.read_messages(spark, "files", path=src, max_files=1)).writeStream.outputMode("update")
         .foreachBatch(ST.nowcast_sink(table)).option("checkpointLocation", scratch_path(spark, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert [p.stateOperators[0].numRowsTotal for p in q.recentProgress][-1] == 3
    assert table.rows().count() == len(rows)


def test_ring_goes_on_after_a_restart(spark):
    rows = sorted(readings(3), key=lambda r: r[2])
    src, ckpt = scratch_path(spark, "grows"), scratch_path(spark, "ckpt")
    table = UpsertTable(spark, scratch_path(spark, "ring"), ["province", "district", "ep"])
    for part in (rows[:150], rows[150:]):
        frame(spark, part).select(F.to_json(F.struct(*[f.name for f in C.MESSAGE_SCHEMA.fields])).alias("value")).coalesce(1).write.mode("append").text(src)
        q = (ST.ring_stream(SP.read_messages(spark, "files", path=src)).writeStream.outputMode("update")
             .foreachBatch(ST.nowcast_sink(table)).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
    cols = ["province", "district", "ep", "nowcast"]
    want = nowcast_12h(frame(spark, rows), {"pm2_5": "nowcast"})
    assert sorted(map(tuple, table.rows().select(cols).collect()), key=repr) == sorted(map(tuple, want.select(cols).collect()), key=repr)


@pytest.mark.parametrize("order", ["time", "mixed"])
def test_daily_stream_equals_batch_with_gap_days(spark, order):
    rows = readings(5)
    got = CAT.daily_replay(spark, as_files(spark, rows, order, 4), max_files=1).drop("final")
    want = daily_aqi(frame(spark, rows)).select(got.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_daily_stream_closes_days_and_drops_their_state(spark):
    """With a short delay and messages in time order, closed days are final, equal the
    batch, and the state holds open days only."""
    rows = [r for r in readings(6, hours=24 * 12) if r[1] == "d0"]
    src = as_files(spark, rows, "time", 6)
    table = UpsertTable(spark, scratch_path(spark, "days"), ["province", "district", "day"])
    q = (ST.daily_stream(SP.read_messages(spark, "files", path=src, max_files=1), "6 hours").writeStream.outputMode("update")
         .foreachBatch(ST.daily_sink(table)).option("checkpointLocation", scratch_path(spark, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = table.rows()
    assert got.filter("final").count() >= 10
    want = daily_aqi(frame(spark, rows))
    cols = [c for c in want.columns]
    assert sorted(map(tuple, got.select(cols).collect()), key=repr) == sorted(map(tuple, want.select(cols).collect()), key=repr)


def test_quarantine_counts_add_up_and_replays_replace(spark):
    got = {(r["region"], r["kind"]): r["n"] for r in CAT.q_stream_quarantine(spark, SF_SMALL).collect()}
    count = lambda k: got.get((None, k), 0)
    assert count("n_messages") == CAT.readings(spark, SF_SMALL).count()
    assert count("n_messages") == count("n_parsed") + count("n_bad_json") + count("n_bad_time")
    assert count("quarantine json") == count("n_bad_json") > 0 and count("quarantine time") == count("n_bad_time") > 0
    # a batch that runs again replaces its files
    bad, counts, seen = scratch_path(spark, "bad"), scratch_path(spark, "counts"), []
    sink = SP.quarantining(lambda rows, b: seen.append(rows.count()), bad, counts)
    raw = spark.createDataFrame([("{}",), ("no",), ('{"timestamp": "2024-01-01T00:00", "pm2_5": 1}',), (None,)], "value string")
    for _ in range(2):
        sink(raw, 7)
    assert seen == [1, 1] and spark.read.parquet(bad).count() == 3
    assert [tuple(r)[:4] for r in spark.read.parquet(counts).collect()] == [(4, 1, 2, 1)]


def test_rates_per_batch_sum_to_the_metrics(spark):
    listener = SP.RateListener()
    spark.streams.addListener(listener)
    try:
        total = CAT.q_stream_throughput(spark, SF_SMALL).first()
        want = CAT.q_throughput_metrics(spark, SF_SMALL).first()
        assert tuple(total) == tuple(want)
        for _ in range(100):
            if sum(r["n_msgs"] for r in listener.rows) >= want["n_msgs"]:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert sum(r["n_msgs"] for r in listener.rows) == want["n_msgs"] and sum(r["n_bytes"] for r in listener.rows) == want["total_bytes"]
    assert all(r["msgs_per_second"] > 0 and r["mb_per_second"] > 0 for r in listener.rows)


def test_two_cadences_stop_and_restart_while_files_arrive(spark):
    """Two queries on the clock, stopped and started again in between: every
    message lands once in both."""
    src, n, done = scratch_path(spark, "arriving"), 12, threading.Event()
    spark.createDataFrame([], "value string").write.text(src)

    def arrive():
        for i in range(n):
            spark.createDataFrame([(f"m{i}-{k}",) for k in range(5)], "value string").coalesce(1).write.mode("append").text(src)
            time.sleep(0.3)
        done.set()

    outs = {every: (scratch_path(spark, "out"), scratch_path(spark, "ckpt")) for every in ("400 milliseconds", "1 second")}

    def start():
        made = []
        for every, (out, ckpt) in outs.items():
            sink = lambda b, i, out=out: b.write.mode("overwrite").text(f"{out}/batch_id={i}")
            made.append(SP.run_on_clock(SP.read_raw(spark, "files", path=src), sink, ckpt, every))
        return made

    spark.streams.resetTerminated()
    writer = threading.Thread(target=arrive)
    writer.start()
    queries = start()
    time.sleep(2)
    assert not SP.await_any(spark, 1)          # nothing has stopped by itself
    for q in queries:
        SP.stop_gracefully(q, 20)
    assert SP.await_any(spark, 5)
    spark.streams.resetTerminated()
    done.wait(60)
    writer.join()
    queries = start()
    want = sorted(f"m{i}-{k}" for i in range(n) for k in range(5))
    end = time.monotonic() + 60
    while time.monotonic() < end and any(spark.read.text(out).count() < len(want) for out, _ in outs.values()):
        time.sleep(0.5)
    assert all(SP.stop_gracefully(q, 30) for q in queries)
    spark.streams.resetTerminated()
    for out, _ in outs.values():
        assert sorted(r.value for r in spark.read.text(out).collect()) == want
