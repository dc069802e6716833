"""The upsert table: newest versions, bounded files, crashes between write and publish."""

import os

import pytest
from pyspark.sql import functions as F

from airq.session import scratch_path
from airq.streaming.upserts import UpsertTable


def batch(spark, i, keys):
    return spark.createDataFrame([(k, i, f"v{i}-{k}") for k in keys], "k long, n long, v string").coalesce(1)


def files(path):
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]


def contents(table):
    return {r["k"]: (r["n"], r["v"]) for r in table.rows().collect()}


def test_hundred_batches_leave_files_and_reads_bounded_by_the_keys(spark):
    table = UpsertTable(spark, scratch_path(spark, "upserts"), ["k"], fold_every=8)
    assert table.read() is None
    want, most = {}, 0
    for i in range(100):
        keys = [i % 10, 10 + i % 3]
        table.write(batch(spark, i, keys), i)
        want.update({k: (i, f"v{i}-{k}") for k in keys})
        most = max(most, len(files(table.path)))
    assert contents(table) == want
    # two bases of one file, and the log of two folds
    assert most <= 2 + 2 * 8 + 1 and len(table.versions()) == 2 and len(table.read().inputFiles()) <= 1 + 8


@pytest.mark.parametrize("step", ["_publish", "_clean"])
def test_crash_while_folding_loses_nothing(spark, step, monkeypatch):
    """A crash between the new base and its marker, or between marker and cleaning."""
    table = UpsertTable(spark, scratch_path(spark, "crash"), ["k"], fold_every=3)
    for i in range(5):
        table.write(batch(spark, i, [1, i]), i)
    before = contents(table)
    with monkeypatch.context() as m:
        m.setattr(UpsertTable, step, lambda self, *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            table.write(batch(spark, 5, [1, 5]), 5)
    want = {**before, 1: (5, "v5-1"), 5: (5, "v5-5")}
    assert contents(table) == want
    # the batch runs again, and the stream goes on
    table.write(batch(spark, 5, [1, 5]), 5)
    assert contents(table) == want
    for i in range(6, 12):
        table.write(batch(spark, i, [2, i]), i)
        want.update({2: (i, f"v{i}-2"), i: (i, f"v{i}-{i}")})
    assert contents(table) == want


def test_a_replayed_batch_replaces_its_rows_and_does_not_see_itself(spark):
    table = UpsertTable(spark, scratch_path(spark, "replay"), ["k"], fold_every=100)
    table.write(batch(spark, 0, [1, 2]), 0)
    table.write(batch(spark, 1, [2, 3]), 1)
    assert {r["k"]: r["n"] for r in table.read(before=1).collect()} == {1: 0, 2: 0}
    table.write(batch(spark, 1, [2]).withColumn("v", F.lit("again")), 1)
    assert contents(table) == {1: (0, "v0-1"), 2: (1, "again")}


def test_a_reader_keeps_its_files_during_the_next_fold(spark):
    table = UpsertTable(spark, scratch_path(spark, "reader"), ["k"], fold_every=100)
    for i in range(3):
        table.write(batch(spark, i, [i]), i)
    table.fold()
    table.write(batch(spark, 3, [0]), 3)
    reader = table.rows()                   # took the first marker
    table.fold()
    assert {r["k"]: r["n"] for r in reader.collect()} == {0: 3, 1: 1, 2: 2}
