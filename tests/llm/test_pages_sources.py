import base64
import glob
import gzip
import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F

from airq.llm import curriculum, license_scan, warc
from airq.llm.queries import ORACLE, QUERIES

from ..conftest import SF_SMALL
from .conftest import same_rows

PAGES = "page_id long, url string, html string, digest string, id int"


def pages(spark):
    rows = [(i, f"http://x/{i}", "same ✓" if i % 3 == 0 else f"<p>{i}</p>\r\n\r\nWARC/1.1\r\n", "d", 1) for i in range(30)]
    rows += [(100, None, None, "d", 1), (101, "u\r\nX: y", "", "d", 1), (None, "u", "same ✓", "d", 1), (102, "u", "x" * 3_000_000, "d", 1),
             (103, "u", "only null ids below", "d", 1), (None, "u", "nobody", "d", 1), (None, "v", "nobody", "d", 1), (27, "http://x/27", "same ✓", "d", 1)]
    return spark.createDataFrame(rows, PAGES).repartition(3), rows


def local(folder):
    return folder.removeprefix("file://").removeprefix("file:")


def test_archives_members_and_index(spark):
    df, rows = pages(spark)
    folder = warc.archive_folder(spark)
    warc.write_monolithic(warc.mark_duplicates(df, "page_id", "url", "html"), folder)
    for path in glob.glob(local(folder) + "/*.gz"):  # one member each
        d = zlib.decompressobj(31)
        d.decompress(open(path, "rb").read())
        assert d.eof and not d.unused_data
    index = warc.normalise(spark, folder)
    for r in index.collect():  # each record is a member of its own
        with open(local(r["archive"]), "rb") as f:
            f.seek(r["offset"])
            text = gzip.decompress(f.read(r["length"]))
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n") and r["record_id"].encode() in text
    got = warc.read_records(index).collect()
    assert len(got) == len(rows)
    responses = {r["headers"].get("X-Page-ID"): bytes(r["payload"]).decode() for r in got if r["headers"]["WARC-Type"] == "response"}
    assert responses["102"] == "x" * 3_000_000 and responses["27"] == "same ✓" and responses["101"] == ""
    keeper = {}
    for i, _, h, *_ in rows:
        if i is not None:
            keeper[h or ""] = max(keeper.get(h or "", i), i)
    want = sorted((str(i), "response" if i == keeper.get(h or "") else "revisit", str(None if i == keeper.get(h or "") else keeper[h or ""])) if (h or "") in keeper
                  else (str(i), "response", "None") for i, _, h, *_ in rows)
    assert sorted((str(r["headers"].get("X-Page-ID")), r["headers"]["WARC-Type"], str(r["headers"].get("X-Refers-To-Page"))) for r in got) == want
    sha = base64.b32encode(hashlib.sha1("same ✓".encode()).digest()).decode()
    assert sum(r["headers"]["WARC-Payload-Digest"] == f"sha1:{sha}" for r in got) == sum(h == "same ✓" for _, _, h, *_ in rows)


def test_minimum_size_keeps_small_payloads(spark):
    df, rows = pages(spark)
    got = warc.mark_duplicates(df, "page_id", "url", "html", min_bytes=1000).collect()
    assert {r["record_type"] for r in got} == {"response"}


def test_reader_takes_many_members_and_rejects_damage():
    one = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    data = gzip.compress(one) + gzip.compress(one + one)
    assert [b for _, b in warc.split_records(warc.inflate(io.BytesIO(data).read))] == [b"abc"] * 3
    with pytest.raises(ValueError):
        list(warc.split_records([one[:-5]]))
    with pytest.raises(ValueError):
        list(warc.split_records([b"junk\r\n\r\n"]))


def test_warc_table_matches_sql(spark, oracle):
    same_rows(QUERIES["op4_warc_normalise"](spark, SF_SMALL), *oracle(SF_SMALL, ORACLE["op4_warc_normalise"]))


def test_warc_empty_table(spark):
    folder = warc.archive_folder(spark)
    warc.write_monolithic(warc.mark_duplicates(spark.createDataFrame([], PAGES), "page_id", "url", "html"), folder)
    assert warc.read_records(warc.normalise(spark, folder)).collect() == []


DOCS = "doc_id long, text string, source string, size string, mix_key int, passes int"


def mixed(spark, rows, **more):
    df = spark.createDataFrame(rows, DOCS)
    return curriculum.mix(df, "doc_id", "text", "source", **more)


def test_curriculum_targets_takes_and_positions(spark):
    rows = [(i, "w " * (i % 17), "hot" if i % 3 else f"s{i % 5}", "z", 1, 2) for i in range(400)] + [(900, "a b c", None, "z", 1, 2), (901, None, "none", "z", 1, 2), (None, "a b", "s1", "z", 1, 2),
                                                                                              (5, "w " * 5, "hot", "z", 1, 2)]
    out = mixed(spark, rows, bins=8)
    assert out.columns == ["doc_id", "text", "source", "mix_key", "size", "source_size", "target", "taken", "passes", "first_position"]
    got = out.collect()
    by = {}
    for r in got:
        assert r["size"] == len((r["text"] or "").split()) and 0 <= r["taken"] <= 2 * r["size"]
        assert (r["first_position"] is not None) == (r["taken"] > 0) and sum(p["words"] for p in r["passes"]) == r["taken"]
        assert all(0 <= p["position"] <= 1 for p in r["passes"])
        by.setdefault(r["source"], []).append(r)
    total = 0
    for source, rs in by.items():
        assert sum(r["size"] for r in rs) == rs[0]["source_size"] and sum(r["taken"] for r in rs) == int(rs[0]["target"])
        assert rs[0]["target"] <= 2 * rs[0]["source_size"]
        total += rs[0]["target"]
    assert total == pytest.approx(1.5 * sum(r["size"] for r in got))
    # sources below their cap share by weight
    names = sorted((s for s in by if s is not None)) + [None]
    weight = {s: curriculum.WEIGHTS[k % 3] for k, s in enumerate(names)}
    free = {by[s][0]["target"] / weight[s] for s in names if by[s][0]["target"] < 2 * by[s][0]["source_size"] - 1e-9}
    assert max(free) - min(free) < 1e-6 * max(free)
    assert all(by[s][0]["target"] / weight[s] <= min(free) + 1e-6 for s in names)
    again = mixed(spark, rows[::-1], bins=8)
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"], r["first_position"] or -1)
    assert sorted(map(key, again.collect())) == sorted(map(key, got))


def test_curriculum_follows_its_schedules(spark):
    rows = [(i, "w " * 10, "ab"[i % 2], "z", 1, 2) for i in range(2000)]
    out = mixed(spark, rows, weights=(1.0,), total_ratio=1.0, schedules=((0.0, 2.0), (1.0, 1.0)))
    order = curriculum.in_training_order(out, "doc_id")
    got = order.collect()
    assert [r["position"] for r in got] == sorted(r["position"] for r in got)
    for t in (0.25, 0.5, 0.75):
        share = {s: sum(r["pass_words"] for r in got if r["source"] == s and r["position"] <= t) / 10000 for s in "ab"}
        assert share["a"] == pytest.approx(t * t, abs=0.02) and share["b"] == pytest.approx(t, abs=0.02)


def test_curriculum_edges(spark):
    assert mixed(spark, []).collect() == []
    got = mixed(spark, [(1, None, None, "z", 1, 2), (2, "", "a", "z", 1, 2)]).collect()
    assert [(r["size"], r["target"], r["taken"], r["passes"]) for r in got] == [(0, 0.0, 0, [])] * 2
    with pytest.raises(ValueError):
        mixed(spark, [], cap=3.0)


def test_curriculum_plan_is_native(spark):
    plan = QUERIES["op7_curriculum_mix"](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_curriculum_table_matches_sql(spark, oracle):
    same_rows(QUERIES["op7_curriculum_mix"](spark, SF_SMALL), *oracle(SF_SMALL, ORACLE["op7_curriculum_mix"]))


def test_license_blocks(spark):
    t = license_scan.TEMPLATES
    rows = [(1, "Some words here.\nReleased under the MIT License.\nMore words. And more."), (2, "x. " + t["GPL-3.0"].replace("version 3", "version 2") + " y."),
            (3, "Nothing to see."), (4, None), (5, ""), (None, t["CC-BY-NC-4.0"]), (6, t["MIT-text"].replace("free of charge", "at no cost").upper()),
            (7, "We lost our license plate in the public garden."), (8, "Copyright (c) 2019 Someone. All rights reserved."), (1, "Some words here.\nReleased under the MIT License.\nMore words. And more."),
            (9, "word " * 40000 + "\nLicensed under the Apache License, Version 2.0.\n" + "word " * 40000)]
    df = spark.createDataFrame([(i, x, "k", "l", 3) for i, x in rows], "id long, body string, key string, license string, block int")
    got = license_scan.scan(df, "id", "body").collect()
    found = sorted((str(r["key"]), r["license"]) for r in got)
    assert found == sorted([("1", "MIT"), ("1", "MIT"), ("2", "GPL-2.0"), ("None", "CC-BY-NC-4.0"), ("6", "MIT-text"), ("8", "Copyright"), ("9", "Apache-2.0")])
    by = {r["key"]: r for r in got}
    assert by[1]["n_differences"] == 0 and by[1]["reduction"] > 0.4 and rows[0][1][by[1]["begin"]:by[1]["begin"] + by[1]["length"]] == by[1]["block"]
    assert by[6]["differences"] == ["-free of charge +at no cost"]
    assert license_scan.scan(df.limit(0), "id", "body").collect() == []


def test_license_scan_finds_every_notice_line(spark):
    want = (spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
            .filter(F.col("line").rlike("(?i)licensed under|released under the MIT")).select("doc_id").distinct().collect())
    got = QUERIES["op3_license_scan"](spark, SF_SMALL).select("doc_id").distinct().collect()
    assert {r[0] for r in got} == {r[0] for r in want}
