"""Sources, sinks and cleaning helpers (write-then-read in temporary folders)."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from airq.operators import clean as C
from airq.sources import files as FS

AIR_SCHEMA = T.StructType([
    T.StructField("district", T.StringType()), T.StructField("city", T.StringType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("pm2_5 (μg/m³)", T.DoubleType()), T.StructField("uv_index ()", T.DoubleType()),
])


def test_normalize_names():
    assert C.normalize_name("pm2_5 (μg/m³)") == "pm2_5"
    assert C.normalize_name(" Relative Humidity 2m (%) ") == "relative_humidity_2m"
    assert C.normalize_name("uv_index ()") == "uv_index"


def test_csv_roundtrip_typed_and_untyped(spark, tmpdir_path):
    df = spark.createDataFrame([("Ba Dinh", "Ha Noi", None, 12.5, 1.0), ("X", "Y", None, None, 2.0)], AIR_SCHEMA)
    path = os.path.join(tmpdir_path, "air")
    FS.write_csv(df, path)
    back = FS.read_csv(spark, path, AIR_SCHEMA)
    assert back.count() == 2 and back.filter(F.col("`pm2_5 (μg/m³)`") == 12.5).count() == 1
    raw = FS.read_csv(spark, path)                      # S4: all text
    assert dict(raw.dtypes)["pm2_5 (μg/m³)"] == "string"
    t = FS.typed(raw, {"pm2_5 (μg/m³)": "double"})
    assert t.agg(F.avg("`pm2_5 (μg/m³)`")).first()[0] == 12.5
    norm = C.normalize_columns(back)
    assert "pm2_5" in norm.columns and "uv_index" in norm.columns


def test_untyped_bad_cell_does_not_fail(spark):
    df = spark.createDataFrame([("1.5",), ("oops",)], "v string")
    assert FS.typed(df, {"v": "double"}).agg(F.avg("v")).first()[0] == 1.5


def test_station_files_and_preamble(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "stations")
    os.makedirs(d)
    for district, city, v in [("Ba Dinh", "Ha Noi", 1.0), ("Chau Thanh", "Ben Tre", 2.0)]:
        with open(os.path.join(d, f"{district}_{city}.csv"), "w") as f:
            f.write("latitude,longitude\n21.0,105.8\n\ntime,pm10\n2024-01-01T00:00,%s\n2024-01-01T01:00,%s\n"
                    % (v, v + 1))
    schema = T.StructType([T.StructField("time", T.StringType()), T.StructField("pm10", T.DoubleType())])
    pre = FS.read_preamble_csv(spark, d, 3, schema)
    assert sorted(r.pm10 for r in pre.collect()) == [1.0, 2.0, 2.0, 3.0]
    # S7 on files without preamble
    d2 = os.path.join(tmpdir_path, "plain")
    os.makedirs(d2)
    with open(os.path.join(d2, "Ba Dinh_Ha Noi.csv"), "w") as f:
        f.write("time,pm10\n2024-01-01T00:00,5\n")
    got = FS.read_station_files(spark, d2).first()
    assert (got.district, got.city) == ("Ba Dinh", "Ha Noi")


def test_preamble_files_in_many_splits(spark, tmpdir_path):
    """Files cut into splits, several splits in a task: each file loses its own first lines, in one scan."""
    import re

    d = os.path.join(tmpdir_path, "long")
    os.makedirs(d)
    want = []
    for k in range(3):
        rows = [(f"t{i}", float(1000 * k + i)) for i in range(400 if k else 2)]
        want += rows
        with open(os.path.join(d, f"s{k}.csv"), "w") as f:
            f.write("latitude,longitude\n21.0,105.8\n\ntime,pm10\n" + "".join(f"{t},{v}\n" for t, v in rows))
    schema = T.StructType([T.StructField("time", T.StringType()), T.StructField("pm10", T.DoubleType())])
    for size, cost in (("600", "0"), ("2000", "100"), ("128m", "4m")):
        old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
        try:
            df = FS.read_preamble_csv(spark, d, 3, schema)
            assert sorted(map(tuple, df.collect())) == sorted(want)
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert len(re.findall("FileScan text", plan)) == 1 and "monotonically" not in plan
        finally:
            for c, v in old.items():
                spark.conf.set(c, v)


def test_sampled_schema_and_parse(spark):
    # A NULL field in the sample infers as STRING, an integral as BIGINT
    sample = json.dumps({"district": "A", "pm2_5": None, "k": 3})
    ddl = spark.range(1).select(F.schema_of_json(F.lit(sample))).first()[0]
    assert "pm2_5: STRING" in ddl and "k: BIGINT" in ddl
    msgs = spark.createDataFrame([('{"province":"P","district":"D","timestamp":"2024-01-01T05:00","pm2_5":NaN}',),
                                  ('not json',), ('{"province":"P","district":"D","timestamp":"bad"}',)],
                                 "value string")
    parsed = C.parse_json(msgs, keep_raw=True)
    assert parsed.count() == 3
    ok = C.parse_event_time(parsed)                     # P6: bad text dropped, no failure
    assert ok.count() == 1
    # Isnan lets NULL pass; is_missing catches both
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "v double")
    assert C.not_nan(df, ["v"]).count() == 2
    assert df.filter(~C.is_missing("v")).count() == 1


def test_partitioned_sink_prunes(spark, tmpdir_path):
    df = spark.createDataFrame([("north", "P", "D", 1, "2024-01-02 03:00:00"), ("south", "P", "E", 2, "2025-02-03 04:00:00")],
                               "region string, province string, district string, aqi_final int, t string")
    df = df.withColumn("event_time", F.col("t").cast("timestamp_ntz")).drop("t")
    path = os.path.join(tmpdir_path, "hist")
    FS.write_partitioned(df, path)
    assert os.path.isdir(os.path.join(path, "region=north", "year=2024", "month=1", "day=2"))
    back = FS.read_history(spark, path, start="2025-01-01 00:00:00")
    assert [r.district for r in back.collect()] == ["E"]
    assert "PartitionFilters: [isnotnull(year" in back._jdf.queryExecution().executedPlan().toString()


def test_snapshot_json(spark, tmpdir_path):
    df = spark.createDataFrame([("P", "Hà Nội", 1.0)], "province string, district string, pm2_5 double")
    df = df.withColumn("snapshot", F.lit("2024-01-01 10:15:00").cast("timestamp_ntz"))
    path = os.path.join(tmpdir_path, "snap")
    FS.write_snapshot(df, path)
    assert os.path.isdir(os.path.join(path, "snapshot_minute=20240101_1015"))
    assert spark.read.json(path).first().district == "Hà Nội"


def test_message_encoding(spark):
    df = spark.createDataFrame([("Ha Noi", "Ba Dinh", None)], "province string, district string, pm2_5 double")
    m = C.encode_messages(df).first()
    assert bytes(m.key) == b"Ha Noi_Ba Dinh"
    assert json.loads(bytes(m.value).decode()) == {"province": "Ha Noi", "district": "Ba Dinh", "pm2_5": None}


def test_split_periods_matches_timedelta(spark):
    import datetime as dt
    df = spark.createDataFrame([("2023-03-01 00:00:00", "2024-02-01 07:00:00")], "a string, b string")
    df = df.select(F.col("a").cast("timestamp_ntz").alias("start_ts"), F.col("b").cast("timestamp_ntz").alias("end_ts"))
    got = C.split_periods(df).orderBy("piece").collect()
    s, e = dt.datetime(2023, 3, 1), dt.datetime(2024, 2, 1, 7)
    n = 48 * 2
    delta = (e - s) / n
    epoch = dt.datetime(1970, 1, 1)
    assert len(got) == n
    for i in (0, 1, n - 1):
        b = s + i * delta
        assert got[i].begin_us == (b - epoch) // dt.timedelta(microseconds=1)
        assert got[i].finish_us == (b + delta - epoch) // dt.timedelta(microseconds=1)


def test_location_loader(spark, tmpdir_path):
    from airq.sources import locations as L
    n = os.path.join(tmpdir_path, "north.csv")
    c = os.path.join(tmpdir_path, "central.csv")
    with open(n, "w") as f:
        f.write("district,city,lat,lon\n Ba Dinh , Ha Noi ,21.03,105.81\nChau Thanh,Tien Giang,10.4,106.3\n")
    with open(c, "w") as f:
        f.write("district,city,lat,lon\nMuong Lat,Thanh Hoa,20.5,104.6\nMuong Lat,Thanh Hoa,20.4,104.5\n"
                "Chau Thanh,Ben Tre,10.2,106.4\nX,Y,bad,1\n")
    locs = L.load_locations(spark, {"north": n, "central": c})
    assert locs.count() == 6
    assert locs.filter("district = 'Ba Dinh' AND province = 'Ha Noi'").count() == 1   # trimmed
    assert locs.filter("district = 'X'").first().lat is None                         # bad value -> NULL
    kept, dropped = L.resolve_duplicates(locs)
    assert kept.count() == 5 and dropped.count() == 1
    assert kept.filter("district = 'Muong Lat'").first().lat == 20.4                  # deterministic pick
    assert kept.filter("district = 'Chau Thanh'").count() == 2                        # two provinces kept
    counts = {r.region: r.n_stations for r in L.count_by_region(kept).collect()}
    assert counts == {"north": 2, "central": 3, "total": 5}


def test_date_layout(spark, tmpdir_path):
    df = spark.createDataFrame([("north", 1, "2024-01-02 03:00:00")], "region string, a int, t string")
    df = df.withColumn("event_time", F.col("t").cast("timestamp_ntz")).drop("t")
    path = os.path.join(tmpdir_path, "bydate")
    FS.write_partitioned(df, path, layout="date")
    assert os.path.isdir(os.path.join(path, "region=north", "date=2024-01-02"))


def test_infer_schema_merges_samples(spark):
    msgs = spark.createDataFrame([('{"d":"A","pm2_5":null,"k":1}',), ('{"d":"B","pm2_5":12.5,"k":2}',)],
                                 "value string")
    sch = C.infer_schema(msgs)
    types = {f.name: f.dataType.simpleString() for f in sch.fields}
    assert types == {"d": "string", "k": "bigint", "pm2_5": "double"}
