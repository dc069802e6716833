"""Query catalogue: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables (through the readings adapter) in full;
outputs use integers, strings, epoch hours and doubles rounded to fixed
digits so they compare exactly with the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sqlfuncs
from ..functions.labels import vn_rgb
from ..functions.subindex import epa_pm25_continuous, sub_index
from ..operators import aqi as A
from ..operators import clean as C
from ..operators import daily as D
from ..operators import features as FE
from ..operators import profile as P
from ..operators import rolling as R
from ..operators import serving as S
from ..operators.positions import with_global_position
from ..sources.adapter import POLLUTANT_COLS, hourly_readings, hourly_weather, unmatched_events

HOURLY_OUT = ["province", "district", "region", "lat", "lon", "ep",
              "pm2_5", "pm10", "o3", "no2", "so2", "co", "nowcast_pm25", "nowcast_pm10",
              "aqi_o3", "aqi_co", "aqi_so2", "aqi_no2", "aqi_pm10", "aqi_pm25", "aqi_final",
              "aqi_category", "aqi_color", "health_advice"]
KEY = ["province", "district"]


def _r6(*cols):
    return [F.round(c, 6).alias(c) for c in cols]


def readings(spark, sf_dir) -> DataFrame:
    return hourly_readings(spark, sf_dir)


def readings_once(spark, sf_dir) -> DataFrame:
    """Readings written once to the shared checkpoint folder, for queries
    that read them more than once (the events are scanned a single time)."""
    from ..session import materialize
    return materialize(readings(spark, sf_dir), "readings")


def hourly(spark, sf_dir) -> DataFrame:
    return A.enrich(readings(spark, sf_dir))


def latest(spark, sf_dir) -> DataFrame:
    """Newest enriched row per station.  Its NowCast reaches 11 hours back, so the
    readings (with a PM value, as ``enrich`` keeps them) are first cut to each station's
    newest 12 rows: a group limit, and the window runs on at most 12 rows per station."""
    recent = S.last_n_per_station(A.with_pm_present(readings(spark, sf_dir)), 12)
    return S.latest_per_station(A.enrich(recent))


# --- hourly index -----------------------------------------------------------

def q_hourly_aqi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly(spark, sf_dir).select(*HOURLY_OUT)


def q_nowcast_pm25(spark, sf_dir):
    df = R.nowcast_12h(readings(spark, sf_dir), {"pm2_5": "nowcast_pm25"})
    return df.select(*KEY, "ep", "pm2_5", "nowcast_pm25",
                     sub_index("nowcast_pm25", "pm25", "vn_stream").alias("aqi_pm25"))


def q_nowcast_batch_variant(spark, sf_dir):
    df = R.nowcast_batch(readings(spark, sf_dir), {"pm2_5": "nc_pm25", "pm10": "nc_pm10"})
    return df.select(*KEY, "ep", *_r6("nc_pm25", "nc_pm10"))


def q_aqi_epa_stepped(spark, sf_dir):
    df = A.enrich_epa(readings(spark, sf_dir))
    return df.select(*KEY, "ep", *A.EPA_INPUTS.keys(), "aqi_final", "aqi_category")


def q_aqi_epa_pm25(spark, sf_dir):
    return readings(spark, sf_dir).select(*KEY, "ep", "pm2_5",
                                          F.round(epa_pm25_continuous("pm2_5"), 6).alias("aqi"))


def q_aqi_vn_batch(spark, sf_dir):
    """Hourly job of the vectorised batch: W5 NowCast for PM, raw gases,
    ``vn_batch`` rule, hourly AQI = rounded row maximum."""
    df = R.nowcast_batch(readings(spark, sf_dir), {"pm2_5": "nowcast_pm2_5", "pm10": "nowcast_pm10"})
    subs = {"aqi_pm10": ("nowcast_pm10", "pm10"), "aqi_pm2_5": ("nowcast_pm2_5", "pm25"),
            "aqi_carbon_monoxide": ("co", "co"), "aqi_nitrogen_dioxide": ("no2", "no2"),
            "aqi_sulphur_dioxide": ("so2", "so2"), "aqi_ozone": ("o3", "o3_1h")}
    df = df.select(*KEY, "ep", *[sub_index(s, t, "vn_batch").alias(o) for o, (s, t) in subs.items()])
    return df.withColumn("aqi_h", F.bround(F.greatest(*subs.keys()), 0).cast("int"))


def q_dominant_pollutant(spark, sf_dir):
    return A.with_dominant(hourly(spark, sf_dir)).select(*KEY, "ep", "aqi_final", "dominant")


def q_aqi_sql_functions(spark, sf_dir):
    """The rules as SQL functions, called from Spark SQL (no Python)."""
    sqlfuncs.register(spark)
    readings(spark, sf_dir).createOrReplaceTempView("airq_readings")
    return spark.sql("""
        SELECT province, district, ep,
               airq_vn_pm25(pm2_5) AS aqi_pm25, airq_vn_co(co) AS aqi_co,
               airq_epa_pm25_cont(pm2_5) AS epa_pm25,
               airq_vn_category(greatest(airq_vn_pm25(pm2_5), airq_vn_co(co))) AS category
        FROM airq_readings""")


def q_aqi_vn_sql_functions(spark, sf_dir):
    """All ten VN functions called from Spark SQL (the 8 h ozone one on the 8 h mean)."""
    sqlfuncs.register(spark)
    R.ozone_8h(readings(spark, sf_dir)).createOrReplaceTempView("airq_readings_8h")
    return spark.sql("""
        WITH s AS (SELECT province, district, ep, airq_vn_o3(o3) AS aqi_o3, airq_vn_o38h(o3_8h) AS aqi_o3_8h, airq_vn_co(co) AS aqi_co,
                          airq_vn_so2(so2) AS aqi_so2, airq_vn_no2(no2) AS aqi_no2, airq_vn_pm10(pm10) AS aqi_pm10, airq_vn_pm25(pm2_5) AS aqi_pm25
                   FROM airq_readings_8h),
             g AS (SELECT *, greatest(aqi_o3, aqi_o3_8h, aqi_co, aqi_so2, aqi_no2, aqi_pm10, aqi_pm25) AS aqi FROM s)
        SELECT *, airq_vn_category(aqi) AS category, airq_vn_color(aqi) AS color, airq_health_advice(aqi) AS advice FROM g""")


# --- rolling ----------------------------------------------------------------

AVG_COLS = ["avg_pm25_24h", "avg_pm10_24h", "avg_o3_1h", "avg_o3_8h", "avg_co_1h", "avg_so2_1h", "avg_no2_1h"]


def q_rolling_means(spark, sf_dir):
    return D.warehouse_averages(readings(spark, sf_dir)).select(*KEY, "ep", *_r6(*AVG_COLS))


def q_ozone_8h(spark, sf_dir):
    return R.ozone_8h(readings(spark, sf_dir)).select(*KEY, "ep", "o3", "o3_8h")


# --- daily ------------------------------------------------------------------

def q_daily_aqi(spark, sf_dir):
    return D.daily_aqi(readings(spark, sf_dir))


def q_daily_peak_hours(spark, sf_dir):
    """The hours at which each station reaches its daily PM2.5 maximum, ties kept."""
    df = readings(spark, sf_dir).filter(F.col("pm2_5").isNotNull()).withColumn("day", D.day_of())
    return D.daily_max_rows(df, "pm2_5").select(*KEY, "day", "ep", "pm2_5")


def q_daily_aqi_warehouse(spark, sf_dir):
    df = D.daily_aqi_warehouse(readings(spark, sf_dir))
    return df.select("day", *KEY, *_r6(*[o for _, _, o in D.WAREHOUSE_INPUTS], "AQI"))


def q_aqi_bracket_join(spark, sf_dir):
    df = D.bracket_join(spark, D.warehouse_averages(readings(spark, sf_dir)))
    return df.select(*KEY, "ep", "pollutant", *_r6("c", "aqi"))


def q_aqi_stats(spark, sf_dir):
    df = D.daily_aqi_warehouse(readings(spark, sf_dir))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.min("AQI"), 6).alias("min_aqi"),
                  F.round(F.max("AQI"), 6).alias("max_aqi"), F.round(F.avg("AQI"), 6).alias("avg_aqi"))


# --- serving ----------------------------------------------------------------

LATEST_OUT = ["province", "district", "region", "lat", "lon", "ep", "aqi_final", "aqi_category",
              "aqi_color", "health_advice", "pm2_5", "pm10", "o3", "no2", "so2", "co",
              "aqi_pm25", "aqi_pm10", "aqi_o3", "aqi_no2", "aqi_so2", "aqi_co"]


def q_latest_per_station(spark, sf_dir):
    return latest(spark, sf_dir).select(*LATEST_OUT)


def q_province_summary(spark, sf_dir):
    return S.province_summary(latest(spark, sf_dir))


def q_top_polluted(spark, sf_dir):
    return S.top_polluted(latest(spark, sf_dir)).select(
        "province", "district", "region", "aqi_final", "aqi_category", "aqi_color", "health_advice", "ep")


def q_top5_pm25(spark, sf_dir):
    """K2 ranks the raw snapshot: each station's newest reading, with or
    without PM values."""
    return S.top_pm25(S.latest_per_station(readings(spark, sf_dir))).select("province", "district", "pm2_5", "pm10")


def q_station_history(spark, sf_dir):
    """K4: the last 24 hours up to the newest reading.  Their NowCast reaches
    11 hours further back, so older readings are cut before the window (the
    clock is one scalar subquery)."""
    r = A.with_pm_present(readings_once(spark, sf_dir))
    as_of = r.agg(F.max("ep")).scalar()
    recent = r.filter(F.col("ep") >= as_of - F.lit(24 + 11))
    return S.station_history(A.enrich(recent), hours=24).select(
        *KEY, "ep", "aqi_final", "aqi_category", *POLLUTANT_COLS)


def q_station_list(spark, sf_dir):
    r = readings_once(spark, sf_dir)      # three region slices of one written table
    parts = [r.filter(F.col("region") == g) for g in ("north", "central", "south")]
    return S.station_list(S.union_all(parts))


def q_last24(spark, sf_dir):
    """Each station's last 24 rows; only those and the 11 hours before
    them feed the NowCast window."""
    recent = S.last_n_per_station(A.with_pm_present(readings(spark, sf_dir)), 24 + 11)
    return S.last_n_per_station(A.enrich(recent), 24).select(*KEY, "ep", "aqi_final")


def q_sorted_readings(spark, sf_dir):
    """K3: the readings in global order (station, hour), each with its place."""
    return with_global_position(readings_once(spark, sf_dir).select(*KEY, "ep", "pm2_5"), [*KEY, "ep"])


def q_global_split(spark, sf_dir):
    """W11, positional over all stations: the first 80 % of the rows in time order are for
    training, whatever their station."""
    r = with_global_position(readings_once(spark, sf_dir).select(*KEY, "ep", "pm2_5"), ["ep", *KEY], total="n")
    return r.withColumn("split", F.when(F.col("position") <= F.floor(F.col("n") * 0.8), "train").otherwise("test"))


# --- profiling --------------------------------------------------------------

def q_station_counts(spark, sf_dir):
    return P.station_counts(readings(spark, sf_dir))


def q_null_profile(spark, sf_dir):
    return P.null_profile(readings(spark, sf_dir))


def q_numeric_stats(spark, sf_dir):
    return P.numeric_stats(readings(spark, sf_dir))


def q_mean_imputed(spark, sf_dir):
    return P.mean_impute(readings_once(spark, sf_dir)).select(*KEY, "ep", *POLLUTANT_COLS)


def aligned_join(spark, sf_dir) -> DataFrame:
    from ..session import materialize
    wea = materialize(hourly_weather(spark, sf_dir), "weather")
    air, wea = C.align_time_range(readings_once(spark, sf_dir), wea)
    return FE.join_air_weather(air, wea)


def joined(spark, sf_dir) -> DataFrame:
    """J1 without the P10 cut (a no-op before an inner join on the hour)."""
    return FE.join_air_weather(readings(spark, sf_dir), hourly_weather(spark, sf_dir))


def q_air_weather_join(spark, sf_dir):
    return aligned_join(spark, sf_dir).select(
        *KEY, "ep", "pm2_5", "pm10", "temperature_2m", "relative_humidity_2m", "rain", "wind_speed_10m")


def q_single_station_join(spark, sf_dir):
    """J2 + P9 + P11: join on time within each district, duplicate names
    suffixed _x/_y, rows without both PMs dropped."""
    a = readings(spark, sf_dir).withColumnsRenamed({"region": "region_x", "event_time": "event_time_x"})
    w = hourly_weather(spark, sf_dir).withColumnsRenamed({"region": "region_y", "event_time": "event_time_y"})
    j = a.join(w, [*KEY, "ep"]).dropna(subset=["pm2_5", "pm10"])
    return j.select(*KEY, "ep", "region_x", "region_y", "pm2_5", "pm10", "temperature_2m")


DAYS = 10


def q_district_time_join(spark, sf_dir):
    """P9 + J2: air and weather cut to one district (the first by name) and to its
    last days, then joined on time alone; names both sides have get the suffixes
    _x and _y."""
    air = readings_once(spark, sf_dir)
    one = air.agg(F.min("district")).scalar()
    cut = lambda df: df.withColumn("one", one).filter(F.col("district") == F.col("one")).drop("one")
    air, wea = cut(air), cut(hourly_weather(spark, sf_dir))
    newest = air.agg(F.max("event_time")).scalar()
    first = F.col("newest") - F.expr(f"INTERVAL {DAYS} DAYS")
    air = C.time_between(air.withColumn("newest", newest), first, F.col("newest")).drop("newest")
    a = C.rename(air, {"event_time": "event_time", "region": "region_x", "ep": "ep_x", "pm2_5": "pm2_5", "pm10": "pm10"})
    w = C.rename(wea, {"event_time": "event_time", "region": "region_y", "ep": "ep_y", "temperature_2m": "temperature_2m", "rain": "rain"})
    return a.join(w, "event_time").select("region_x", "region_y", "ep_x", "ep_y", "pm2_5", "pm10", "temperature_2m", "rain")


def q_factor_corr(spark, sf_dir):
    return P.factor_corr(joined(spark, sf_dir))


def q_factor_bins(spark, sf_dir):
    return P.factor_bins(joined(spark, sf_dir))


def q_factor_quantiles(spark, sf_dir):
    return P.factor_quantiles(joined(spark, sf_dir))


# --- ingestion / shaping ----------------------------------------------------

def _messages(spark, sf_dir) -> DataFrame:
    r = readings(spark, sf_dir).withColumn("timestamp", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm"))
    cols = [f.name for f in C.MESSAGE_SCHEMA.fields]
    return C.encode_messages(r.select(*cols))


def q_json_parse(spark, sf_dir):
    """Encoded messages parsed back with the fixed schema."""
    parsed = C.parse_event_time(C.parse_json(_messages(spark, sf_dir)))
    return parsed.select(*KEY, "region", C.ntz_micros(F.col("event_time")).alias("event_us"),
                         *POLLUTANT_COLS)


def q_json_quarantine(spark, sf_dir):
    """Messages cut off in transit (every seventh hour here) go to
    quarantine with their text; none is lost without a count."""
    r = readings(spark, sf_dir).withColumn("timestamp", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm"))
    cols = [f.name for f in C.MESSAGE_SCHEMA.fields]
    text = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    msgs = r.select(F.when(F.col("ep") % 7 == 0, F.substring(text, 1, 40)).otherwise(text).cast("binary").alias("value"))
    good, bad = C.split_malformed(msgs)
    return (good.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("int").alias("longest"))
            .withColumn("kind", F.lit("parsed"))
            .unionByName(bad.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("raw")).alias("longest"))
                         .select(F.lit(None).cast("string").alias("region"), "n", "longest", F.lit("quarantine").alias("kind"))))


def q_aqi_epa_sql_functions(spark, sf_dir):
    """X2 + F11: the stepped EPA rules called from Spark SQL, and the RGB triple
    of the VN level."""
    sqlfuncs.register(spark)
    df = readings(spark, sf_dir)
    subs = {f"epa_{n}": F.expr(f"airq_epa_{f}({c})") for n, f, c in (
        ("pm25", "pm25", "pm2_5"), ("pm10", "pm10", "pm10"), ("o3", "o3", "o3"), ("no2", "no2", "no2"), ("so2", "so2", "so2"), ("co", "co", "co"))}
    df = df.withColumns(subs).withColumn("epa_aqi", F.greatest(*subs))
    return df.select(*KEY, "ep", *subs, F.expr("airq_epa_category(epa_aqi)").alias("epa_category"),
                     vn_rgb(sub_index("pm2_5", "pm25", "vn")).alias("rgb"))


def q_nan_readings(spark, sf_dir):
    """NaN counts as missing: readings whose PM and ozone turn NaN every fifth
    hour, through the NowCast, the batch NowCast, the ozone window and imputation."""
    from ..session import materialize
    nan = F.lit(float("nan"))
    r = readings(spark, sf_dir)
    r = materialize(r.withColumns({c: F.when(F.col("ep") % 5 == 0, nan).otherwise(F.col(c)) for c in ("pm2_5", "o3")}), "nan")
    df = R.ozone_8h(R.nowcast_batch(R.nowcast_12h(r, {"pm2_5": "nowcast"}), {"pm2_5": "nc_batch"}))
    filled = P.mean_impute(r).select(*KEY, "ep", F.col("pm2_5").alias("filled"))
    return df.join(filled, [*KEY, "ep"]).select(*KEY, "ep", "nowcast", *_r6("nc_batch"), "o3_8h", "filled")


def q_unmatched_events(spark, sf_dir):
    """Events whose sensor has no station: what the readings leave out."""
    return unmatched_events(spark, sf_dir)


def q_encode_messages(spark, sf_dir):
    m = _messages(spark, sf_dir)
    return m.select(F.col("key").cast("string").alias("key"),
                    F.octet_length("value").cast("int").alias("value_bytes"),
                    F.get_json_object(F.col("value").cast("string"), "$.pm2_5").try_cast("double").alias("pm2_5"))


def payloads(spark, sf_dir, r=None) -> DataFrame:
    """API-shaped payloads: one per station-day with parallel hourly arrays."""
    r = (r if r is not None else readings(spark, sf_dir)).withColumn("day", D.day_of())
    fields = {"pm2_5": "pm2_5", "pm10": "pm10", "ozone": "o3", "nitrogen_dioxide": "no2",
              "sulphur_dioxide": "so2", "carbon_monoxide": "co"}
    row = F.struct(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm").alias("time"),
                   *[F.col(src).alias(dst) for dst, src in fields.items()])
    g = r.groupBy("province", "district", "day").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    def field(name):
        return F.transform("rows", lambda x: x[name]).alias(name)
    hourly_struct = F.struct(*[field(f) for f in ["time", *fields]])
    units = F.create_map(*[x for f in fields for x in (F.lit(f), F.lit("μg/m³"))])
    return g.select(F.col("province").alias("city_name"), "district", "day",
                    units.alias("hourly_units"), hourly_struct.alias("hourly"))


def q_payload_explode(spark, sf_dir):
    e = C.explode_payload(payloads(spark, sf_dir))
    return e.select("city_name", "district", "time", *C.PAYLOAD_FIELDS,
                    F.col("hourly_units")["pm2_5"].alias("unit_pm2_5"))


def q_current_hour_pick(spark, sf_dir):
    r = readings_once(spark, sf_dir)
    p = payloads(spark, sf_dir, r)
    now = F.date_format(r.agg(F.max("event_time")).scalar(), "yyyy-MM-dd'T'HH:mm")
    return C.current_hour_pick(p, now, keep=("city_name", "district", "day"))


def q_split_periods(spark, sf_dir):
    span = readings(spark, sf_dir).groupBy(*KEY).agg(F.min("event_time").alias("start_ts"),
                                                    F.max("event_time").alias("end_ts"))
    return C.split_periods(span).select(*KEY, "piece", "begin_us", "finish_us")


# --- features / forecast ----------------------------------------------------

def features(spark, sf_dir) -> DataFrame:
    air = P.mean_impute(readings_once(spark, sf_dir))
    return FE.lag_features(FE.join_air_weather(air, hourly_weather(spark, sf_dir)))


def q_lag_features(spark, sf_dir):
    return features(spark, sf_dir).select(*KEY, "ep", *_r6(*FE.FEATURES, "aqi"))


def q_scaled_features(spark, sf_dir):
    from ..session import materialize
    feat = materialize(features(spark, sf_dir), "features")     # read by the stats and the rows
    df = FE.standardize(feat, [*FE.FEATURES, "aqi"], suffix="_z")
    return df.select(*KEY, "ep", *_r6(*[f"{c}_z" for c in [*FE.FEATURES, "aqi"]]))


def q_inverse_scaled(spark, sf_dir):
    """features standardised and turned back, and a forecast made in standardised
    units (the mean of the values one and 24 rows before) turned back to the target's."""
    from ..session import materialize
    feat = materialize(features(spark, sf_dir), "features")
    cols = [*FE.FEATURES, "aqi"]
    z = FE.standardize(feat, cols, suffix="_z").withColumn("forecast_z", (F.col("aqi_lag1_z") + F.col("aqi_lag24_z")) / 2)
    back = FE.inverse_standardize(z, feat, {f"{c}_z": c for c in cols})
    target = FE.inverse_standardize(z.select(*KEY, "ep", "forecast_z"), feat, {"forecast_z": "aqi"}).withColumnRenamed("aqi", "forecast")
    return back.join(target, [*KEY, "ep"]).select(*KEY, "ep", *_r6(*cols, "forecast"))


def split_features(spark, sf_dir) -> DataFrame:
    """The feature table with its chronological split, written once: fitting,
    evaluation and scoring all read it."""
    from ..session import materialize
    return materialize(FE.chronological_split(features(spark, sf_dir)), "features")


def q_forecast_eval(spark, sf_dir):
    """The models of the newest row and of the newest 24 rows against
    persistence and yesterday's value, MAE and MSE per horizon on held-out rows."""
    from ..operators import forecast as FC
    split = split_features(spark, sf_dir)
    return FC.evaluate({"": FC.fit(split), "_window": FC.fit(split, 24)}, split)


def q_sequence_windows(spark, sf_dir):
    df = FE.sequence_windows(FE.chronological_split(features(spark, sf_dir)))
    return df.select(*KEY, "split", "i", F.size("x").alias("x_len"), F.size("y").alias("y_len"),
                     F.round(F.col("x")[0]["pm10"], 6).alias("x0_pm10"),
                     F.round(F.aggregate("y", F.lit(0.0), lambda a, b: a + b), 4).alias("y_sum"),
                     F.round(F.element_at("y", -1), 6).alias("y_last"))


def q_naive_forecast_error(spark, sf_dir):
    return FE.persistence_errors(features(spark, sf_dir))


def q_future_spine(spark, sf_dir):
    return FE.future_spine(features(spark, sf_dir))


# --- streaming and sinks (write, then read the written files back) ----------

def _message_files(spark, sf_dir, copies: int = 1) -> str:
    """Replay the readings as JSON messages (the stream source's shape)."""
    from ..session import scratch_path
    path = scratch_path(spark, "messages")
    r = readings(spark, sf_dir).withColumn("timestamp", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm"))
    cols = [f.name for f in C.MESSAGE_SCHEMA.fields]
    msg = r.select(F.to_json(F.struct(*cols)).alias("value"))
    for i in range(copies):  # copies > 1 replays every message again (duplicates)
        msg.write.mode("append").text(path)
    return path


STREAM_OUT = [*KEY, "ep", *POLLUTANT_COLS, "nowcast_pm25", "nowcast_pm10", "aqi_o3", "aqi_co", "aqi_so2",
              "aqi_no2", "aqi_pm10", "aqi_pm25", "aqi_final", "aqi_category"]


def q_stream_enrich(spark, sf_dir):
    """File stream -> enrich -> one foreachBatch, two sinks."""
    from ..session import scratch_path
    from ..streaming import pipeline as SP
    src = _message_files(spark, sf_dir)
    out, serving, ckpt = (scratch_path(spark, n) for n in ("history", "serving", "ckpt"))
    q = SP.run_enrich(spark, src, out, serving, ckpt)
    q.awaitTermination()
    return spark.read.parquet(serving).select(*STREAM_OUT)


def q_stream_dedup(spark, sf_dir):
    """Every message delivered twice; the watermark dedup keeps one."""
    from ..session import scratch_path
    from ..streaming import pipeline as SP
    src = _message_files(spark, sf_dir, copies=2)
    out = dedup_replay(spark, src)
    return spark.read.parquet(out).select(*KEY, C.ntz_micros(F.col("event_time")).alias("event_us"),
                                          *POLLUTANT_COLS)


def _nothing_late(query):
    from ..streaming import pipeline as SP
    if late := SP.late_rows(query):
        raise RuntimeError(f"{late} messages of the replay were late")


def dedup_replay(spark, src: str, max_files: int = 1000) -> str:
    """Replay message files through ``dedup_stream``; the written folder."""
    from ..session import scratch_path
    from ..streaming import pipeline as SP
    out, ckpt = scratch_path(spark, "dedup"), scratch_path(spark, "ckpt")
    delay = SP.replay_delay(spark.read.schema(C.MESSAGE_SCHEMA).json(src))
    q = (SP.dedup_stream(SP.read_messages(spark, "files", path=src, max_files=max_files), delay).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    _nothing_late(q)
    return out


def nowcast_replay(spark, src: str, max_files: int = 1000) -> DataFrame:
    """Replay message files through the ring NowCast; the upserted table."""
    from ..session import scratch_path
    from ..streaming import pipeline as SP, stations as ST
    from ..streaming.upserts import UpsertTable
    table = UpsertTable(spark, scratch_path(spark, "nowcast"), [*KEY, "ep"])
    q = (ST.ring_stream(SP.read_messages(spark, "files", path=src, max_files=max_files)).writeStream.outputMode("update")
         .foreachBatch(ST.nowcast_sink(table)).option("checkpointLocation", scratch_path(spark, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return table.rows()


def daily_replay(spark, src: str, max_files: int = 1000) -> DataFrame:
    """Replay message files through the daily stream; the upserted table."""
    from ..session import scratch_path
    from ..streaming import pipeline as SP, stations as ST
    from ..streaming.upserts import UpsertTable
    table = UpsertTable(spark, scratch_path(spark, "days"), [*KEY, "day"])
    delay = SP.replay_delay(spark.read.schema(C.MESSAGE_SCHEMA).json(src))
    q = (ST.daily_stream(SP.read_messages(spark, "files", path=src, max_files=max_files), delay).writeStream.outputMode("update")
         .foreachBatch(ST.daily_sink(table)).option("checkpointLocation", scratch_path(spark, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    _nothing_late(q)
    return table.rows()


def q_stream_latest(spark, sf_dir):
    """Latest row per station kept as streaming state; each micro-batch upserts
    only the stations that changed, and the table's log is folded."""
    from ..session import scratch_path
    from ..streaming import pipeline as SP
    from ..streaming.upserts import UpsertTable
    src = _message_files(spark, sf_dir)
    table = UpsertTable(spark, scratch_path(spark, "latest"), KEY, fold_every=2)
    latest_q = SP.latest_stream(SP.enrich_stream(SP.read_messages(spark, "files", path=src, max_files=1)))
    q = (latest_q.writeStream.outputMode("update").foreachBatch(table.sink())
         .option("checkpointLocation", scratch_path(spark, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return table.rows().select(*KEY, "ep", "aqi_final", "aqi_category", "pm2_5")


def q_stream_nowcast(spark, sf_dir):
    """NowCast from a ring of 12 hours a station, every reading scored."""
    return nowcast_replay(spark, _message_files(spark, sf_dir)).select(*KEY, "ep", F.col("nowcast").alias("nowcast_pm25"))


def q_stream_daily(spark, sf_dir):
    """A5 as a stream: daily indices with the days without readings."""
    return daily_replay(spark, _message_files(spark, sf_dir)).drop("final")


def q_stream_quarantine(spark, sf_dir):
    """P1 in a stream: messages cut off in transit (every seventh hour) and messages without a
    readable time (every eleventh) go to quarantine, the others are enriched and written."""
    from ..session import scratch_path
    from ..streaming import pipeline as SP
    src, out, serving, bad, counts, ckpt = (scratch_path(spark, n) for n in ("messages", "history", "serving", "quarantine", "counts", "ckpt"))
    r = readings(spark, sf_dir).withColumn("timestamp", F.when(F.col("ep") % 11 == 0, "no time").otherwise(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm")))
    text = F.to_json(F.struct(*[f.name for f in C.MESSAGE_SCHEMA.fields]))
    r.select(F.when(F.col("ep") % 7 == 0, F.substring(text, 1, 40)).otherwise(text).alias("value")).write.text(src)
    history = SP.history_writer(out, serving)
    sink = SP.quarantining(lambda rows, batch_id: history(SP.enrich_parsed(rows), batch_id), bad, counts)
    q = (SP.read_raw(spark, "files", path=src, max_files=2).writeStream.foreachBatch(sink).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    total = spark.read.parquet(counts).agg(*[F.sum(c).alias(c) for c in ("n_messages", "n_parsed", "n_bad_json", "n_bad_time")])
    kept = spark.read.parquet(serving).groupBy("region").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("written"))
    gone = (spark.read.parquet(bad).groupBy(F.concat(F.lit("quarantine "), "reason").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("region", F.lit(None).cast("string")))
    counted = total.select(F.lit(None).cast("string").alias("region"), F.inline(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("n")) for c in total.columns])))
    return kept.unionByName(gone).unionByName(counted)


def q_stream_throughput(spark, sf_dir):
    """F21 in a stream: messages and bytes as the micro-batches report them, summed; the
    rates go to the listener."""
    from ..session import scratch_path
    from ..streaming import pipeline as SP
    src, out, ckpt = (scratch_path(spark, n) for n in ("messages", "copy", "ckpt"))
    _messages(spark, sf_dir).select(F.col("value").cast("string").alias("value")).write.text(src)
    stream = SP.observed(SP.read_raw(spark, "files", path=src, max_files=2))
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    seen = [p.observedMetrics["throughput"] for p in q.recentProgress if "throughput" in p.observedMetrics]
    return spark.createDataFrame([(sum(s["n_msgs"] for s in seen), sum(s["n_bytes"] for s in seen))], "n_msgs long, total_bytes long")


def q_partitioned_sink(spark, sf_dir):
    """Enriched rows written as region/year/month/day Parquet, read back."""
    from ..session import scratch_path
    from ..sources import files as FS
    path = scratch_path(spark, "history")
    FS.write_partitioned(hourly(spark, sf_dir), path)
    return FS.read_history(spark, path).select(*KEY, "region", "year", "month", "day", "ep", "aqi_final")


def q_csv_roundtrip(spark, sf_dir):
    """S15 + S3: readings written as CSV (one folder per station), read
    back with an explicit schema; the station comes from the folder names."""
    from pyspark.sql import types as T

    from ..session import scratch_path
    from ..sources import files as FS
    path = scratch_path(spark, "csv")
    r = readings(spark, sf_dir).withColumn("time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))
    r.select(*KEY, "time", *POLLUTANT_COLS).hint("rebalance", *KEY).write.partitionBy(*KEY).option("header", True).csv(path)
    schema = T.StructType([T.StructField("time", T.TimestampNTZType()),
                           *[T.StructField(c, T.DoubleType()) for c in POLLUTANT_COLS],
                           T.StructField("province", T.StringType()), T.StructField("district", T.StringType())])
    back = FS.read_csv(spark, path, schema)
    return back.select(*KEY, C.ntz_micros(F.col("time")).alias("event_us"), *POLLUTANT_COLS)


def q_preamble_csv(spark, sf_dir):
    """Readings written as per-station monthly CSV downloads (metadata
    preamble, header at line 3), read back line-parallel with the header
    index; the station comes from the folder names."""
    from pyspark.sql import types as T

    from ..session import scratch_path
    from ..sources import files as FS
    path = scratch_path(spark, "preamble")
    r = readings(spark, sf_dir).withColumns({
        "time": F.date_format("event_time", "yyyy-MM-dd'T'HH:mm"),
        "chunk": F.date_format("event_time", "yyyyMM")})
    FS.write_preamble_csv(r, path, KEY, "chunk", "time", POLLUTANT_COLS,
                          {"latitude": F.col("lat"), "longitude": F.col("lon"),
                           "timezone": F.lit("Asia/Bangkok")})
    schema = T.StructType([T.StructField("time", T.StringType()),
                           *[T.StructField(c, T.DoubleType()) for c in POLLUTANT_COLS]])
    back = FS.read_preamble_csv(spark, path, 3, schema)
    return back.select(*KEY, "time", *POLLUTANT_COLS)


def q_snapshot_json(spark, sf_dir):
    """Latest reading per station written as a JSON snapshot folder per
    snapshot minute (the snapshot clock = newest reading), read back."""
    from ..session import scratch_path
    from ..sources import files as FS
    path = scratch_path(spark, "snapshot")
    lat = S.latest_per_station(readings(spark, sf_dir)).withColumn("snapshot", F.col("event_time"))
    FS.write_snapshot(lat.select(*KEY, "region", "pm2_5", "pm10", "snapshot"), path)
    back = spark.read.json(path)
    return back.select(*KEY, "region", "pm2_5", "pm10", F.col("snapshot_minute").cast("string").alias("snapshot_minute"))


def _forecast(spark, sf_dir, window: int) -> DataFrame:
    from ..operators import forecast as FC
    from ..session import scratch_path
    split = split_features(spark, sf_dir)
    path = scratch_path(spark, "model")
    FC.save(spark, FC.fit(split, window), path)
    return FC.score_next_24h(FC.load(spark, path), split)


def q_forecast_24h(spark, sf_dir):
    """M2-M5: 15 slopes a horizon fitted on the train split, saved, reloaded, and
    the next 24 hours of every station scored from its newest row."""
    return _forecast(spark, sf_dir, 1)


def q_forecast_windows_24h(spark, sf_dir):
    """M4: the same from each station's newest 24 rows, 360 inputs a horizon."""
    return _forecast(spark, sf_dir, 24)


def q_scaling_stats(spark, sf_dir):
    """M5: the scaling statistics of a saved model, read back as a table."""
    from ..operators import forecast as FC
    from ..session import scratch_path
    path = scratch_path(spark, "model")
    FC.save(spark, FC.fit(split_features(spark, sf_dir)), path)
    return spark.read.parquet(f"{path}/scaling").select("i", "feature", *_r6("mean", "std"))


def q_throughput_metrics(spark, sf_dir):
    """message count and payload bytes of the encoded stream."""
    m = _messages(spark, sf_dir)
    return m.agg(F.count(F.lit(1)).alias("n_msgs"), F.sum(F.octet_length("value")).alias("total_bytes"))


CATALOG = {
    "hourly_aqi": q_hourly_aqi,
    "nowcast_pm25": q_nowcast_pm25,
    "nowcast_batch_variant": q_nowcast_batch_variant,
    "aqi_epa_stepped": q_aqi_epa_stepped,
    "aqi_epa_pm25": q_aqi_epa_pm25,
    "aqi_vn_batch": q_aqi_vn_batch,
    "dominant_pollutant": q_dominant_pollutant,
    "aqi_sql_functions": q_aqi_sql_functions,
    "aqi_epa_sql_functions": q_aqi_epa_sql_functions,
    "aqi_vn_sql_functions": q_aqi_vn_sql_functions,
    "rolling_means": q_rolling_means,
    "ozone_8h": q_ozone_8h,
    "daily_aqi": q_daily_aqi,
    "daily_aqi_warehouse": q_daily_aqi_warehouse,
    "daily_peak_hours": q_daily_peak_hours,
    "aqi_bracket_join": q_aqi_bracket_join,
    "aqi_stats": q_aqi_stats,
    "latest_per_station": q_latest_per_station,
    "province_summary": q_province_summary,
    "top_polluted": q_top_polluted,
    "top5_pm25": q_top5_pm25,
    "station_history": q_station_history,
    "station_list": q_station_list,
    "last24": q_last24,
    "sorted_readings": q_sorted_readings,
    "global_split": q_global_split,
    "station_counts": q_station_counts,
    "null_profile": q_null_profile,
    "numeric_stats": q_numeric_stats,
    "mean_imputed": q_mean_imputed,
    "air_weather_join": q_air_weather_join,
    "single_station_join": q_single_station_join,
    "district_time_join": q_district_time_join,
    "factor_corr": q_factor_corr,
    "factor_bins": q_factor_bins,
    "factor_quantiles": q_factor_quantiles,
    "json_parse": q_json_parse,
    "json_quarantine": q_json_quarantine,
    "nan_readings": q_nan_readings,
    "unmatched_events": q_unmatched_events,
    "inverse_scaled": q_inverse_scaled,
    "forecast_eval": q_forecast_eval,
    "encode_messages": q_encode_messages,
    "payload_explode": q_payload_explode,
    "current_hour_pick": q_current_hour_pick,
    "split_periods": q_split_periods,
    "lag_features": q_lag_features,
    "scaled_features": q_scaled_features,
    "sequence_windows": q_sequence_windows,
    "naive_forecast_error": q_naive_forecast_error,
    "future_spine": q_future_spine,
    "stream_enrich": q_stream_enrich,
    "stream_dedup": q_stream_dedup,
    "stream_latest": q_stream_latest,
    "stream_nowcast": q_stream_nowcast,
    "stream_daily": q_stream_daily,
    "stream_quarantine": q_stream_quarantine,
    "stream_throughput": q_stream_throughput,
    "partitioned_sink": q_partitioned_sink,
    "csv_roundtrip": q_csv_roundtrip,
    "preamble_csv": q_preamble_csv,
    "snapshot_json": q_snapshot_json,
    "forecast_24h": q_forecast_24h,
    "forecast_windows_24h": q_forecast_windows_24h,
    "scaling_stats": q_scaling_stats,
    "throughput_metrics": q_throughput_metrics,
}
