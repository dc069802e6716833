"""DuckDB oracle SQL for each catalogue query (same output names/types)."""

from __future__ import annotations

from .oracle_base import (READINGS_CTES, VN_TABLE, WEATHER_CTES, half_up_rounding, health_advice_sql, nowcast_list_sql,
                          nowcast_sql, seq_window, si, vn_category_sql, vn_color_sql, vn_rgb_sql)
from .oracle_forecast import evaluation_sql, scaling_sql, scoring_sql

HOURLY_CTES = f"""
{READINGS_CTES.strip()},
pmr AS (SELECT * FROM readings WHERE pm2_5 IS NOT NULL OR pm10 IS NOT NULL),
lists AS (
  SELECT *, {nowcast_list_sql('pm2_5')} AS __l_pm2_5, {nowcast_list_sql('pm10')} AS __l_pm10 FROM pmr
),
nc AS (
  SELECT * EXCLUDE (__l_pm2_5, __l_pm10),
         {nowcast_sql('pm2_5')} AS nowcast_pm25, {nowcast_sql('pm10')} AS nowcast_pm10
  FROM lists
),
subs AS (
  SELECT *, {si('o3', 'o3_1h')} AS aqi_o3, {si('co', 'co')} AS aqi_co, {si('so2', 'so2')} AS aqi_so2,
         {si('no2', 'no2')} AS aqi_no2, {si('nowcast_pm10', 'pm10')} AS aqi_pm10,
         {si('nowcast_pm25', 'pm25')} AS aqi_pm25
  FROM nc
),
hourly AS (
  SELECT *, greatest(aqi_o3, aqi_co, aqi_so2, aqi_no2, aqi_pm10, aqi_pm25) AS aqi_final FROM subs
),
enriched AS (
  SELECT *, {vn_category_sql('aqi_final')} AS aqi_category, {vn_color_sql('aqi_final')} AS aqi_color,
         {health_advice_sql('aqi_final')} AS health_advice
  FROM hourly
)"""

HOURLY_COLS = ("province, district, region, lat, lon, ep, pm2_5, pm10, o3, no2, so2, co, "
               "nowcast_pm25, nowcast_pm10, aqi_o3, aqi_co, aqi_so2, aqi_no2, aqi_pm10, aqi_pm25, "
               "aqi_final, aqi_category, aqi_color, health_advice")

ORACLE = {
    "hourly_aqi": f"WITH {HOURLY_CTES} SELECT {HOURLY_COLS} FROM enriched",
}


KEYS = "province, district"

# W5 NowCast (row-positional, oldest-first weights), value list per row
def _nc_batch(src: str, out: str) -> str:
    lst = (f"list_transform(list_sort(list_filter(list(CASE WHEN {src} IS NOT NULL THEN "
           f"{{'e': ep, 'v': {src}::DOUBLE}} END) OVER (PARTITION BY {KEYS} ORDER BY ep "
           f"ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), lambda x: x IS NOT NULL)), lambda p: p.v)")
    return f"{lst} AS __v_{out}"


def _nc_batch_value(out: str) -> str:
    v = f"__v_{out}"
    cmax, cmin = f"list_max({v})", f"list_min({v})"
    w = f"greatest(CASE WHEN {cmax} <> 0 THEN {cmin} / {cmax} END, 0.5)"
    half = f"list_reduce(list_transform({v}, lambda x, j: x * pow(0.5, j::DOUBLE)), lambda a, b: a + b, 0.0::DOUBLE)"
    num = f"list_reduce(list_transform({v}, lambda x, j: x * pow({w}, (j - 1)::DOUBLE)), lambda a, b: a + b, 0.0::DOUBLE)"
    den = f"list_reduce(list_transform({v}, lambda x, j: pow({w}, (j - 1)::DOUBLE)), lambda a, b: a + b, 0.0::DOUBLE)"
    return (f"CASE WHEN __rn = 1 OR len({v}) = 0 THEN NULL WHEN len({v}) = 1 THEN {v}[1] "
            f"WHEN {cmax} = 0 THEN 0.0::DOUBLE WHEN {w} = 0.5 THEN {half} ELSE {num} / {den} END")


NCB_CTE = f"""
ncb_l AS (
  SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY ep) AS __rn,
         {_nc_batch('pm2_5', 'pm25')}, {_nc_batch('pm10', 'pm10')}
  FROM readings
),
ncb AS (
  SELECT *, {_nc_batch_value('pm25')} AS nc_pm25, {_nc_batch_value('pm10')} AS nc_pm10 FROM ncb_l
)"""

EPA = {"aqi_pm25": ("pm2_5", "pm25"), "aqi_pm10": ("pm10", "pm10"), "aqi_o3": ("o3", "o3_1h"),
       "aqi_no2": ("no2", "no2"), "aqi_so2": ("so2", "so2"), "aqi_co": ("co", "co")}
_epa_cols = ", ".join(f"{si(s, t, 'epa_stepped')} AS {o}" for o, (s, t) in EPA.items())

VNB = {"aqi_pm10": ("nc_pm10", "pm10"), "aqi_pm2_5": ("nc_pm25", "pm25"),
       "aqi_carbon_monoxide": ("co", "co"), "aqi_nitrogen_dioxide": ("no2", "no2"),
       "aqi_sulphur_dioxide": ("so2", "so2"), "aqi_ozone": ("o3", "o3_1h")}
_vnb_cols = ", ".join(f"{si(s, t, 'vn_batch')} AS {o}" for o, (s, t) in VNB.items())

def _frame(n):
    return f"PARTITION BY {KEYS} ORDER BY ep ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"


AVG_CTE = f"""
avgs AS (
  SELECT *,
    {seq_window('avg', 'pm2_5', _frame(24))} AS avg_pm25_24h,
    {seq_window('avg', 'pm10', _frame(24))} AS avg_pm10_24h,
    o3 AS avg_o3_1h,
    {seq_window('avg', 'o3', _frame(8))} AS avg_o3_8h,
    co AS avg_co_1h, so2 AS avg_so2_1h, no2 AS avg_no2_1h
  FROM readings
)"""

WH = [("avg_pm25_24h", "pm25", "aqi_pm25_24h"), ("avg_pm10_24h", "pm10", "aqi_pm10_24h"),
      ("avg_co_1h", "co", "aqi_co_1h"), ("avg_so2_1h", "so2", "aqi_so2_1h"),
      ("avg_no2_1h", "no2", "aqi_no2_1h"), ("avg_o3_1h", "o3_1h", "aqi_o3_1h"),
      ("avg_o3_8h", "o3_8h", "aqi_o3_8h")]


def _top(t):
    return VN_TABLE[t][-1][1]


DAY = "strftime(event_time, '%Y-%m-%d')"
WH_CTE = f"""
{AVG_CTE.strip()},
whd AS (
  SELECT {DAY} AS day, {KEYS},
         {", ".join(f"max(CASE WHEN {s} >= 0 AND {s} < {_top(t)} THEN {s} END) AS max_{s}" for s, t, _ in WH)}
  FROM avgs GROUP BY ALL
),
whs AS (
  SELECT day, {KEYS}, {", ".join(f"{si('max_' + s, t, 'vn_warehouse')} AS {o}" for s, t, o in WH)}
  FROM whd
),
wh AS (
  SELECT *, greatest({", ".join(o for _, _, o in WH)}) AS "AQI" FROM whs
  WHERE {" AND ".join(f"{o} IS NOT NULL" for _, _, o in WH)}
)"""

O3_8H = f"""CASE WHEN row_number() OVER (PARTITION BY {KEYS} ORDER BY ep) > 1 THEN
  round_even(coalesce({seq_window('sum', 'o3', f"PARTITION BY {KEYS} ORDER BY ep ROWS BETWEEN 7 PRECEDING AND CURRENT ROW")}, 0.0) / 8.0, 0) END"""

DAILY_SQL = f"""WITH {READINGS_CTES.strip()},
r8 AS (SELECT *, {O3_8H} AS o3_8h FROM readings),
daily AS (
  SELECT {KEYS}, {DAY} AS day, avg(pm2_5) AS pm25_24h, avg(pm10) AS pm10_24h,
         max(so2) AS so2_1h_max, max(no2) AS no2_1h_max, max(co) AS co_1h_max, max(o3) AS o3_1h_max,
         max(o3_8h) AS o3_8h_max
  FROM r8 GROUP BY ALL
),
span AS (SELECT {KEYS}, min(day::DATE) AS d0, max(day::DATE) AS d1 FROM daily GROUP BY ALL),
spine AS (
  SELECT {KEYS}, strftime(unnest(generate_series(d0, d1, INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM span
),
full_ AS (SELECT s.province, s.district, s.day, d.* EXCLUDE (province, district, day)
          FROM spine s LEFT JOIN daily d USING (province, district, day)),
subs AS (
  SELECT {KEYS}, day,
    {si('pm25_24h', 'pm25', 'vn_batch')} AS aqi_pm2_5,
    {si('pm10_24h', 'pm10', 'vn_batch')} AS aqi_pm10,
    {si('so2_1h_max', 'so2', 'vn_batch')} AS aqi_sulphur_dioxide,
    {si('no2_1h_max', 'no2', 'vn_batch')} AS aqi_nitrogen_dioxide,
    {si('co_1h_max', 'co', 'vn_batch')} AS aqi_carbon_monoxide,
    greatest({si('o3_1h_max', 'o3_1h', 'vn_batch')},
             CASE WHEN o3_8h_max > 400 THEN NULL ELSE {si('o3_8h_max', 'o3_8h', 'vn_batch')} END) AS aqi_ozone
  FROM full_
)
SELECT *, CASE WHEN aqi_pm2_5 IS NOT NULL OR aqi_pm10 IS NOT NULL THEN
  CAST(round_even(greatest(aqi_pm2_5, aqi_pm10, aqi_sulphur_dioxide, aqi_nitrogen_dioxide,
                           aqi_carbon_monoxide, aqi_ozone), 0) AS INT) END AS aqi_daily
FROM subs"""

_BP_ROWS = []
for _s, _t, _o in WH:
    for _row in VN_TABLE[_t]:
        _BP_ROWS.append("('" + _t + "', " + ", ".join(f"{float(x)}::DOUBLE" for x in _row) + ")")
BP_VALUES = ", ".join(_BP_ROWS)

LATEST_CTE = f"""
latest AS (
  SELECT * EXCLUDE (__rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY ep DESC) AS __rn FROM enriched)
  WHERE __rn = 1
)"""

LATEST_COLS = ("province, district, region, lat, lon, ep, aqi_final, aqi_category, aqi_color, health_advice, "
               "pm2_5, pm10, o3, no2, so2, co, aqi_pm25, aqi_pm10, aqi_o3, aqi_no2, aqi_so2, aqi_co")
POLS = ["pm2_5", "pm10", "o3", "no2", "so2", "co"]

ALIGN_CTES = f"""
{WEATHER_CTES.strip()},
bounds AS (
  SELECT greatest((SELECT min(ep) FROM readings), (SELECT min(ep) FROM weather)) AS lo,
         least((SELECT max(ep) FROM readings), (SELECT max(ep) FROM weather)) AS hi
),
aw AS (
  SELECT a.*, w.temperature_2m, w.relative_humidity_2m, w.rain, w.wind_speed_10m, w.wind_speed_100m,
         w.wind_direction_10m
  FROM readings a JOIN weather w USING (province, district, ep)
  WHERE a.ep BETWEEN (SELECT lo FROM bounds) AND (SELECT hi FROM bounds)
)"""

FACTORS = ["temperature_2m", "relative_humidity_2m", "rain", "wind_speed_10m", "wind_speed_100m",
           "wind_direction_10m"]

IMPUTE_CTE = f"""
rmeans AS (SELECT region, {", ".join(f"round(avg({c}::DECIMAL(24,6)), 6) AS m_{c}" for c in POLS)} FROM readings GROUP BY region),
imputed AS (
  SELECT r.* REPLACE ({", ".join(f"coalesce(r.{c}, m.m_{c}) AS {c}" for c in POLS)})
  FROM readings r LEFT JOIN rmeans m USING (region)
)"""

FEATS = ["pm10", "co", "no2", "so2", "o3", "temperature_2m", "relative_humidity_2m", "wind_speed_10m", "rain",
         "aqi_lag1", "aqi_lag3", "aqi_lag6", "aqi_lag24", "hour", "dayofweek"]

FEATURE_CTES = f"""
{IMPUTE_CTE.strip()},
{WEATHER_CTES.strip()},
fj AS (
  SELECT a.*, w.temperature_2m, w.relative_humidity_2m, w.rain, w.wind_speed_10m,
         {si('a.pm2_5', 'pm25', 'epa_pm25')} AS aqi
  FROM imputed a JOIN weather w USING (province, district, ep)
),
fl AS (
  SELECT *, {", ".join(f"lag(aqi, {k}) OVER (PARTITION BY {KEYS} ORDER BY ep) AS aqi_lag{k}" for k in (1, 3, 6, 24))},
         hour(event_time) AS hour, isodow(event_time) - 1 AS dayofweek
  FROM fj
),
feat AS (SELECT * FROM fl WHERE {" AND ".join(f"{c} IS NOT NULL" for c in FEATS + ["aqi"])})"""

ORACLE.update({
    "nowcast_pm25": f"""WITH {READINGS_CTES.strip()},
      l AS (SELECT *, {nowcast_list_sql('pm2_5')} AS __l_pm2_5 FROM readings),
      n AS (SELECT *, {nowcast_sql('pm2_5')} AS nowcast_pm25 FROM l)
      SELECT {KEYS}, ep, pm2_5, nowcast_pm25, {si('nowcast_pm25', 'pm25')} AS aqi_pm25 FROM n""",
    "nowcast_batch_variant": f"""WITH {READINGS_CTES.strip()}, {NCB_CTE.strip()}
      SELECT {KEYS}, ep, round(nc_pm25, 6) AS nc_pm25, round(nc_pm10, 6) AS nc_pm10 FROM ncb""",
    "aqi_epa_stepped": f"""WITH {READINGS_CTES.strip()},
      e AS (SELECT {KEYS}, ep, {_epa_cols} FROM readings),
      f AS (SELECT *, greatest({", ".join(EPA)}) AS aqi_final FROM e)
      SELECT *, CASE WHEN aqi_final IS NULL OR aqi_final <= 0 THEN 'Unknown' WHEN aqi_final <= 50 THEN 'Good'
        WHEN aqi_final <= 100 THEN 'Moderate' WHEN aqi_final <= 150 THEN 'Unhealthy for Sensitive Groups'
        WHEN aqi_final <= 200 THEN 'Unhealthy' WHEN aqi_final <= 300 THEN 'Very Unhealthy'
        ELSE 'Hazardous' END AS aqi_category FROM f""",
    "aqi_epa_pm25": f"""WITH {READINGS_CTES.strip()}
      SELECT {KEYS}, ep, pm2_5, round({si('pm2_5', 'pm25', 'epa_pm25')}, 6) AS aqi FROM readings""",
    "aqi_vn_batch": f"""WITH {READINGS_CTES.strip()}, {NCB_CTE.strip()},
      s AS (SELECT {KEYS}, ep, {_vnb_cols} FROM ncb)
      SELECT *, CAST(round_even(greatest({", ".join(VNB)}), 0) AS INT) AS aqi_h FROM s""",
    "dominant_pollutant": f"""WITH {HOURLY_CTES}
      SELECT {KEYS}, ep, aqi_final,
        CASE WHEN aqi_final IS NULL THEN NULL WHEN aqi_pm25 = aqi_final THEN 'pm25'
             WHEN aqi_pm10 = aqi_final THEN 'pm10' WHEN aqi_o3 = aqi_final THEN 'o3'
             WHEN aqi_no2 = aqi_final THEN 'no2' WHEN aqi_so2 = aqi_final THEN 'so2' ELSE 'co' END AS dominant
      FROM enriched""",
    "aqi_sql_functions": f"""WITH {READINGS_CTES.strip()},
      s AS (SELECT {KEYS}, ep, {si('pm2_5', 'pm25')} AS aqi_pm25, {si('co', 'co')} AS aqi_co,
                   {si('pm2_5', 'pm25', 'epa_pm25')} AS epa_pm25 FROM readings)
      SELECT *, {vn_category_sql('greatest(aqi_pm25, aqi_co)')} AS category FROM s""",
    "aqi_vn_sql_functions": f"""WITH {READINGS_CTES.strip()},
      o AS (SELECT *, {O3_8H} AS o3_8h FROM readings),
      s AS (SELECT {KEYS}, ep, {si('o3', 'o3_1h')} AS aqi_o3, {si('o3_8h', 'o3_8h')} AS aqi_o3_8h, {si('co', 'co')} AS aqi_co, {si('so2', 'so2')} AS aqi_so2,
                   {si('no2', 'no2')} AS aqi_no2, {si('pm10', 'pm10')} AS aqi_pm10, {si('pm2_5', 'pm25')} AS aqi_pm25 FROM o),
      g AS (SELECT *, greatest(aqi_o3, aqi_o3_8h, aqi_co, aqi_so2, aqi_no2, aqi_pm10, aqi_pm25) AS aqi FROM s)
      SELECT *, {vn_category_sql('aqi')} AS category, {vn_color_sql('aqi')} AS color, {health_advice_sql('aqi')} AS advice FROM g""",
    "rolling_means": f"""WITH {READINGS_CTES.strip()}, {AVG_CTE.strip()}
      SELECT {KEYS}, ep, {", ".join(f"round({c}, 6) AS {c}" for c in [w[0] for w in WH])} FROM avgs""",
    "ozone_8h": f"""WITH {READINGS_CTES.strip()}
      SELECT {KEYS}, ep, o3, {O3_8H} AS o3_8h FROM readings""",
    "daily_aqi": DAILY_SQL,
    "daily_aqi_warehouse": f"""WITH {READINGS_CTES.strip()}, {WH_CTE.strip()}
      SELECT day, {KEYS}, {", ".join(f"round({o}, 6) AS {o}" for _, _, o in WH)}, round("AQI", 6) AS "AQI" FROM wh""",
    "aqi_bracket_join": f"""WITH {READINGS_CTES.strip()}, {AVG_CTE.strip()},
      bp(pollutant, lo, hi, ilo, ihi) AS (VALUES {BP_VALUES}),
      lng AS (
        {" UNION ALL ".join(f"SELECT {KEYS}, ep, '{t}' AS pollutant, {s} AS c FROM avgs" for s, t, _ in WH)}
      )
      SELECT {KEYS}, ep, l.pollutant, round(c, 6) AS c,
             round((c - lo) * (ihi - ilo) / (hi - lo) + ilo, 6) AS aqi
      FROM lng l JOIN bp ON l.pollutant = bp.pollutant AND l.c >= bp.lo AND l.c < bp.hi""",
    "aqi_stats": f"""WITH {READINGS_CTES.strip()}, {WH_CTE.strip()}
      SELECT count(*) AS n_rows, round(min("AQI"), 6) AS min_aqi, round(max("AQI"), 6) AS max_aqi,
             round(avg("AQI"), 6) AS avg_aqi FROM wh""",
    "latest_per_station": f"WITH {HOURLY_CTES}, {LATEST_CTE.strip()} SELECT {LATEST_COLS} FROM latest",
    "province_summary": f"""WITH {HOURLY_CTES}, {LATEST_CTE.strip()}
      SELECT province, region, count(DISTINCT district) AS district_count,
             round(avg(aqi_final::DOUBLE), 6) AS avg_aqi, max(aqi_final) AS max_aqi, min(aqi_final) AS min_aqi,
             max(ep) AS last_updated_ep
      FROM latest GROUP BY province, region""",
    "top_polluted": f"""WITH {HOURLY_CTES}, {LATEST_CTE.strip()}
      SELECT province, district, region, aqi_final, aqi_category, aqi_color, health_advice, ep
      FROM latest ORDER BY aqi_final DESC NULLS LAST, province, district LIMIT 10""",
    "top5_pm25": f"""WITH {READINGS_CTES.strip()},
      newest AS (SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY ep DESC) AS rn FROM readings)
      SELECT province, district, pm2_5, pm10 FROM newest WHERE rn = 1
      ORDER BY coalesce(pm2_5, 0.0) DESC, province, district LIMIT 5""",
    "station_history": f"""WITH {HOURLY_CTES}
      SELECT {KEYS}, ep, aqi_final, aqi_category, {", ".join(POLS)} FROM enriched
      WHERE ep >= (SELECT max(ep) FROM enriched) - 24""",
    "station_list": f"""WITH {READINGS_CTES.strip()}
      SELECT DISTINCT province, district FROM readings ORDER BY 1, 2""",
    "last24": f"""WITH {HOURLY_CTES}
      SELECT {KEYS}, ep, aqi_final FROM (
        SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY ep DESC) AS rn FROM enriched) WHERE rn <= 24""",
    "station_counts": f"""WITH {READINGS_CTES.strip()}
      SELECT coalesce(region, 'total') AS region, count(DISTINCT province || '|' || district) AS n_stations
      FROM readings GROUP BY ROLLUP (region)""",
    "null_profile": f"""WITH {READINGS_CTES.strip()},
      w AS (SELECT region, count(*) AS n_rows,
                   {", ".join(f"sum(CASE WHEN {c} IS NULL OR isnan({c}) THEN 1 ELSE 0 END) AS {c}" for c in POLS)}
            FROM readings GROUP BY region),
      l AS (UNPIVOT w ON {", ".join(POLS)} INTO NAME "column" VALUE n_null)
      SELECT region, n_rows, "column", n_null::BIGINT AS n_null, round(n_null / n_rows, 6) AS rate,
             row_number() OVER (PARTITION BY region ORDER BY n_null DESC, "column") AS rank,
             row_number() OVER (PARTITION BY region ORDER BY n_null DESC, "column") <= 3 AS top3
      FROM l""",
    "numeric_stats": f"""WITH {READINGS_CTES.strip()}
      {" UNION ALL ".join(f"SELECT region, '{c}' AS \"column\", round(avg({c}::DECIMAL(24,6)), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM readings GROUP BY region" for c in POLS)}""",
    "mean_imputed": f"""WITH {READINGS_CTES.strip()}, {IMPUTE_CTE.strip()}
      SELECT {KEYS}, ep, {", ".join(POLS)} FROM imputed""",
    "air_weather_join": f"""WITH {READINGS_CTES.strip()}, {ALIGN_CTES.strip()}
      SELECT {KEYS}, ep, pm2_5, pm10, temperature_2m, relative_humidity_2m, rain, wind_speed_10m FROM aw""",
    "single_station_join": f"""WITH {READINGS_CTES.strip()}, {WEATHER_CTES.strip()}
      SELECT a.province, a.district, a.ep, a.region AS region_x, w.region AS region_y, a.pm2_5, a.pm10,
             w.temperature_2m
      FROM readings a JOIN weather w USING (province, district, ep)
      WHERE a.pm2_5 IS NOT NULL AND a.pm10 IS NOT NULL""",
    "factor_corr": f"""WITH {READINGS_CTES.strip()}, {ALIGN_CTES.strip()}
      SELECT {KEYS}, count(pm2_5) AS n, {", ".join(f"round(CASE WHEN stddev_pop(CASE WHEN {f} IS NOT NULL THEN pm2_5 END) * stddev_pop(CASE WHEN pm2_5 IS NOT NULL THEN {f} END) <> 0 THEN covar_pop(pm2_5, {f}) / (stddev_pop(CASE WHEN {f} IS NOT NULL THEN pm2_5 END) * stddev_pop(CASE WHEN pm2_5 IS NOT NULL THEN {f} END)) END, 6) AS corr_{f}" for f in FACTORS)}
      FROM aw GROUP BY GROUPING SETS ((province, district), ())""",
    "factor_bins": f"""WITH {READINGS_CTES.strip()}, {ALIGN_CTES.strip()},
      l AS (
        SELECT pm2_5, 'humidity' AS factor, CAST(floor(relative_humidity_2m / 10) AS BIGINT) AS bin FROM aw WHERE pm2_5 IS NOT NULL
        UNION ALL SELECT pm2_5, 'rain', CAST(rain > 0 AS BIGINT) FROM aw WHERE pm2_5 IS NOT NULL
        UNION ALL SELECT pm2_5, 'wind', CAST(floor(wind_speed_10m / 5) AS BIGINT) FROM aw WHERE pm2_5 IS NOT NULL
        UNION ALL SELECT pm2_5, 'direction', CAST(floor(wind_direction_10m / 45) AS BIGINT) FROM aw WHERE pm2_5 IS NOT NULL
      )
      SELECT factor, bin, count(pm2_5) AS n, round(min(pm2_5), 6) AS min, round(avg(pm2_5::DECIMAL(24,6)), 6) AS avg,
             round(max(pm2_5), 6) AS max FROM l GROUP BY factor, bin""",
    "factor_quantiles": f"""WITH {READINGS_CTES.strip()}, {ALIGN_CTES.strip()},
      l AS (
        SELECT pm2_5, 'humidity' AS factor, CAST(floor(relative_humidity_2m / 10) AS BIGINT) AS bin FROM aw WHERE pm2_5 IS NOT NULL
        UNION ALL SELECT pm2_5, 'rain', CAST(rain > 0 AS BIGINT) FROM aw WHERE pm2_5 IS NOT NULL
        UNION ALL SELECT pm2_5, 'wind', CAST(floor(wind_speed_10m / 5) AS BIGINT) FROM aw WHERE pm2_5 IS NOT NULL
        UNION ALL SELECT pm2_5, 'direction', CAST(floor(wind_direction_10m / 45) AS BIGINT) FROM aw WHERE pm2_5 IS NOT NULL
      )
      SELECT factor, bin, count(pm2_5) AS n, quantile_disc(pm2_5, 0.5) AS median, quantile_disc(pm2_5, 0.9) AS p90 FROM l GROUP BY factor, bin""",
    "json_parse": f"""WITH {READINGS_CTES.strip()}
      SELECT {KEYS}, region, epoch_us(event_time) AS event_us, {", ".join(POLS)} FROM readings""",
    "encode_messages": f"""WITH {READINGS_CTES.strip()}
      SELECT province || '_' || district AS key,
             CAST(strlen(CAST(to_json({{'province': province, 'district': district, 'region': region, 'lat': lat,
               'lon': lon, 'timestamp': strftime(event_time, '%Y-%m-%dT%H:%M'), 'pm2_5': pm2_5, 'pm10': pm10,
               'o3': o3, 'no2': no2, 'so2': so2, 'co': co}}) AS VARCHAR)) AS INT) AS value_bytes, pm2_5
      FROM readings""",
    "payload_explode": f"""WITH {READINGS_CTES.strip()}
      SELECT province AS city_name, district, strftime(event_time, '%Y-%m-%dT%H:%M') AS time,
             pm2_5, pm10, o3 AS ozone, no2 AS nitrogen_dioxide, so2 AS sulphur_dioxide, co AS carbon_monoxide,
             'μg/m³' AS unit_pm2_5
      FROM readings""",
    "current_hour_pick": f"""WITH {READINGS_CTES.strip()},
      g AS (SELECT province AS city_name, district, {DAY} AS day,
                   list({{'time': strftime(event_time, '%Y-%m-%dT%H:%M'), 'pm2_5': pm2_5, 'pm10': pm10, 'ozone': o3,
                          'nitrogen_dioxide': no2, 'sulphur_dioxide': so2, 'carbon_monoxide': co}} ORDER BY ep) AS rows
            FROM readings GROUP BY ALL),
      p AS (SELECT *, list_position(list_transform(rows, lambda x: x.time),
                         (SELECT strftime(max(event_time), '%Y-%m-%dT%H:%M') FROM readings)) AS pos FROM g),
      i AS (SELECT *, CASE WHEN pos > 0 THEN pos ELSE greatest(0, len(rows) // 2) + 1 END AS idx FROM p)
      SELECT city_name, district, day, rows[idx].time AS timestamp, rows[idx].pm2_5 AS pm2_5,
             rows[idx].pm10 AS pm10, rows[idx].ozone AS ozone, rows[idx].nitrogen_dioxide AS nitrogen_dioxide,
             rows[idx].sulphur_dioxide AS sulphur_dioxide, rows[idx].carbon_monoxide AS carbon_monoxide
      FROM i""",
    "split_periods": f"""WITH {READINGS_CTES.strip()},
      span AS (SELECT {KEYS}, min(event_time) AS s, max(event_time) AS e FROM readings GROUP BY ALL),
      n AS (SELECT *, 48 * (abs(year(e) - year(s)) + 1) AS n, epoch_us(s) AS s_us,
                   CAST(round_even((epoch_us(e) - epoch_us(s))::DOUBLE / (48 * (abs(year(e) - year(s)) + 1)), 0) AS BIGINT) AS d
            FROM span)
      SELECT {KEYS}, piece::INT AS piece, s_us + piece * d AS begin_us, s_us + piece * d + d AS finish_us
      FROM n, LATERAL (SELECT unnest(range(0, n)) AS piece)""",
    "lag_features": f"""WITH {READINGS_CTES.strip()}, {FEATURE_CTES.strip()}
      SELECT {KEYS}, ep, {", ".join(f"round({c}, 6) AS {c}" for c in FEATS + ["aqi"])} FROM feat""",
    "scaled_features": f"""WITH {READINGS_CTES.strip()}, {FEATURE_CTES.strip()},
      st AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATS + ["aqi"])} FROM feat)
      SELECT {KEYS}, ep, {", ".join(f"round(CASE WHEN s_{c} <> 0 THEN ({c} - m_{c}) / s_{c} END, 6) AS {c}_z" for c in FEATS + ["aqi"])}
      FROM feat, st""",
    "sequence_windows": f"""WITH {READINGS_CTES.strip()}, {FEATURE_CTES.strip()},
      sp AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY {KEYS} ORDER BY ep)
                           <= floor(count(*) OVER (PARTITION BY {KEYS}) * 0.8) THEN 'train' ELSE 'test' END AS split
             FROM feat),
      sq AS (SELECT *, row_number() OVER (PARTITION BY {KEYS}, split ORDER BY ep) - 1 AS i,
                   count(*) OVER (PARTITION BY {KEYS}, split) AS n,
                   list(aqi) OVER (PARTITION BY {KEYS}, split ORDER BY ep ROWS BETWEEN 24 FOLLOWING AND 47 FOLLOWING) AS y
             FROM sp)
      SELECT {KEYS}, split, i::INT AS i, 24 AS x_len, len(y)::INT AS y_len, round(pm10, 6) AS x0_pm10,
             round(list_reduce(y, lambda a, b: a + b, 0.0::DOUBLE), 4) AS y_sum, round(y[-1], 6) AS y_last
      FROM sq WHERE i < n - 48""",
    "naive_forecast_error": f"""WITH {READINGS_CTES.strip()}, {FEATURE_CTES.strip()},
      h AS (SELECT unnest(range(1, 25)) AS horizon),
      pr AS (SELECT {KEYS}, aqi, row_number() OVER (PARTITION BY {KEYS} ORDER BY ep) AS rn FROM feat),
      pairs AS (SELECT h.horizon, a.aqi AS base, b.aqi AS actual
                FROM pr a JOIN h ON TRUE JOIN pr b ON a.province = b.province AND a.district = b.district
                 AND b.rn = a.rn + h.horizon)
      SELECT horizon::INT AS horizon, count(*) AS n, round(avg(abs(actual - base)), 6) AS mae,
             round(avg((actual - base) * (actual - base)), 6) AS mse
      FROM pairs GROUP BY horizon""",
    "future_spine": f"""WITH {READINGS_CTES.strip()}, {FEATURE_CTES.strip()},
      last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY ep DESC) AS rn FROM feat) WHERE rn = 1),
      sp AS (SELECT {KEYS}, aqi, unnest(range(1, 25)) AS step, event_time FROM last),
      v AS (SELECT *, greatest(0.0, least(300.0, aqi)) AS c FROM sp)
      SELECT {KEYS}, step::INT AS step, strftime(event_time + step * INTERVAL 1 HOUR, '%H:%M') AS time,
             round(c, 2) AS aqi,
             CASE WHEN c <= 50 THEN 'Tốt' WHEN c <= 100 THEN 'Trung bình' WHEN c <= 150 THEN 'Kém' ELSE 'Nguy hiểm' END AS level,
             CASE WHEN c <= 50 THEN 'success' WHEN c <= 100 THEN 'warning' WHEN c <= 150 THEN 'danger' ELSE 'dark' END AS color
      FROM v""",
})

NAN_CTES = f"""
{READINGS_CTES.strip()},
nr AS (SELECT * REPLACE (CASE WHEN ep % 5 = 0 THEN NULL ELSE pm2_5 END AS pm2_5, CASE WHEN ep % 5 = 0 THEN NULL ELSE o3 END AS o3) FROM readings)"""

_EPA_SQL = {"pm25": ("pm2_5", "pm25"), "pm10": ("pm10", "pm10"), "o3": ("o3", "o3_1h"), "no2": ("no2", "no2"), "so2": ("so2", "so2"), "co": ("co", "co")}

ORACLE.update({
    "district_time_join": f"""WITH {READINGS_CTES.strip()}, {WEATHER_CTES.strip()},
      a AS (SELECT * FROM readings WHERE district = (SELECT min(district) FROM readings)),
      w AS (SELECT * FROM weather WHERE district = (SELECT min(district) FROM readings))
      SELECT a.region AS region_x, w.region AS region_y, a.ep AS ep_x, w.ep AS ep_y, pm2_5, pm10, temperature_2m, rain
      FROM a JOIN w ON a.event_time = w.event_time
      WHERE a.event_time >= (SELECT max(event_time) FROM a) - INTERVAL 10 DAY""",
    "json_quarantine": f"""WITH {READINGS_CTES.strip()}
      SELECT region, count(*) AS n, NULL::INT AS longest, 'parsed' AS kind FROM readings WHERE ep % 7 <> 0 GROUP BY region
      UNION ALL SELECT NULL, count(*), max(40)::INT, 'quarantine' FROM readings WHERE ep % 7 = 0""",
    "aqi_epa_sql_functions": f"""WITH {READINGS_CTES.strip()},
      s AS (SELECT *, {", ".join(f"{si(c, t, 'epa_stepped')} AS epa_{n}" for n, (c, t) in _EPA_SQL.items())},
                   CASE WHEN pm2_5 IS NOT NULL THEN {si('pm2_5', 'pm25')} END AS vn FROM readings),
      g AS (SELECT *, greatest({", ".join(f"epa_{n}" for n in _EPA_SQL)}) AS m FROM s)
      SELECT {KEYS}, ep, {", ".join(f"epa_{n}" for n in _EPA_SQL)},
        CASE WHEN m IS NULL OR m <= 0 THEN 'Unknown' WHEN m <= 50 THEN 'Good' WHEN m <= 100 THEN 'Moderate'
             WHEN m <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN m <= 200 THEN 'Unhealthy' WHEN m <= 300 THEN 'Very Unhealthy'
             ELSE 'Hazardous' END AS epa_category, {vn_rgb_sql('vn')} AS rgb FROM g""",
    "nan_readings": f"""WITH {NAN_CTES.strip()},
      l AS (SELECT *, {nowcast_list_sql('pm2_5')} AS __l_pm2_5, row_number() OVER (PARTITION BY {KEYS} ORDER BY ep) AS __rn,
                   {_nc_batch('pm2_5', 'pm25')} FROM nr),
      m AS (SELECT region, round(avg(pm2_5::DECIMAL(24,6)), 6) AS m FROM nr GROUP BY region),
      o AS (SELECT {KEYS}, ep, {O3_8H} AS o3_8h FROM nr)
      SELECT l.province, l.district, l.ep, {nowcast_sql('pm2_5')} AS nowcast, round({_nc_batch_value('pm25')}, 6) AS nc_batch, o.o3_8h,
             coalesce(l.pm2_5, m.m) AS filled
      FROM l JOIN m USING (region) JOIN o USING (province, district, ep)""",
    "daily_peak_hours": f"""WITH {READINGS_CTES.strip()},
      d AS (SELECT *, {DAY} AS day FROM readings WHERE pm2_5 IS NOT NULL),
      m AS (SELECT *, max(pm2_5) OVER (PARTITION BY {KEYS}, day) AS top FROM d)
      SELECT {KEYS}, day, ep, pm2_5 FROM m WHERE pm2_5 = top""",
    "unmatched_events": """SELECT count(*) AS n_events, count(CASE WHEN c_custkey IS NULL THEN 1 END) AS n_unmatched
      FROM events LEFT JOIN customer ON user_id = c_custkey""",
    "inverse_scaled": f"""WITH {READINGS_CTES.strip()}, {FEATURE_CTES.strip()},
      st AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in ("aqi_lag1", "aqi_lag24", "aqi"))} FROM feat)
      SELECT {KEYS}, ep, {", ".join(f"round({c}::DOUBLE, 6) AS {c}" for c in FEATS + ["aqi"])},
        round(((aqi_lag1 - m_aqi_lag1) / s_aqi_lag1 + (aqi_lag24 - m_aqi_lag24) / s_aqi_lag24) / 2 * s_aqi + m_aqi, 6) AS forecast
      FROM feat, st""",
    "forecast_eval": evaluation_sql(READINGS_CTES.strip(), FEATURE_CTES.strip(), FEATS, KEYS),
    "forecast_24h": scoring_sql(READINGS_CTES.strip(), FEATURE_CTES.strip(), FEATS, KEYS, 1),
    "forecast_windows_24h": scoring_sql(READINGS_CTES.strip(), FEATURE_CTES.strip(), FEATS, KEYS, 24),
    "scaling_stats": scaling_sql(READINGS_CTES.strip(), FEATURE_CTES.strip(), FEATS, KEYS),
})

STREAM_CTES = f"""
{READINGS_CTES.strip()},
sp AS (SELECT *, coalesce(pm2_5, 0.0) AS nowcast_pm25, coalesce(pm10, 0.0) AS nowcast_pm10
       FROM readings WHERE pm2_5 IS NOT NULL OR pm10 IS NOT NULL),
ss AS (
  SELECT *, {si('o3', 'o3_1h')} AS aqi_o3, {si('co', 'co')} AS aqi_co, {si('so2', 'so2')} AS aqi_so2,
         {si('no2', 'no2')} AS aqi_no2, {si('nowcast_pm10', 'pm10')} AS aqi_pm10,
         {si('nowcast_pm25', 'pm25')} AS aqi_pm25
  FROM sp
),
sf AS (SELECT *, greatest(aqi_o3, aqi_co, aqi_so2, aqi_no2, aqi_pm10, aqi_pm25) AS aqi_final FROM ss),
senr AS (SELECT *, {vn_category_sql('aqi_final')} AS aqi_category FROM sf)"""

ORACLE.update({
    "stream_enrich": f"""WITH {STREAM_CTES}
      SELECT {KEYS}, ep, {", ".join(POLS)}, nowcast_pm25, nowcast_pm10, aqi_o3, aqi_co, aqi_so2, aqi_no2,
             aqi_pm10, aqi_pm25, aqi_final, aqi_category FROM senr""",
    "stream_dedup": f"""WITH {READINGS_CTES.strip()}
      SELECT {KEYS}, epoch_us(event_time) AS event_us, {", ".join(POLS)} FROM readings""",
    "stream_latest": f"""WITH {STREAM_CTES}
      SELECT {KEYS}, ep, aqi_final, aqi_category, pm2_5 FROM (
        SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY ep DESC) AS rn FROM senr) WHERE rn = 1""",
    "stream_nowcast": f"""WITH {READINGS_CTES.strip()},
      l AS (SELECT *, {nowcast_list_sql('pm2_5')} AS __l_pm2_5 FROM readings),
      n AS (SELECT *, {nowcast_sql('pm2_5')} AS nowcast_pm25 FROM l)
      SELECT {KEYS}, ep, nowcast_pm25 FROM n""",
    "stream_daily": DAILY_SQL,
    "stream_quarantine": f"""WITH {READINGS_CTES.strip()},
      r AS (SELECT *, CASE WHEN ep % 7 = 0 THEN 'n_bad_json' WHEN ep % 11 = 0 THEN 'n_bad_time' ELSE 'n_parsed' END AS fate FROM readings)
      SELECT region, count(*) AS n, 'written' AS kind FROM r WHERE fate = 'n_parsed' AND (pm2_5 IS NOT NULL OR pm10 IS NOT NULL) GROUP BY region
      UNION ALL SELECT NULL, count(*), CASE fate WHEN 'n_bad_json' THEN 'quarantine json' ELSE 'quarantine time' END FROM r WHERE fate <> 'n_parsed' GROUP BY fate
      UNION ALL SELECT NULL, count(*), fate FROM r GROUP BY fate UNION ALL SELECT NULL, count(*), 'n_messages' FROM r""",
    "stream_throughput": f"""WITH {READINGS_CTES.strip()}
      SELECT count(*) AS n_msgs, CAST(sum(strlen(CAST(to_json({{'province': province, 'district': district,
               'region': region, 'lat': lat, 'lon': lon, 'timestamp': strftime(event_time, '%Y-%m-%dT%H:%M'),
               'pm2_5': pm2_5, 'pm10': pm10, 'o3': o3, 'no2': no2, 'so2': so2, 'co': co}}) AS VARCHAR))) AS BIGINT)
             AS total_bytes
      FROM readings""",
    "sorted_readings": f"""WITH {READINGS_CTES.strip()}
      SELECT {KEYS}, ep, pm2_5, row_number() OVER (ORDER BY province, district, ep) AS position FROM readings""",
    "global_split": f"""WITH {READINGS_CTES.strip()}, p AS (
        SELECT {KEYS}, ep, pm2_5, row_number() OVER (ORDER BY ep, province, district) AS position, count(*) OVER () AS n FROM readings)
      SELECT *, CASE WHEN position <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM p""",
    "throughput_metrics": f"""WITH {READINGS_CTES.strip()}
      SELECT count(*) AS n_msgs, CAST(sum(strlen(CAST(to_json({{'province': province, 'district': district,
               'region': region, 'lat': lat, 'lon': lon, 'timestamp': strftime(event_time, '%Y-%m-%dT%H:%M'),
               'pm2_5': pm2_5, 'pm10': pm10, 'o3': o3, 'no2': no2, 'so2': so2, 'co': co}}) AS VARCHAR))) AS BIGINT)
             AS total_bytes
      FROM readings""",
    "csv_roundtrip": f"""WITH {READINGS_CTES.strip()}
      SELECT {KEYS}, epoch_us(event_time) AS event_us, {", ".join(POLS)} FROM readings""",
    "preamble_csv": f"""WITH {READINGS_CTES.strip()}
      SELECT {KEYS}, strftime(event_time, '%Y-%m-%dT%H:%M') AS time, {", ".join(POLS)} FROM readings""",
    "snapshot_json": f"""WITH {READINGS_CTES.strip()}
      SELECT {KEYS}, region, pm2_5, pm10, strftime(event_time, '%Y%m%d_%H%M') AS snapshot_minute FROM (
        SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY ep DESC) AS rn FROM readings) WHERE rn = 1""",
    "partitioned_sink": f"""WITH {HOURLY_CTES}
      SELECT {KEYS}, region, year(event_time)::INT AS year, month(event_time)::INT AS month,
             day(event_time)::INT AS day, ep, aqi_final FROM enriched""",
})

ORACLE = {k: half_up_rounding(v) for k, v in ORACLE.items()}
