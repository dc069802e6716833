"""DuckDB SQL building blocks for the oracle (same rules, written as SQL).

Views ``events customer nation region`` are pre-registered by the checker.
"""

from __future__ import annotations

import re

# The oracle shares no rule, table or constant with the engine: everything it
# needs is written out here, so a wrong value on either side shows.

# ---------------------------------------------------------------------------
# FIXED VALUES of the input mapping: reading, event type, factor.
# ---------------------------------------------------------------------------
POLLUTANT_EVENTS = [("pm2_5", "view", 1.1), ("pm10", "click", 1.3), ("o3", "purchase", 2.6),
                    ("no2", "signup", 8.0), ("so2", "error", 5.5)]
CO_FACTOR = 1600.0
DIGITS = 6

# ---------------------------------------------------------------------------
# FIXED VALUES of the published rule tables: (C_low, C_high, I_low, I_high).
# ---------------------------------------------------------------------------
VN_TABLE = {
    "o3_1h": [(0, 160, 0, 50), (160, 200, 50, 100), (200, 300, 100, 150), (300, 400, 150, 200),
              (400, 800, 200, 300), (800, 1000, 300, 400), (1000, 1200, 400, 500)],
    "o3_8h": [(0, 100, 0, 50), (100, 120, 50, 100), (120, 170, 100, 150), (170, 210, 150, 200),
              (210, 400, 200, 300)],
    "co": [(0, 10000, 0, 50), (10000, 30000, 50, 100), (30000, 45000, 100, 150), (45000, 60000, 150, 200),
           (60000, 90000, 200, 300), (90000, 120000, 300, 400), (120000, 150000, 400, 500)],
    "so2": [(0, 125, 0, 50), (125, 350, 50, 100), (350, 550, 100, 150), (550, 800, 150, 200),
            (800, 1600, 200, 300), (1600, 2100, 300, 400), (2100, 2630, 400, 500)],
    "no2": [(0, 100, 0, 50), (100, 200, 50, 100), (200, 700, 100, 150), (700, 1200, 150, 200),
            (1200, 2350, 200, 300), (2350, 3100, 300, 400), (3100, 3850, 400, 500)],
    "pm10": [(0, 50, 0, 50), (50, 150, 50, 100), (150, 250, 100, 150), (250, 350, 150, 200),
             (350, 420, 200, 300), (420, 500, 300, 400), (500, 600, 400, 500)],
    "pm25": [(0, 25, 0, 50), (25, 50, 50, 100), (50, 80, 100, 150), (80, 150, 150, 200),
             (150, 250, 200, 300), (250, 350, 300, 400), (350, 500, 400, 500)],
}
EPA_TABLE = {
    "pm25": [(0, 12, 0, 50), (12.1, 35.4, 51, 100), (35.5, 55.4, 101, 150), (55.5, 150.4, 151, 200),
             (150.5, 250.4, 201, 300), (250.5, 500.4, 301, 500)],
    "pm10": [(0, 54, 0, 50), (55, 154, 51, 100), (155, 254, 101, 150), (255, 354, 151, 200),
             (355, 424, 201, 300), (425, 604, 301, 500)],
    "o3_1h": [(0, 54, 0, 50), (55, 70, 51, 100), (71, 85, 101, 150), (86, 105, 151, 200), (106, 200, 201, 300)],
    "no2": [(0, 53, 0, 50), (54, 100, 51, 100), (101, 360, 101, 150), (361, 649, 151, 200),
            (650, 1249, 201, 300), (1250, 2049, 301, 500)],
    "so2": [(0, 35, 0, 50), (36, 75, 51, 100), (76, 185, 101, 150), (186, 304, 151, 200),
            (305, 604, 201, 300), (605, 1004, 301, 500)],
    "co": [(0, 4.4, 0, 50), (4.5, 9.4, 51, 100), (9.5, 12.4, 101, 150), (12.5, 15.4, 151, 200),
           (15.5, 30.4, 201, 300), (30.5, 50.4, 301, 500)],
}
# Continuous PM2.5 cascade: upper C, C offset, I at the offset, I span, C span.
EPA_PM25 = [(12.0, 0.0, 0.0, 50.0, 12.0), (35.4, 12.0, 51.0, 49.0, 23.4), (55.4, 35.4, 101.0, 49.0, 19.9),
            (150.4, 55.4, 151.0, 49.0, 94.9), (250.4, 150.4, 201.0, 99.0, 99.9), (350.4, 250.4, 301.0, 99.0, 99.9),
            (500.4, 350.4, 401.0, 99.0, 149.9)]
# Label scales: label of a missing index, then (upper index, label), then the rest.
CATEGORY = ["Không xác định", (50, "Tốt"), (100, "Trung bình"), (150, "Kém"), (200, "Xấu"), (300, "Rất xấu"), "Nguy hại"]
COLOR = ["#CCCCCC", (50, "#00E400"), (100, "#FFFF00"), (150, "#FF7E00"), (200, "#FF0000"), (300, "#8F3F97"), "#7E0023"]
ADVICE = ["Không có dữ liệu", (50, "Chất lượng không khí tốt. Tự do hoạt động ngoài trời."),
          (100, "Chấp nhận được. Người nhạy cảm nên theo dõi triệu chứng."),
          (150, "Người nhạy cảm nên giảm hoạt động ngoài trời."),
          (200, "Mọi người nên giảm hoạt động ngoài trời, đeo khẩu trang."),
          (300, "Hạn chế tối đa hoạt động ngoài trời. Đeo khẩu trang khi ra ngoài."),
          "Ở trong nhà, đóng cửa sổ. Bắt buộc đeo khẩu trang nếu ra ngoài."]
RGB = [None, (50, "0;228;0"), (100, "255;255;0"), (150, "255;126;0"), (200, "255;0;0"), (300, "143;63;151"), "126;0;35"]
# ---------------------------------------------------------------------------


def label_sql(x: str, scale, missing: str = "{x} IS NULL OR {x} <= 0") -> str:
    first, *steps, last = scale
    quote = lambda s: "NULL" if s is None else "'" + s + "'"
    whens = " ".join(f"WHEN {x} <= {upper} THEN {quote(label)}" for upper, label in steps)
    return f"(CASE WHEN {missing.format(x=x)} THEN {quote(first)} {whens} ELSE {quote(last)} END)"


def vn_category_sql(x: str) -> str:
    return label_sql(x, CATEGORY)


def vn_color_sql(x: str) -> str:
    return label_sql(x, COLOR)


def health_advice_sql(x: str) -> str:
    return label_sql(x, ADVICE)


def vn_rgb_sql(x: str) -> str:
    return label_sql(x, RGB, "{x} IS NULL")


def round_half_even_exact(x: str, digits: int) -> str:
    """Half-even rounding of the exact decimal expansion of a double."""
    d = f"CAST(format('{{:.30f}}', CASE WHEN isfinite(v) THEN v END) AS DECIMAL(38,30)) * {10 ** digits}"
    return (f"(SELECT CASE WHEN t IS NULL THEN NULL WHEN t - floor(t) > 0.5 OR (t - floor(t) = 0.5 AND floor(t) % 2 <> 0) "
            f"THEN (floor(t) + 1)::DOUBLE ELSE floor(t)::DOUBLE END / {float(10 ** digits)} "
            f"FROM (SELECT {d} AS t FROM (SELECT ({x})::DOUBLE AS v)))")

EP = "date_diff('hour', TIMESTAMP '1970-01-01 00:00:00', {ts})"


def _pollutant_sums() -> str:
    parts = []
    for name, etype, _ in POLLUTANT_EVENTS:
        parts.append(f"sum(CASE WHEN event_type = '{etype}' THEN value END) AS s_{name}")
        parts.append(f"count(CASE WHEN event_type = '{etype}' THEN value END) AS n_{name}")
    return ", ".join(parts)


def _pollutant_vals() -> str:
    parts = [f"round(CASE WHEN n_{n} > 0 THEN s_{n} / n_{n} END * CAST('{f!r}' AS DOUBLE), {DIGITS}) AS {n}"
             for n, _, f in POLLUTANT_EVENTS]
    parts.append(f"round(CASE WHEN n_k > 0 THEN s_k / n_k END * CAST('{CO_FACTOR!r}' AS DOUBLE), {DIGITS}) AS co")
    return ", ".join(parts)


STATIONS_CTE = """
stations AS (
  SELECT n.n_nationkey AS station_id, r.r_name AS province, n.n_name AS district,
         CASE WHEN r.r_regionkey <= 1 THEN 'north' WHEN r.r_regionkey = 2 THEN 'central'
              ELSE 'south' END AS region,
         round(8.5::DOUBLE + n.n_nationkey * 0.6::DOUBLE, 4) AS lat,
         round(102.5::DOUBLE + n.n_nationkey * 0.3::DOUBLE, 4) AS lon
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

_sum_cols = ", ".join(f"sum(s_{n}) AS s_{n}, sum(n_{n}) AS n_{n}" for n, _, _ in POLLUTANT_EVENTS)

READINGS_CTES = f"""
{STATIONS_CTE.strip()},
ev AS (
  SELECT user_id, {EP.format(ts='ts')} AS ep, event_type, value,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events
),
cells AS (
  SELECT user_id, ep, {_pollutant_sums()}, sum(k) AS s_k, count(k) AS n_k
  FROM ev GROUP BY user_id, ep
),
merged AS (
  SELECT cu.c_nationkey AS station_id, c.ep, {_sum_cols}, sum(s_k) AS s_k, sum(n_k) AS n_k
  FROM cells c JOIN customer cu ON c.user_id = cu.c_custkey
  GROUP BY cu.c_nationkey, c.ep
),
readings AS (
  SELECT s.province, s.district, s.region, s.lat, s.lon, m.ep,
         TIMESTAMP '1970-01-01 00:00:00' + m.ep * INTERVAL 1 HOUR AS event_time,
         {_pollutant_vals()}
  FROM merged m JOIN stations s ON m.station_id = s.station_id
)"""

WEATHER_CTES = f"""
wev AS (
  SELECT user_id, {EP.format(ts="(ts + INTERVAL 30 MINUTE)")} AS ep, event_type, value,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events
),
wcells AS (
  SELECT user_id, ep, sum(value) AS sv, count(value) AS nv, sum(k) AS sk, count(k) AS nk,
         sum(CASE WHEN event_type = 'error' THEN value END) AS se, min(value) AS mn, max(value) AS mx
  FROM wev GROUP BY user_id, ep
),
wmerged AS (
  SELECT cu.c_nationkey AS station_id, c.ep, sum(sv) AS sv, sum(nv) AS nv, sum(sk) AS sk,
         sum(nk) AS nk, sum(se) AS se, min(mn) AS mn, max(mx) AS mx
  FROM wcells c JOIN customer cu ON c.user_id = cu.c_custkey
  GROUP BY cu.c_nationkey, c.ep
),
weather AS (
  SELECT s.province, s.district, s.region, w.ep,
         TIMESTAMP '1970-01-01 00:00:00' + w.ep * INTERVAL 1 HOUR AS event_time,
         round(15.0 + CASE WHEN nv > 0 THEN sv / nv END / 25.0, {DIGITS}) AS temperature_2m,
         round(CASE WHEN nk > 0 THEN sk / nk END, {DIGITS}) AS relative_humidity_2m,
         round(coalesce(se, 0.0) / 100.0, {DIGITS}) AS rain,
         round(mn / 10.0, {DIGITS}) AS wind_speed_10m,
         round(mx / 8.0, {DIGITS}) AS wind_speed_100m,
         CAST(((sk * 37.0) % 360.0 + 360.0) % 360.0 AS DOUBLE) AS wind_direction_10m
  FROM wmerged w JOIN stations s ON w.station_id = s.station_id
)"""


def nowcast_sql(src: str, ep: str = "ep", key: str = "province, district") -> str:
    """Expression over a column ``__l_{src}`` holding list(struct(e, v)) of the
    last 12 hours (non-null values), newest first."""
    lst = f"__l_{src}"
    n3 = f"len(list_filter({lst}, lambda p: p.e >= {ep} - 2))"
    cmax = f"list_max(list_transform({lst}, lambda p: p.v))"
    cmin = f"list_min(list_transform({lst}, lambda p: p.v))"
    w = f"greatest(0.5, CASE WHEN {cmax} <> 0 THEN {cmin} / {cmax} END)"
    num = f"list_reduce(list_transform({lst}, lambda p: pow({w}, ({ep} - p.e)::DOUBLE) * p.v), lambda a, b: a + b, 0.0::DOUBLE)"
    den = f"list_reduce(list_transform({lst}, lambda p: pow({w}, ({ep} - p.e)::DOUBLE)), lambda a, b: a + b, 0.0::DOUBLE)"
    return (f"CASE WHEN {n3} < 2 THEN NULL WHEN {cmax} = 0 THEN 0.0::DOUBLE "
            f"ELSE {round_half_even_exact(f'{num} / {den}', 2)} END")


def nowcast_list_sql(src: str, key: str = "province, district", ep: str = "ep") -> str:
    return (f"list_sort(list_filter(list(CASE WHEN {src} IS NOT NULL THEN {{'e': {ep}, 'v': {src}::DOUBLE}} END) "
            f"OVER (PARTITION BY {key} ORDER BY {ep} RANGE BETWEEN 11 PRECEDING AND CURRENT ROW), "
            f"lambda x: x IS NOT NULL), 'DESC')")


def half_up_rounding(sql: str) -> str:
    """Rewrite every ``round(x, d)`` to round the shortest decimal text of the
    double half-up, which is what Spark's ``round`` does (DuckDB's double
    ``round`` scales in binary and can land on the other side of a tie)."""
    out, i = [], 0
    pat = re.compile(r"(?<![a-z_])round\(")
    while True:
        m = pat.search(sql, i)
        if not m:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:m.start()])
        depth, j, comma = 1, m.end(), None
        while depth:
            ch = sql[j]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = j
            j += 1
        inner = half_up_rounding(sql[m.end():comma])
        digits = sql[comma + 1:j - 1].strip()
        out.append(f"CAST(round(CAST(CAST({inner} AS VARCHAR) AS DECIMAL(38,17)), {digits}) AS DOUBLE)")
        i = j


def _d(v) -> str:
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def si(col: str, table: str, profile: str = "vn_stream") -> str:
    """Sub-index of a concentration as SQL, per rule set:

    * ``vn_stream``: NULL or below 0 gives 0, above the top 500; closed brackets,
      half-even integer.
    * ``vn_batch``: closed brackets, half-even double; everything else, also
      NULL, gives 500.
    * ``vn_warehouse``: half-open brackets, unrounded; everything else is NULL.
    * ``epa_stepped``: EPA tables; NULL, 0 and below 0 give 0, gaps and beyond 500.
    * ``epa_pm25``: the continuous cascade."""
    if profile == "epa_pm25":
        whens = " ".join(f"WHEN {col} <= {_d(top)} THEN {_d(span / width)} * ({col} - {_d(c0)}) + {_d(i0)}"
                         for top, c0, i0, span, width in EPA_PM25)
        return f"(CASE WHEN {col} IS NULL THEN NULL {whens} ELSE 500.0::DOUBLE END)"
    rows = (EPA_TABLE if profile == "epa_stepped" else VN_TABLE)[table]
    if profile == "vn_warehouse":
        whens = " ".join(f"WHEN {col} >= {_d(a)} AND {col} < {_d(b)} THEN ({col} - {_d(a)}) * {_d(j - i)} / {_d(b - a)} + {_d(i)}"
                         for a, b, i, j in rows)
        return f"(CASE {whens} END)"
    value = {a: f"round_even({_d((j - i) / (b - a))} * ({col} - {_d(a)}) + {_d(i)}, 0)" for a, b, i, j in rows}
    if profile == "vn_batch":
        whens = " ".join(f"WHEN {col} >= {_d(a)} AND {col} <= {_d(b)} THEN {value[a]}" for a, b, _, _ in rows)
        return f"(CASE WHEN {col} IS NULL THEN 500.0::DOUBLE {whens} ELSE 500.0::DOUBLE END)"
    whens = " ".join(f"WHEN {col} >= {_d(a)} AND {col} <= {_d(b)} THEN {value[a]}::INT" for a, b, _, _ in rows)
    return f"(CASE WHEN {col} IS NULL OR {col} < 0{' OR ' + col + ' = 0' if profile == 'epa_stepped' else ''} THEN 0 {whens} ELSE 500 END)"


def seq_window(agg: str, x: str, frame: str) -> str:
    """Windowed sum/avg accumulated oldest-to-newest, as Spark's sliding
    row frame does (DuckDB's segment tree adds in another order)."""
    lst = (f"list_transform(list_sort(list_filter(list(CASE WHEN {x} IS NOT NULL THEN "
           f"{{'e': ep, 'v': {x}::DOUBLE}} END) OVER ({frame}), lambda q: q IS NOT NULL)), lambda q: q.v)")
    total = f"list_reduce({lst}, lambda a, b: a + b, 0.0::DOUBLE)"
    if agg == "sum":
        return f"CASE WHEN count({x}) OVER ({frame}) > 0 THEN {total} END"
    return f"CASE WHEN count({x}) OVER ({frame}) > 0 THEN {total} / count({x}) OVER ({frame}) END"
