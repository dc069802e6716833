"""DuckDB SQL of the forecast queries: samples, normal equations and Gauss-Jordan
elimination as relations and lists.  Shares nothing with the engine."""

from __future__ import annotations

HOURS = 24
RIDGE = {1: "1e-6", 24: "0.1"}


def model_ctes(features: str, names: list[str], keys: str, windows=(1,)) -> str:
    """CTEs of the split, the samples ``full`` and, per window w, the solved system
    ``b{w}`` (i, r): r[1 + w * len(names) + h] is the coefficient of input i for hour h."""
    z = ", ".join(f"CASE WHEN s_{c} <> 0 THEN ({c}::DOUBLE - m_{c}) / s_{c} ELSE 0.0 END" for c in names)
    stats = ", ".join(f"avg({c}::DOUBLE) AS m_{c}, stddev_pop({c}::DOUBLE) AS s_{c}" for c in names)
    ctes = [features, f"""
sp AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY {keys} ORDER BY ep)
                     <= floor(count(*) OVER (PARTITION BY {keys}) * 0.8) THEN 'train' ELSE 'test' END AS split FROM feat),
st AS MATERIALIZED (SELECT {stats} FROM sp WHERE split = 'train'),
zs AS MATERIALIZED (SELECT {keys}, ep, event_time, split, aqi::DOUBLE AS aqi, [{z}] AS z FROM sp, st),
ctx AS (SELECT *, list(aqi) OVER fwd AS y, list(aqi) OVER back AS past, list(z) OVER back AS zz FROM zs
  WINDOW fwd AS (PARTITION BY {keys}, split ORDER BY ep ROWS BETWEEN 1 FOLLOWING AND {HOURS} FOLLOWING),
         back AS (PARTITION BY {keys}, split ORDER BY ep ROWS BETWEEN {HOURS - 1} PRECEDING AND CURRENT ROW)),
full_ AS MATERIALIZED (SELECT *, list_concat([1.0::DOUBLE], z) AS x1, list_concat([1.0::DOUBLE], flatten(zz)) AS x24 FROM ctx
  WHERE len(y) = {HOURS} AND len(past) = {HOURS})"""]
    for w in windows:
        p = 1 + w * len(names)
        ctes.append(f"""
cols{w} AS MATERIALIZED (SELECT i, list(x{w}[i] ORDER BY {keys}, ep) AS v FROM full_, range(1, {p + 1}) t(i) WHERE split = 'train' GROUP BY i
  UNION ALL SELECT {p} + i, list(y[i] ORDER BY {keys}, ep) FROM full_, range(1, {HOURS + 1}) t(i) WHERE split = 'train' GROUP BY i),
eq{w} AS MATERIALIZED (SELECT a.i, list(list_dot_product(a.v, b.v) + CASE WHEN a.i = b.i AND a.i > 1 THEN {RIDGE[w]} * len(a.v) ELSE 0 END ORDER BY b.i) AS r
  FROM cols{w} a, cols{w} b WHERE a.i <= {p} GROUP BY a.i),
b{w}(k, i, r) USING KEY (i) AS (
  SELECT 1, i, r FROM eq{w}
  UNION
  SELECT g.k + 1, g.i, CASE WHEN g.i = g.k THEN list_transform(g.r, lambda v: v / p.r[p.k])
                            ELSE list_transform(g.r, lambda v, j: v - g.r[g.k] * p.r[j] / p.r[p.k]) END
  FROM b{w} AS g JOIN b{w} AS p ON p.i = p.k AND g.k = p.k WHERE g.k <= {p}),
c{w} AS MATERIALIZED (SELECT h, list(r[{p} + h] ORDER BY i) AS c FROM b{w}, range(1, {HOURS + 1}) t(h) GROUP BY h)""")
    return ",".join(ctes)


def evaluation_sql(readings: str, features: str, names: list[str], keys: str) -> str:
    err = ", ".join(f"round(avg(abs({g} - y[h])), 4) AS mae{s}, round(avg(({g} - y[h]) * ({g} - y[h])), 4) AS mse{s}" for s, g in (
        ("", "list_dot_product(x1, c1.c)"), ("_window", "list_dot_product(x24, c24.c)"), ("_persistence", "past[-1]"), ("_seasonal", "past[h]")))
    return f"""WITH RECURSIVE {readings}, {model_ctes(features, names, keys, (1, 24))}
SELECT h::INT AS h, count(*) AS n, {err} FROM full_, c1 JOIN c24 USING (h) WHERE split = 'test' GROUP BY h"""


def scoring_sql(readings: str, features: str, names: list[str], keys: str, w: int) -> str:
    return f"""WITH RECURSIVE {readings}, {model_ctes(features, names, keys, (w,))},
newest AS (SELECT {keys}, max(event_time) AS t, list_concat([1.0::DOUBLE], flatten(list(z ORDER BY ep))) AS x FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ep DESC) AS rn FROM zs) WHERE rn <= {w} GROUP BY {keys} HAVING count(*) = {w}),
v AS (SELECT {keys}, h, t, greatest(0.0, least(300.0, list_dot_product(x, c))) AS v FROM newest, c{w})
SELECT {keys}, h::INT AS step, strftime(t + h * INTERVAL 1 HOUR, '%H:%M') AS time, round(v, 2) AS aqi,
  CASE WHEN v <= 50 THEN 'Tốt' WHEN v <= 100 THEN 'Trung bình' WHEN v <= 150 THEN 'Kém' ELSE 'Nguy hiểm' END AS level,
  CASE WHEN v <= 50 THEN 'success' WHEN v <= 100 THEN 'warning' WHEN v <= 150 THEN 'danger' ELSE 'dark' END AS color FROM v"""


def scaling_sql(readings: str, features: str, names: list[str], keys: str) -> str:
    rows = " UNION ALL ".join(f"SELECT {i} AS i, '{c}' AS feature, round(m_{c}, 6) AS mean, round(s_{c}, 6) AS std FROM st" for i, c in enumerate(names))
    return f"WITH RECURSIVE {readings}, {model_ctes(features, names, keys, ())} {rows}"
