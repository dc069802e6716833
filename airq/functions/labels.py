"""AQI labels (category, colour, advice, UI level) as ``when`` chains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES -- label texts and colours of the published scales.
# Upper bounds are inclusive; the first entry of each scale is the label for
# a missing or non-positive index.
# ---------------------------------------------------------------------------
LEVEL_UPPER = [50, 100, 150, 200, 300]

VN_CATEGORY = ["Không xác định", "Tốt", "Trung bình", "Kém", "Xấu", "Rất xấu", "Nguy hại"]

VN_COLOR = ["#CCCCCC", "#00E400", "#FFFF00", "#FF7E00", "#FF0000", "#8F3F97", "#7E0023"]

VN_ADVICE = [
    "Không có dữ liệu",
    "Chất lượng không khí tốt. Tự do hoạt động ngoài trời.",
    "Chấp nhận được. Người nhạy cảm nên theo dõi triệu chứng.",
    "Người nhạy cảm nên giảm hoạt động ngoài trời.",
    "Mọi người nên giảm hoạt động ngoài trời, đeo khẩu trang.",
    "Hạn chế tối đa hoạt động ngoài trời. Đeo khẩu trang khi ra ngoài.",
    "Ở trong nhà, đóng cửa sổ. Bắt buộc đeo khẩu trang nếu ra ngoài.",
]

EPA_CATEGORY = ["Unknown", "Good", "Moderate", "Unhealthy for Sensitive Groups",
                "Unhealthy", "Very Unhealthy", "Hazardous"]

# RGB triples of the six levels (0-50 .. 301-500).
VN_RGB = ["0;228;0", "255;255;0", "255;126;0", "255;0;0", "143;63;151", "126;0;35"]

# Forecast page: 4 levels with a style tag; no "unknown" level.
UI_LEVEL_UPPER = [50, 100, 150]
UI_LEVEL = [("Tốt", "success"), ("Trung bình", "warning"), ("Kém", "danger"), ("Nguy hiểm", "dark")]
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _scale(aqi, labels) -> Column:
    a = _col(aqi)
    expr = F.when(a.isNull() | (a <= 0), F.lit(labels[0]))
    for upper, label in zip(LEVEL_UPPER, labels[1:]):
        expr = expr.when(a <= upper, F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def vn_category(aqi) -> Column:
    return _scale(aqi, VN_CATEGORY)


def vn_color(aqi) -> Column:
    return _scale(aqi, VN_COLOR)


def health_advice(aqi) -> Column:
    return _scale(aqi, VN_ADVICE)


def epa_category(aqi) -> Column:
    return _scale(aqi, EPA_CATEGORY)


def vn_rgb(aqi) -> Column:
    """RGB triple of the level; NULL for a missing index."""
    a = _col(aqi)
    expr = F.when(a.isNull(), F.lit(None).cast("string"))
    for upper, rgb in zip(LEVEL_UPPER, VN_RGB):
        expr = expr.when(a <= upper, F.lit(rgb))
    return expr.otherwise(F.lit(VN_RGB[-1]))


def ui_level(aqi) -> Column:
    """(level, style) struct of the forecast page."""
    a = _col(aqi)
    expr = None
    for upper, (lvl, style) in zip(UI_LEVEL_UPPER, UI_LEVEL):
        val = F.struct(F.lit(lvl).alias("level"), F.lit(style).alias("color"))
        expr = F.when(a <= upper, val) if expr is None else expr.when(a <= upper, val)
    lvl, style = UI_LEVEL[-1]
    return expr.otherwise(F.struct(F.lit(lvl).alias("level"), F.lit(style).alias("color")))


def dominant_pollutant(named: dict) -> Column:
    """Name of the pollutant whose sub-index is the overall index.

    ``named`` maps pollutant name -> sub-index column, in tie-break order
    (the first listed wins a tie).  NULL when every sub-index is NULL.
    """
    items = list(named.items())
    structs = [F.struct(_col(c).alias("v"), F.lit(-i).alias("o"), F.lit(n).alias("n"))
               for i, (n, c) in enumerate(items)]
    arr = F.filter(F.array(*structs), lambda s: s["v"].isNotNull())
    return F.when(F.size(arr) > 0, F.array_max(arr)["n"])


def _sql_scale(x: str, labels, upper=LEVEL_UPPER) -> str:
    def q(s):
        return "'" + s.replace("'", "''") + "'"
    parts = [f"WHEN {x} IS NULL OR {x} <= 0 THEN {q(labels[0])}"]
    parts += [f"WHEN {x} <= {u} THEN {q(lab)}" for u, lab in zip(upper, labels[1:])]
    return f"(CASE {' '.join(parts)} ELSE {q(labels[-1])} END)"


def vn_category_sql(x: str) -> str:
    return _sql_scale(x, VN_CATEGORY)


def vn_color_sql(x: str) -> str:
    return _sql_scale(x, VN_COLOR)


def health_advice_sql(x: str) -> str:
    return _sql_scale(x, VN_ADVICE)


def epa_category_sql(x: str) -> str:
    return _sql_scale(x, EPA_CATEGORY)
