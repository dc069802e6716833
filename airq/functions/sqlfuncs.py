"""The rule set as SQL functions (``CREATE TEMPORARY FUNCTION ...
RETURN <expr>``).  Spark inlines SQL functions into the plan, so calls from
SQL stay in codegen with no Python worker."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .labels import epa_category_sql, health_advice_sql, vn_category_sql, vn_color_sql
from .profiles import PROFILES
from .subindex import sub_index_sql


def definitions() -> dict:
    """function name -> (argument, return type, body)."""
    defs = {}
    for prof, short in (("vn_stream", "vn"), ("epa_stepped", "epa")):
        rtype = "INT" if PROFILES[prof].rounding == "int" else "DOUBLE"
        for pol in PROFILES[prof].pollutants:
            name = f"airq_{short}_{pol.replace('_1h', '').replace('_8h', '8h')}"
            defs[name] = ("c DOUBLE", rtype, sub_index_sql("c", pol, prof))
    defs["airq_epa_pm25_cont"] = ("c DOUBLE", "DOUBLE", sub_index_sql("c", "pm25", "epa_pm25"))
    defs["airq_vn_category"] = ("a INT", "STRING", vn_category_sql("a"))
    defs["airq_vn_color"] = ("a INT", "STRING", vn_color_sql("a"))
    defs["airq_health_advice"] = ("a INT", "STRING", health_advice_sql("a"))
    defs["airq_epa_category"] = ("a INT", "STRING", epa_category_sql("a"))
    return defs


def register(spark: SparkSession) -> list:
    names = []
    for name, (arg, rtype, body) in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arg}) RETURNS {rtype} RETURN {body}")
        names.append(name)
    return names
