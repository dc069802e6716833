"""Cleaning, parsing and shaping operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Live message: 4 strings (timestamp as text) and 8 doubles, all nullable.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("province", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("pm2_5", T.DoubleType()),
    T.StructField("pm10", T.DoubleType()),
    T.StructField("o3", T.DoubleType()),
    T.StructField("no2", T.DoubleType()),
    T.StructField("so2", T.DoubleType()),
    T.StructField("co", T.DoubleType()),
])


def parse_json(df: DataFrame, value_col: str = "value", schema=MESSAGE_SCHEMA,
               keep_raw: bool = False) -> DataFrame:
    """Bytes or text -> struct -> flat columns.

    Malformed text gives NULL fields; with ``keep_raw`` the text is kept in
    ``_raw`` so bad records can be quarantined instead of silently lost."""
    txt = F.col(value_col).cast("string")
    parsed = df.select(F.from_json(txt, schema).alias("d"), txt.alias("_raw"))
    out = parsed.select("d.*", "_raw")
    return out if keep_raw else out.drop("_raw")


def split_malformed(msgs: DataFrame, value_col: str = "value", schema=MESSAGE_SCHEMA):
    """P1 with quarantine: (parsed rows, bad rows with their text ``raw``).
    A message is bad when it is no complete JSON object; NULL fields are fine."""
    txt = F.col(value_col).cast("string")
    bad = F.try_parse_json(txt).isNull() | ~F.coalesce(txt.startswith("{"), F.lit(False))
    return parse_json(msgs.filter(~bad), value_col, schema), msgs.filter(bad).select(txt.alias("raw"))


def infer_schema(msgs: DataFrame, value_col: str = "value", fraction: float = 1.0, seed: int = 0) -> T.StructType:
    """JSON schema merged from every message (one aggregate; only the
    schema leaves the executors), so a field first seen in the last message
    is in it and a field that is NULL in one message gets its type from the
    others.  ``fraction`` < 1 samples the messages, and says so.  Numbers with
    a fraction are doubles; a field that is NULL everywhere is a string."""
    if fraction < 1.0:
        msgs = msgs.sample(fraction, seed)
    v = F.try_parse_json(F.col(value_col).cast("string"))
    text = msgs.agg(F.schema_of_variant_agg(v).alias("s")).first()["s"]
    if not text or not text.startswith("OBJECT<"):
        return T.StructType()
    ddl = re.sub(r"\bDECIMAL\(\d+,\s*\d+\)", "DOUBLE", text.replace("OBJECT<", "STRUCT<"))
    return T.StructType.fromDDL(re.sub(r"\bVOID\b|\bVARIANT\b", "STRING", ddl))


def parse_event_time(df: DataFrame, src: str = "timestamp", out: str = "event_time") -> DataFrame:
    """Text -> TIMESTAMP_NTZ; bad text becomes NULL (try_cast) and such
    rows are dropped, which a plain cast would turn into a job failure."""
    return (df.withColumn(out, F.col(src).try_cast("timestamp_ntz"))
            .filter(F.col(out).isNotNull()))


def normalize_name(name: str) -> str:
    """P5: the words of a heading outside its '(unit)' brackets, lower-case,
    joined by '_'; runs of blanks count once."""
    outside, depth = [], 0
    for ch in name:
        depth += ch == "("
        if not depth:
            outside.append(ch)
        depth -= ch == ")" and depth > 0
    return "_".join("".join(outside).lower().split())


def normalize_columns(df: DataFrame) -> DataFrame:
    """P5 for all columns; two headings that end up with one name are an error."""
    names = [normalize_name(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"several columns would be named {twice}")
    return df.toDF(*names)


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """Projection with aliases (names may hold units and spaces)."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in mapping.items()])


def is_missing(c) -> Column:
    """NULL or NaN (``isnan`` alone lets NULLs through)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | F.isnan(c)


def present(c) -> Column:
    """The value as a double, with NaN turned into NULL: averages, sums and
    windows then skip NaN as they skip NULL."""
    c = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(~F.isnan(c), c)


def not_nan(df: DataFrame, cols) -> DataFrame:
    """P8 as written in the warehouse job: NaN rejected, NULL kept."""
    cond = None
    for c in cols:
        x = ~F.isnan(F.col(c))
        cond = x if cond is None else cond & x
    return df.filter(cond)


def time_between(df: DataFrame, start, end, ts: str = "event_time") -> DataFrame:
    """Inclusive time-range filter (pushed to the scan when on a source)."""
    return df.filter(F.col(ts).between(start, end))


def align_time_range(a: DataFrame, b: DataFrame, ts: str = "ep"):
    """P10: cut both tables to [max of the minima, min of the maxima].

    The bounds come from ONE small aggregate over both tables (per-table
    min/max, then max of minima / min of maxima) used as a single scalar
    subquery: no join, no collect to the driver.  Before an inner equi-join
    on ``ts`` the cut changes nothing, so joins can skip it."""
    u = (a.select(F.lit(0).alias("__t"), F.col(ts).alias("__v"))
         .unionByName(b.select(F.lit(1).alias("__t"), F.col(ts).alias("__v"))))
    per = u.groupBy("__t").agg(F.min("__v").alias("lo"), F.max("__v").alias("hi"))
    bounds = per.agg(F.struct(F.max("lo").alias("lo"), F.min("hi").alias("hi"))).scalar()

    def cut(df):
        return (df.withColumn("__b", bounds)
                .filter(F.col(ts).between(F.col("__b.lo"), F.col("__b.hi"))).drop("__b"))
    return cut(a), cut(b)


def clip(c, lo: float, hi: float) -> Column:
    """Clamp into [lo, hi]."""
    c = F.col(c) if isinstance(c, str) else c
    return F.greatest(F.lit(lo), F.least(F.lit(hi), c))


def message_key(province="province", district="district") -> Column:
    """Kafka key text 'province_district'."""
    return F.concat_ws("_", F.col(province), F.col(district))


def encode_messages(df: DataFrame, cols=None) -> DataFrame:
    """(key bytes, value bytes) with JSON that keeps NULL fields and
    non-ASCII text as is."""
    cols = cols or df.columns
    value = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    return df.select(message_key().cast("binary").alias("key"), value.cast("binary").alias("value"))


# ---------------------------------------------------------------------------
# API payload: struct of parallel hourly arrays
# ---------------------------------------------------------------------------

PAYLOAD_FIELDS = ["pm2_5", "pm10", "ozone", "nitrogen_dioxide", "sulphur_dioxide", "carbon_monoxide"]


def explode_payload(payload: DataFrame, keep=("city_name", "district")) -> DataFrame:
    """One row per hour from ``hourly`` (time + one array per field);
    ``hourly_units`` is kept as a map for unit lookups."""
    h = payload.select(*keep, F.col("hourly_units"),
                       F.inline(F.arrays_zip(*[F.col(f"hourly.{f}").alias(f)
                                               for f in ["time", *PAYLOAD_FIELDS]])))
    return h


def current_hour_pick(payload: DataFrame, now_text: Column, keep=("city_name", "district")) -> DataFrame:
    """Element of the current hour, else the middle one (len // 2)."""
    times = F.col("hourly.time")
    pos = F.array_position(times, now_text)  # 1-based, 0 when absent
    idx = F.when(pos > 0, pos - 1).otherwise(F.greatest(F.lit(0), F.floor(F.size(times) / 2)))
    # the index is computed once per row (``now_text`` may be a subquery)
    p = payload.withColumn("__i", idx.cast("int"))
    return p.select(*keep, F.get(times, F.col("__i")).alias("timestamp"),
                    *[F.get(F.col(f"hourly.{f}"), F.col("__i")).alias(f) for f in PAYLOAD_FIELDS])


def split_periods(df: DataFrame, start: str = "start_ts", end: str = "end_ts", pieces_per_year: int = 48) -> DataFrame:
    """[start, end] -> n = 48 x (years spanned) equal pieces.

    The piece length is rounded half-even to a microsecond; piece i spans
    [start + i*d, start + (i+1)*d).  Output in epoch microseconds."""
    years = F.abs(F.year(end) - F.year(start)) + 1
    n = (F.lit(pieces_per_year) * years).cast("long")
    s_us, e_us = ntz_micros(F.col(start)), ntz_micros(F.col(end))
    d = F.bround((e_us - s_us).cast("double") / n, 0).cast("long")
    return (df.withColumns({"__n": n, "__s": s_us, "__d": d})
            .select("*", F.posexplode(F.sequence(F.lit(0), (F.col("__n") - 1).cast("int"))).alias("__p", "piece"))
            .withColumn("begin_us", F.col("__s") + F.col("piece") * F.col("__d"))
            .withColumn("finish_us", F.col("begin_us") + F.col("__d"))
            .drop("__n", "__s", "__d", "__p"))


def ntz_micros(c: Column) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ, read from the
    wall-clock fields (independent of the session time zone)."""
    days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    secs = F.extract(F.lit("SECOND"), c)  # seconds with fraction, DECIMAL(8,6)
    return ((days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60) * 1_000_000
            + (secs * 1_000_000).cast("long"))


def future_hours(last_ts: Column, hours: int = 24) -> Column:
    """the next ``hours`` whole hours after ``last_ts``."""
    return F.sequence(last_ts + F.expr("INTERVAL 1 HOUR"), last_ts + F.expr(f"INTERVAL {hours} HOURS"),
                      F.expr("INTERVAL 1 HOUR"))
