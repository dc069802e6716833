"""Keyed streaming state per station: the 12-hour NowCast (T6) and daily indices (A5).

**NowCast.**  A station's state is a ring of its newest 12 hours, whatever the length of
the stream: one state row per station.  A reading of the newest hour or a newer one is
scored from the ring.  An older reading changes hours whose windows the ring may no longer
hold; these hours are scored again from the table that the stream upserts into, so the
table equals the batch NowCast whatever the order of the messages, and none is too late.
The state function only gathers the window; the rule itself is the batch one, an expression.

**Daily indices.**  A station's state is its readings of days that the watermark hasn't
closed, the 7 ozone rows before them and the last closed day.  Open days are sent again
when they change, closed days once and for good, with the days without readings
between them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators import clean as C
from ..operators import daily as D
from ..operators.rolling import nowcast_12h, nowcast_12h_expr
from ..sources.adapter import POLLUTANT_COLS, STATION_KEY, epoch_hour
from .upserts import UpsertTable

HOURS = 12
IDLE_MS = 30 * 24 * 3600 * 1000     # for live streams: a station silent for so long (by the clock) loses its ring

RING_STATE = "newest long, hours array<long>, vals array<double>"
RING_OUT = "province string, district string, ep long, value double, hours array<long>, vals array<double>, late boolean"


def _ring_update(idle: int | None):
    """The state function of `ring_stream` (made here, it travels to the workers by value)."""
    span = HOURS

    def update(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        got = {}
        for pdf in frames:
            for e, v in zip(pdf["ep"].tolist(), pdf["value"].tolist()):
                v = None if v is None or v != v else v
                old = got.get(e)
                got[e] = v if old is None else old if v is None else max(old, v)    # of several readings of an hour the largest counts
        before, known = None, {}
        if state.exists:
            before, hours, vals = state.get
            known = {e: None if v is None or v != v else v for e, v in zip(hours, vals)}
        for e, v in got.items():
            old = known.get(e)
            known[e] = v if old is None else old if v is None else max(old, v)
        rows = []
        for t in sorted({t for e in got for t in range(e, e + span) if t in known and (before is None or t >= before)}):
            w = [(e, known[e]) for e in range(t, t - span, -1) if known.get(e) is not None]
            rows.append((*key, t, known[t], [e for e, _ in w], [v for _, v in w], False))
        if before is not None:
            rows += [(*key, e, v, [], [], True) for e, v in got.items() if e < before]
        newest = max(known)
        ring = [e for e in sorted(known) if e > newest - span]
        state.update((newest, ring, [known[e] for e in ring]))
        if idle:
            state.setTimeoutDuration(idle)
        if rows:
            yield pd.DataFrame(rows, columns=["province", "district", "ep", "value", "hours", "vals", "late"])

    return update


def ring_stream(msgs: DataFrame, src: str = "pm2_5", idle_ms: int | None = None) -> DataFrame:
    """Windows to score: the newest hours of every station with their last 12 hours
    (newest first), and the readings that came late (``late``).

    ``idle_ms`` (`IDLE_MS` in a live stream) sets a timer per station that drops the ring of
    one that has gone silent.  A bounded replay has none: Spark runs empty
    batches as long as clock timers may fire, so it would never end."""
    df = C.parse_event_time(msgs).select(*STATION_KEY, epoch_hour("event_time").alias("ep"), C.present(src).alias("value"))
    return df.groupBy(*STATION_KEY).applyInPandasWithState(
        _ring_update(idle_ms), RING_OUT, RING_STATE, "update", GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout)


def nowcast_sink(table: UpsertTable):
    """foreachBatch function: scores the batch's windows, scores again the hours that late
    readings reach, and upserts (province, district, ep, value, nowcast)."""
    key = [*STATION_KEY, "ep"]

    def write(batch: DataFrame, batch_id: int):
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            pts = F.transform(F.arrays_zip("hours", "vals"), lambda p: F.struct(p["hours"].alias("e"), p["vals"].alias("v")))
            ready = batch.filter(~F.col("late")).withColumn("pts", pts)
            ready = ready.select(*key, "value", nowcast_12h_expr(F.col("pts"), F.col("ep")).alias("nowcast"))
            late = batch.filter("late")
            old = None if late.isEmpty() else table.read(before=batch_id)
            if old is not None:
                # hours whose windows hold a late reading, and the hours that these windows need
                changed = late.select(*STATION_KEY, F.explode(F.sequence("ep", F.col("ep") + (HOURS - 1))).alias("ep")).distinct()
                needed = changed.select(*STATION_KEY, F.explode(F.sequence(F.col("ep") - (HOURS - 1), F.col("ep"))).alias("ep")).distinct()
                seen = (old.select(*key, "value").join(needed, key, "left_semi").unionByName(batch.select(*key, "value"))
                        .groupBy(*key).agg(F.max("value").alias("value")))
                again = nowcast_12h(seen, {"value": "nowcast"}).join(changed, key, "left_semi").select(*key, "value", "nowcast")
                ready = ready.join(changed, key, "left_anti").unionByName(again)
            table.write(ready, batch_id)
        finally:
            batch.unpersist()

    return write


# --- daily indices ---------------------------------------------------------------

DAY_VALUES = ["pm25_24h", "pm10_24h", "so2_1h_max", "no2_1h_max", "co_1h_max", "o3_1h_max", "o3_8h_max"]
DAY_STATE = "closed long, tail array<double>, first long, hours array<long>, " + ", ".join(f"{c} array<double>" for c in POLLUTANT_COLS)
DAY_OUT = "province string, district string, day_no long, " + ", ".join(f"{c} double" for c in DAY_VALUES) + ", final boolean"


def _day_update():
    cols = list(POLLUTANT_COLS)
    out = ["province", "district", "day_no", *DAY_VALUES, "final"]
    hour_ms = 3600 * 1000

    def update(key, frames, state):
        closed, tail, first, opened = None, [], None, {}
        if state.exists:
            closed, tail, first, hours, *vals = state.get
            opened = {e: {c: v[i] for c, v in zip(cols, vals)} for i, e in enumerate(hours)}
        for pdf in frames:
            for r in pdf.to_dict("records"):
                if closed is not None and r["ep"] // 24 <= closed:
                    continue        # its day is closed; the stream's watermark metrics count it
                own = opened.setdefault(r["ep"], dict.fromkeys(cols))
                for c in cols:
                    if r[c] is not None and r[c] == r[c]:
                        own[c] = r[c] if own[c] is None else max(own[c], r[c])
        rows_before = list(tail)
        hours = sorted(opened)
        first = min([h for h in (first, *hours[:1]) if h is not None], default=None)
        days, mark = {}, state.getCurrentWatermarkMs()
        for e in hours:
            o3 = opened[e]["o3"]
            window = [v for v in rows_before[-7:] + [o3] if v is not None]
            rows_before.append(o3)
            d = days.setdefault(e // 24, {c: [] for c in (*cols, "o3_8h")})
            for c in cols:
                if opened[e][c] is not None:
                    d[c].append(opened[e][c])
            if e != first:
                d["o3_8h"].append(float(round(sum(window) / 8.0)))      # half to even
        top = lambda v: max(v) if v else None
        mean = lambda v: sum(v) / len(v) if v else None
        found, previous = [], closed
        for day in sorted(days):
            d, final = days[day], (day + 1) * 24 * hour_ms <= mark
            for gap in range(previous + 1, day) if previous is not None else ():
                found.append((*key, gap, *[None] * len(DAY_VALUES), final))
            found.append((*key, day, mean(d["pm2_5"]), mean(d["pm10"]), top(d["so2"]), top(d["no2"]), top(d["co"]), top(d["o3"]), top(d["o3_8h"]), final))
            previous = day
            if final:
                closed = day
        kept = [e for e in hours if closed is None or e // 24 > closed]
        gone = len(hours) - len(kept)
        tail = (tail + [opened[e]["o3"] for e in hours[:gone]])[-7:]
        state.update((closed, tail, first, kept, *[[opened[e][c] for e in kept] for c in cols]))
        if kept:        # called again when the watermark has passed the first open day
            state.setTimeoutTimestamp(max((kept[0] // 24 + 1) * 24 * hour_ms, mark + 1))
        if found:
            yield pd.DataFrame(found, columns=out)

    return update


def daily_stream(msgs: DataFrame, delay: str = "1 day") -> DataFrame:
    """A5: daily values per station, (province, district, day_no, `DAY_VALUES`, final)."""
    df = C.parse_event_time(msgs)
    df = df.withColumn("event_ts", F.col("event_time").cast("timestamp")).withWatermark("event_ts", delay)
    df = df.select(*STATION_KEY, "event_ts", epoch_hour("event_time").alias("ep"), *[C.present(c).alias(c) for c in POLLUTANT_COLS])
    return df.groupBy(*STATION_KEY).applyInPandasWithState(_day_update(), DAY_OUT, DAY_STATE, "update", GroupStateTimeout.EventTimeTimeout)


def daily_sink(table: UpsertTable, profile: str = "vn_batch"):
    """foreachBatch function: the daily rule on the batch's days, upserted by (station, day)."""
    def write(batch: DataFrame, batch_id: int):
        day = F.date_format(F.expr("date_add(date'1970-01-01', int(day_no))"), "yyyy-MM-dd")
        newest = batch.groupBy(*STATION_KEY, "day_no").agg(F.max_by(F.struct(*DAY_VALUES, "final"), "final").alias("r")).select(*STATION_KEY, "day_no", "r.*")
        rows = D.daily_index(newest.withColumn("day", day), profile, extra=("final",))
        table.write(rows, batch_id)

    return write
