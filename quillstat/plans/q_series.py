"""Catalog: time series and live-table operators (T*, R13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import series as T
from .catalog import register, table
from .q_charts import _FIT, LI_ORDER, LI_ORDER_SQL, _scored_lineitem

NOW = "2024-01-31 00:00:00"
ORDER = ["ts", "event_id"]


@register("t_trailing_window", f"""SELECT event_id, ts, value FROM events
WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 172800 SECOND""", ops=("T1",))
def t_trailing_window(spark, sf):
    return T.trailing_window(table(spark, sf, "events"), "ts", NOW, 172800).select("event_id", "ts", "value")


def _fallback_sql(now, secs, limit):
    return f"""WITH w AS (SELECT * FROM events WHERE ts >= TIMESTAMP '{now}' - INTERVAL {secs} SECOND),
c AS (SELECT count(*) AS n FROM w),
chosen AS (SELECT * FROM w WHERE (SELECT n FROM c) > 0
           UNION ALL
           SELECT * FROM (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT {limit}) WHERE (SELECT n FROM c) = 0)
SELECT event_id, ts, value FROM chosen ORDER BY ts DESC, event_id DESC LIMIT {limit}"""


@register("t_window_fallback_hit", _fallback_sql(NOW, 172800, 500), ops=("T2", "T4"))
def t_window_fallback_hit(spark, sf):
    return T.window_or_fallback(table(spark, sf, "events"), "ts", NOW, 172800, 500, ORDER).select("event_id", "ts", "value")


@register("t_window_fallback_empty", _fallback_sql("2025-06-01 00:00:00", 3600, 500), ops=("T2", "T4"))
def t_window_fallback_empty(spark, sf):
    ev = table(spark, sf, "events")
    return T.window_or_fallback(ev, "ts", "2025-06-01 00:00:00", 3600, 500, ORDER).select("event_id", "ts", "value")


@register("t_since", "SELECT event_id, ts, value FROM events WHERE event_id >= 5000", ops=("T3",))
def t_since(spark, sf):
    return T.since(table(spark, sf, "events"), "event_id", 5000).select("event_id", "ts", "value")


@register("t_last_n", "SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 100", ops=("T4", "S3"))
def t_last_n(spark, sf):
    return T.last_n(table(spark, sf, "events"), ORDER, 100).select("event_id", "ts", "value")


@register("t_slice", """SELECT event_id, ts, value FROM (SELECT * FROM events
  WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-12 00:00:00'
  ORDER BY ts DESC, event_id DESC LIMIT 50)""", ops=("T6",))
def t_slice(spark, sf):
    s = T.slice_chronological(table(spark, sf, "events"), "ts", "2024-01-10 00:00:00", "2024-01-12 00:00:00", 50, ORDER)
    return s.select("event_id", "ts", "value")


def _clock_sql(now):
    return f"""WITH a AS (SELECT event_id, ts, max(ts) OVER () AS mx1 FROM events),
b AS (SELECT event_id, CASE WHEN mx1 > TIMESTAMP '{now}' + INTERVAL 1 DAY
                            THEN ts + to_years(year(TIMESTAMP '{now}') - year(ts)) ELSE ts END AS t1 FROM a),
c AS (SELECT event_id, t1, max(t1) OVER () AS mx2 FROM b)
SELECT event_id, CASE WHEN mx2 > TIMESTAMP '{now}' THEN t1 - (mx2 - TIMESTAMP '{now}') ELSE t1 END AS ts FROM c"""


@register("t_clock_fix_year", _clock_sql("2023-06-15 12:00:00"), ops=("T5",))
def t_clock_fix_year(spark, sf):
    return T.fix_future_clock(table(spark, sf, "events"), "ts", "2023-06-15 12:00:00").select("event_id", "ts")


@register("t_clock_fix_shift", _clock_sql("2024-01-30 12:00:00"), ops=("T5",))
def t_clock_fix_shift(spark, sf):
    return T.fix_future_clock(table(spark, sf, "events"), "ts", "2024-01-30 12:00:00").select("event_id", "ts")


def _peaks_sql(width, partition):
    part = f"PARTITION BY {partition} " if partition else ""
    return f"""SELECT event_id, user_id, ts, value FROM (
  SELECT *, max(value) OVER w AS mx, sum(value) OVER w AS sm, count(value) OVER w AS ct, count(*) OVER w AS rws
  FROM events WINDOW w AS ({part}ORDER BY ts, event_id ROWS BETWEEN {width} PRECEDING AND {width} FOLLOWING))
WHERE rws = {2 * width + 1} AND ct = {2 * width + 1} AND value = mx AND value > (sm - value) / {2 * width}.0"""


@register("t_peaks", _peaks_sql(1, "user_id"), ops=("T7",))
def t_peaks(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return T.find_peaks(ev, "value", ORDER, keys=["user_id"], width=1)


@register("t_peaks_w2", _peaks_sql(2, "user_id"), ops=("T7",))
def t_peaks_w2(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return T.find_peaks(ev, "value", ORDER, keys=["user_id"], width=2)


@register("t_peaks_single_series", _peaks_sql(1, None), ops=("T7",))
def t_peaks_single_series(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return T.find_peaks(ev, "value", ORDER, keys=[], width=1)


@register("r_durbin_watson", f"""SELECT round(sum(power(e - prev, 2)) / sum(power(e, 2)), 8) AS dw,
       CASE WHEN sum(power(e - prev, 2)) / sum(power(e, 2)) BETWEEN 1.5 AND 2.5 THEN 'no autocorrelation'
            WHEN sum(power(e - prev, 2)) / sum(power(e, 2)) < 1.5 THEN 'positive autocorrelation'
            ELSE 'negative autocorrelation' END AS verdict
FROM (SELECT e, lag(e) OVER (ORDER BY {LI_ORDER_SQL}) AS prev
      FROM (SELECT {LI_ORDER_SQL}, l_extendedprice - (intercept + slope * l_quantity) AS e FROM lineitem, {_FIT}))""",
          ops=("R13",))
def r_durbin_watson(spark, sf):
    r = _scored_lineitem(spark, sf).withColumn("e", F.col("l_extendedprice") - F.col("pred"))
    d = T.durbin_watson(r.select(*LI_ORDER, "e"), "e", LI_ORDER)
    return d.select(F.round("dw", 8).alias("dw"), "verdict")
