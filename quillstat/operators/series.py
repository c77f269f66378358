"""Time series and live-table operators, batch form.

Order is always explicit: ``order`` columns must form a total order inside
a series (append a unique key).  ``now`` is a parameter, never the wall clock,
so results are deterministic.  Order-dependent frames run on bounded chunks
(``with_positions`` + halo rows) so one long series never lands in one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.kernels import chunked_frame, finish_chunked, lay_out, previous_values

DEFAULT_CHUNK = 1_000_000


def _ts(now) -> Column:
    """``now`` as a TIMESTAMP_NTZ literal built from text (independent of any time zone)."""
    if isinstance(now, Column):
        return now
    if isinstance(now, dt.datetime):
        now = now.isoformat(sep=" ")
    return F.lit(str(now)).cast("timestamp_ntz")


# T1 -------------------------------------------------------------------------
def trailing_window(df: DataFrame, ts: str, now, last_seconds: float) -> DataFrame:
    """Rows with ts >= now - last_seconds."""
    start = _ts(now) - F.make_dt_interval(secs=F.lit(float(last_seconds)))
    return df.where(F.col(ts) >= start)


# T4 -------------------------------------------------------------------------
def last_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows by ``order`` (TakeOrdered, bounded), returned ascending."""
    desc = [F.col(c).desc() for c in order]
    return df.orderBy(*desc).limit(n).orderBy(*order)


# T2 -------------------------------------------------------------------------
def window_or_fallback(df: DataFrame, ts: str, now, last_seconds: float, limit: int, order: Sequence[str]) -> DataFrame:
    """Trailing window; if it is empty, the last ``limit`` rows instead (then the last ``limit`` of either).

    The emptiness test is one scalar count; the chosen branch stays a plain lazy plan.
    """
    win = trailing_window(df, ts, now, last_seconds)
    chosen = win if win.limit(1).count() > 0 else df
    return last_n(chosen, order, limit)


# T3 / T6 --------------------------------------------------------------------
def since(df: DataFrame, tcol: str, since_t: float) -> DataFrame:
    return df.where(F.col(tcol) >= F.lit(since_t))


def slice_chronological(df: DataFrame, ts: str, start=None, end=None, last: int | None = None,
                        order: Sequence[str] | None = None) -> DataFrame:
    out = df
    if start is not None:
        out = out.where(F.col(ts) >= _ts(start))
    if end is not None:
        out = out.where(F.col(ts) <= _ts(end))
    if last is not None:
        out = last_n(out, order or [ts], last)
    return out


# T5 -------------------------------------------------------------------------
def fix_future_clock(df: DataFrame, ts: str, now) -> DataFrame:
    """Correct a producer clock that runs ahead of ``now``.

    ahead = max(ts) - now.  ahead > 1 day: set every year to now's year
    (29 Feb in a common year -> NULL for that row), then if still ahead,
    shift back by the remaining excess.  0 < ahead <= 1 day: shift back by it.
    The maxima are scalar aggregations; the correction is a per-row expression.
    """
    now_dt = dt.datetime.fromisoformat(now) if isinstance(now, str) else now
    nowc = _ts(now_dt)
    mx1 = df.agg(F.max(ts)).first()[0]
    if mx1 is None or mx1 <= now_dt:
        return df
    t1 = _replace_year(F.col(ts), F.year(nowc)) if mx1 > now_dt + dt.timedelta(days=1) else F.col(ts)
    mx2 = df.select(t1.alias("_t1")).agg(F.max("_t1")).first()[0] if mx1 > now_dt + dt.timedelta(days=1) else mx1
    if mx2 is not None and mx2 > now_dt:
        excess = mx2 - now_dt
        t1 = t1 - F.make_dt_interval(days=F.lit(excess.days), secs=F.lit(excess.seconds + excess.microseconds / 1e6))
    return df.withColumn(ts, t1)


def _replace_year(t: Column, year: Column) -> Column:
    """Same month/day/time in another year; an impossible date (29 Feb) -> NULL."""
    secs = F.date_part(F.lit("SECOND"), t)  # seconds with fraction
    return F.try_make_timestamp_ntz(year, F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), secs)


# T7 -------------------------------------------------------------------------
def find_peaks(df: DataFrame, value: str, order: Sequence[str], keys: Sequence[str] = (), width: int = 1,
               chunk_rows: int = DEFAULT_CHUNK) -> DataFrame:
    """Local peaks: rows not within ``width`` of either end of their series whose value equals the
    max of the 2*width+1 window and exceeds the mean of the other 2*width values.

    A NULL inside the window disqualifies (count must be full).  Plateau rows
    all count; constant windows do not.  Evaluated on bounded chunks with halo rows.
    """
    ch, part, ordc = chunked_frame(df, keys, order, width, chunk_rows)
    w = Window.partitionBy(*part).orderBy(*ordc).rowsBetween(-width, width)
    v = F.col(value)
    flagged = finish_chunked(
        ch.withColumn("_mx", F.max(v).over(w))
        .withColumn("_sm", F.sum(v).over(w))
        .withColumn("_ct", F.count(v).over(w))
        .withColumn("_rows", F.count(F.lit(1)).over(w)))
    k = 2 * width
    is_peak = (
        (F.col("_rows") == k + 1)
        & (F.col("_ct") == k + 1)
        & (v == F.col("_mx"))
        & (v > (F.col("_sm") - v) / F.lit(float(k)))
    )
    return flagged.where(is_peak).drop("_mx", "_sm", "_ct", "_rows")


# R13 ------------------------------------------------------------------------
def durbin_watson(df: DataFrame, resid: str, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """sum((e_t - e_{t-1})^2) / sum(e_t^2) per key, with verdict (1.5 <= dw <= 2.5 -> 'no autocorrelation')."""
    keys = list(keys)
    d = previous_values(lay_out(df, keys, order), keys, {"_prev": resid})
    agg = d.groupBy(*keys).agg(
        F.sum(F.pow(F.col(resid) - F.col("_prev"), 2)).alias("_num"),
        F.sum(F.pow(F.col(resid), 2)).alias("_den"),
    )
    dw = F.col("_num") / F.nullif(F.col("_den"), F.lit(0.0))
    return agg.select(*keys, dw.alias("dw")).withColumn(
        "verdict", F.when(F.col("dw").between(1.5, 2.5), F.lit("no autocorrelation"))
        .when(F.col("dw") < 1.5, F.lit("positive autocorrelation")).otherwise(F.lit("negative autocorrelation")))
