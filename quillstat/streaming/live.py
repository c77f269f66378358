"""Structured Streaming forms of the live operators.

* ``live_stream``         file source with a fixed schema (new files = new data).
* ``window_stats``        per-window live statistics with a watermark.
* ``stream_peaks``        local peaks of each series, in event-time order.
* ``stream_quota``        sequential admission in event-time order.
* ``hourly_cost_windows`` sliding 1-hour cost sums with the alert flag.

Peaks and admission stand on ``event_time.in_event_order``: rows wait in keyed state
until the watermark has passed them; timers wake waiting keys and drop idle ones.

Checkpoint locations default to ``spark.checkpoint.dir``/<name> (shared folder).
"""

from __future__ import annotations

import functools
import os
from collections import deque
from collections.abc import Sequence
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .event_time import BUCKETS, MICROS, in_event_order, missing


def checkpoint_location(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "streams", name)


def live_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _event_time(stream: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP; NTZ event times are cast (inverse cast on output)."""
    if isinstance(stream.schema[ts].dataType, T.TimestampNTZType):
        return stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return stream


def window_stats(stream: DataFrame, ts: str, values: Sequence[str], window: str = "1 minute",
                 watermark: str = "10 minutes", keys: Sequence[str] = ()) -> DataFrame:
    """count / mean / sample std / min / max per event-time window (late rows past the watermark dropped)."""
    ntz = isinstance(stream.schema[ts].dataType, T.TimestampNTZType)
    stream = _event_time(stream, ts)
    out_t = "timestamp_ntz" if ntz else "timestamp"
    aggs = [F.count(F.lit(1)).alias("n")]
    for v in values:
        aggs += [F.avg(v).alias(f"mean_{v}"), F.stddev_samp(v).alias(f"std_{v}"),
                 F.min(v).alias(f"min_{v}"), F.max(v).alias(f"max_{v}")]
    return (stream.withWatermark(ts, watermark).groupBy(F.window(ts, window), *keys).agg(*aggs)
            .select(F.col("window.start").cast(out_t).alias("window_start"),
                    F.col("window.end").cast(out_t).alias("window_end"), *keys,
                    *[a for a in ["n"] + [f"{p}_{v}" for v in values for p in ("mean", "std", "min", "max")]]))


# --------------------------------------------------------------------------- peaks with state

def _peaks(value: str, width: int):
    k = 2 * width

    def process(rows: pd.DataFrame, series: np.ndarray, fresh: np.ndarray):
        at = np.arange(len(rows))
        before, after = at - np.searchsorted(series, series), np.searchsorted(series, series, "right") - at
        values, known = rows[value].to_numpy(), ~missing(rows, value)
        centre = at[(before >= width) & (after > width)]  # the last row carried is the first centre's left neighbour
        centre = centre[np.logical_and.reduce([known[centre + o] for o in range(-width, width + 1)])]
        top = functools.reduce(np.maximum, [values[centre + o] for o in range(-width, width + 1)])
        v = values.tolist()
        hits = [i for i in centre[values[centre] == top].tolist() if v[i] > (sum(v[i - width:i + width + 1]) - v[i]) / k]
        return rows.iloc[hits], after <= k

    return process


def stream_peaks(stream: DataFrame, keys: Sequence[str], ts: str, tie: str, value: str, width: int = 1,
                 delay: str = "1 hour", idle: timedelta | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Streaming local peaks (same rule as the batch ``find_peaks``) per series key.

    Output (keys, tie, value, ts) of each peak, once the watermark has passed its window: rows may come in any
    order within ``delay``.  The state of a series is its rows within the delay and the last 2*width before;
    with ``idle`` a series that is silent for that long is dropped and starts anew.
    """
    return in_event_order(stream, keys, ts, tie, delay, _peaks(value, width), keep=[tie, value], idle=idle, buckets=buckets)


# --------------------------------------------------------------------------- quota with state

def _admission(max_calls: int, horizon_us: int):
    def process(rows: pd.DataFrame, series: np.ndarray, fresh: np.ndarray):
        flags, key, recent = [], None, deque()
        for s, us, new in zip(series.tolist(), rows[MICROS].tolist(), fresh.tolist()):
            if s != key:
                key, recent = s, deque(maxlen=max(max_calls, 0))  # the last times admitted
            flags.append(not new or max_calls > 0 and (len(recent) < max_calls or us - recent[0] >= horizon_us))
            if flags[-1]:
                recent.append(us)
        admitted = np.array(flags, dtype=bool)
        at = np.flatnonzero(admitted)
        later = np.searchsorted(series[at], series[at], "right") - np.arange(len(at))
        carry = np.zeros(len(rows), dtype=bool)
        carry[at[later <= max_calls]] = True
        return rows.assign(admitted=admitted)[fresh], carry

    return process


def stream_quota(stream: DataFrame, keys: Sequence[str], ts: str, tie: str, max_calls: int,
                 horizon_s: float = 3600.0, delay: str = "1 hour", buckets: int = BUCKETS) -> DataFrame:
    """Streaming admission (same rule as the batch ``quota_admission``), in event-time order within ``delay``.

    State: the calls within the delay and the last ``max_calls`` admitted ones of a key; a key without admitted calls
    for a horizon has nothing to remember and is dropped.
    """
    horizon = timedelta(seconds=horizon_s)
    added = T.StructType([T.StructField("admitted", T.BooleanType())])
    process = _admission(max_calls, horizon // timedelta(microseconds=1))
    return in_event_order(stream, keys, ts, tie, delay, process, added, idle=horizon, buckets=buckets)


# --------------------------------------------------------------------------- cost alert

def hourly_cost_windows(stream: DataFrame, ts: str, cost: str, threshold: float, slide: str = "5 minutes",
                        watermark: str = "1 hour") -> DataFrame:
    """Sliding 1-hour windows of summed cost with count and the alert flag (webhook not built)."""
    stream = _event_time(stream, ts)
    return (stream.withWatermark(ts, watermark).groupBy(F.window(ts, "1 hour", slide))
            .agg(F.sum(cost).alias("cost_last_hour"), F.count(F.lit(1)).alias("count_last_hour"))
            .withColumn("alert", F.col("cost_last_hour") >= F.lit(threshold)))
