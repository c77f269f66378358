"""Keyed streams in event-time order: buffers, timers and expiry.

Micro-batches bring rows in any order.  ``in_event_order`` holds the rows of a key in
its state until the watermark has passed them, so no earlier row can come any more,
and hands them on sorted by time and tie-break.  A timer set to the earliest waiting
row wakes keys that get no new rows; one set behind the last row carried removes keys
that stay idle.  Rows older than the watermark are late and dropped by Spark before
they get here.

Keys are dealt over buckets by their hash, and a bucket is one group with one state: the
rows of its keys, packed as Arrow.  What a call costs is paid per bucket and batch, not
per key, and the work inside goes over whole columns.  A batch writes the state of each
bucket that it touches.  State is bounded by the rows within the watermark's delay, plus
the rows that the operator carries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Column of a row's event time in microseconds.
MICROS = "_us"
#: Groups that the keys of a stream are dealt over; a checkpoint is bound to the number it began with.
BUCKETS = 256

_BUCKET, _CARRIED, _NULL = "_bucket", "_carried", "_null_"

#: ``(rows by key and in order, code of each row's key, is the row new or carried) -> (output rows, rows to carry)``;
#: the carried rows of a key come before its new ones, and the rows to carry are marked true.
Process = Callable[[pd.DataFrame, np.ndarray, np.ndarray], tuple[pd.DataFrame, np.ndarray]]


def missing(rows: pd.DataFrame, column: str) -> np.ndarray:
    """NULL or NaN: pandas has no NULL among integers, they bring a column of their own for it."""
    gone = rows[column].isna().to_numpy()
    return gone | rows[_NULL + column].to_numpy(bool) if _NULL + column in rows else gone


def _pack(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(packed: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(packed).read_pandas()


def _codes(rows: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """One number per key, NULL and NaN being keys like any other."""
    codes = np.zeros(len(rows), dtype=np.int64)
    for k in keys:
        value = pd.factorize(rows[k])[0] + 1
        codes = pd.factorize((codes * (value.max() + 1) + value) * 2 + rows[_NULL + k].to_numpy(bool))[0]
    return codes


def _ranks(rows: pd.DataFrame, column: str) -> np.ndarray:
    """Numbers in the order of the column's values, missing ones first."""
    return np.where(missing(rows, column), -1, pd.factorize(rows[column], sort=True)[0])


def _timer(state: GroupState, at_ms: int) -> None:
    """A timer fires once the watermark is past it, and must be set after the watermark."""
    state.setTimeoutTimestamp(max(int(at_ms), state.getCurrentWatermarkMs() + 1))


def _handler(keys: list[str], held: list[str], whole: list[str], tie: str, process: Process, out: list[str], idle: timedelta | None):
    idle_us = idle // timedelta(microseconds=1) if idle is not None else None

    def handle(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        new = [] if state.hasTimedOut else [b[held].assign(**{_CARRIED: False}) for b in batches if len(b)]
        rows = pd.concat([*([_unpack(state.get[0])] if state.exists else []), *new], ignore_index=True)
        us, fresh, codes = rows[MICROS].to_numpy(), ~rows[_CARRIED].to_numpy(bool), _codes(rows, keys)
        mark = state.getCurrentWatermarkMs()
        waits = us > mark * 1000
        due = carry = np.flatnonzero(~waits)
        result = None
        if fresh[due].any():
            due = due[np.lexsort((_ranks(rows.iloc[due], tie), us[due], fresh[due], codes[due]))]
            result, kept = process(rows.iloc[due].reset_index(drop=True), codes[due], fresh[due])
            carry = due[kept]
        timers = [us[waits].min() // 1000] if waits.any() else []
        if idle_us is not None and len(carry):
            ends = np.full(codes.max() + 1, np.iinfo(np.int64).min)  # of a key: when it has been idle for long enough
            np.maximum.at(ends, codes[carry], (us[carry] + idle_us) // 1000 + 1)
            ends, waiting, came = ends[codes[carry]], np.isin(codes[carry], codes[waits]), np.isin(codes[carry], codes[due[fresh[due]]])
            stay = waiting | came | (ends >= mark)
            timers += ends[stay & ~waiting].tolist()
            carry = carry[stay]
        left = np.concatenate([carry, np.flatnonzero(waits)])
        if len(left):
            state.update((_pack(rows.iloc[left].assign(**{_CARRIED: np.arange(len(left)) < len(carry)})),))
            if timers:
                _timer(state, min(timers))
        elif state.exists:
            state.remove()
        if result is not None and len(result):
            numbers = {c: pd.arrays.IntegerArray(result[c].to_numpy(copy=True), missing(result, c)) for c in whole}
            yield result.assign(**numbers)[out]

    return handle


def in_event_order(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    delay: str,
    process: Process,
    added: T.StructType = T.StructType(),
    keep: Sequence[str] | None = None,
    idle: timedelta | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``process`` over the rows of each key in the order of ``(ts, tie)``.

    Rows come with the keys, the columns ``keep`` (all by default) and ``MICROS`` in place of ``ts``; what ``process``
    returns has these and ``added``.  The rows that it marks are carried to the next call.
    Rows without a time are dropped; rows later than ``delay`` behind the newest row of the stream are late.
    Without ``idle`` a key's carried rows stay for ever; with it, a key that is silent for that long in event
    time after the last of them starts anew.  Rows still within the delay wait until the stream goes on.
    More ``buckets`` make smaller states, each with its own call per batch.
    """
    keys = list(keys)
    keep = [c for c in (keep or stream.columns) if c not in keys and c != ts]
    schema = stream.schema
    time_type = schema[ts].dataType
    if not isinstance(time_type, (T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"{ts} is no timestamp")
    timed = stream.where(F.col(ts).isNotNull()).withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    whole = [c for c in (*keys, *keep) if isinstance(schema[c].dataType, T.IntegralType)]
    plain = [F.coalesce(c, F.lit(0).cast(schema[c].dataType)).alias(c) if c in whole else F.col(c) for c in (*keys, *keep)]
    nulls = [F.col(c).isNull().alias(_NULL + c) for c in dict.fromkeys([*keys, *whole])]
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)) if keys else F.lit(0)
    rows = timed.select(bucket.alias(_BUCKET), *plain, *nulls, ts, F.unix_micros(ts).alias(MICROS))
    held = [c for c in rows.columns if c not in (_BUCKET, ts)]
    out = T.StructType([*(schema[c] for c in (*keys, *keep)), T.StructField(MICROS, T.LongType()), *added.fields])
    state = T.StructType([T.StructField("rows", T.BinaryType())])
    done = rows.groupBy(_BUCKET).applyInPandasWithState(
        _handler(keys, held, whole, tie, process, out.names, idle), out, state, "append", GroupStateTimeout.EventTimeTimeout
    )
    back = F.timestamp_micros(MICROS).cast(time_type).alias(ts)
    return done.select(*keys, *keep, back, *added.names)
