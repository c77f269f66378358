"""Model-call usage log operators.

The usage log is an ordinary table ``(ts long epoch-s, provider, method,
prompt_tokens, completion_tokens, cost, extra struct)``.  Calling a provider
is out of scope; these are the queries around the log.
"""

from __future__ import annotations

import bisect
from collections import deque
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.kernels import lay_out, prefix_sum

# USD per 1000 tokens by provider, and the default for others.
RATES_PER_1K = {"mistral": 0.002, "gemini": 0.03, "groq": 0.02}
DEFAULT_RATE = 0.01

EXTRA_TYPE = T.StructType([
    T.StructField("success", T.BooleanType()),
    T.StructField("skipped", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("api_usage", T.StructType([
        T.StructField("prompt_tokens", T.IntegerType()),
        T.StructField("completion_tokens", T.IntegerType()),
    ])),
])
USAGE_SCHEMA = T.StructType([
    T.StructField("ts", T.LongType()),
    T.StructField("provider", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("prompt_tokens", T.IntegerType()),
    T.StructField("completion_tokens", T.IntegerType()),
    T.StructField("cost", T.DoubleType()),
    T.StructField("extra", EXTRA_TYPE),
])


# L1 -------------------------------------------------------------------------
def estimate_tokens(s: Column) -> Column:
    """'' or NULL -> 0, else max(1, ceil(chars / 4))."""
    n = F.coalesce(F.length(s), F.lit(0))
    return F.when(n > 0, F.greatest(F.lit(1), F.ceil(n / F.lit(4.0)))).otherwise(F.lit(0)).cast("long")


# L2 -------------------------------------------------------------------------
def rate_of(provider: Column, rates: Mapping[str, float] = RATES_PER_1K, default: float = DEFAULT_RATE) -> Column:
    """Rate lookup as a literal map (fixed, tiny): no join needed."""
    m = F.create_map(*[x for k, v in rates.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, provider), F.lit(default))


def call_cost(prompt_tokens: Column, completion_tokens: Column, provider: Column,
              rates: Mapping[str, float] = RATES_PER_1K, default: float = DEFAULT_RATE) -> Column:
    return (prompt_tokens + completion_tokens) / F.lit(1000.0) * rate_of(provider, rates, default)


# L3 / L6 --------------------------------------------------------------------
def usage_totals(log: DataFrame, max_calls: int | None = None) -> DataFrame:
    """total_calls (skipped calls included, as the reference), successful_calls, total_cost, remaining quota."""
    out = log.agg(
        F.count(F.lit(1)).alias("total_calls"),
        F.count(F.when(F.col("extra.success"), 1)).alias("successful_calls"),
        F.sum(F.coalesce(F.col("cost"), F.lit(0.0))).alias("total_cost"),
    )
    if max_calls is not None:
        out = out.withColumn("remaining", F.lit(max_calls) - F.col("total_calls"))
    return out


def calls_by_provider(log: DataFrame) -> DataFrame:
    return log.groupBy(F.coalesce(F.col("provider"), F.lit("unknown")).alias("provider")).agg(
        F.count(F.lit(1)).alias("calls"))


def last_calls(log: DataFrame, n: int = 10, order: Sequence[str] = ("ts",)) -> DataFrame:
    """Newest ``n`` entries (TakeOrdered), returned oldest first."""
    return log.orderBy(*[F.col(c).desc() for c in order]).limit(n).orderBy(*order)


# L4 -------------------------------------------------------------------------
def hourly_cost_alert(log: DataFrame, now_epoch: int, threshold: float, horizon_s: int = 3600) -> DataFrame:
    """Entries with now - ts <= horizon (inclusive): cost, count and the alert flag."""
    recent = log.where((F.lit(now_epoch) - F.col("ts")) <= horizon_s)
    return recent.agg(
        F.coalesce(F.sum("cost"), F.lit(0.0)).alias("cost_last_hour"),
        F.count(F.lit(1)).alias("count_last_hour"),
    ).withColumn("alert", F.col("cost_last_hour") >= F.lit(threshold))


# L5 -------------------------------------------------------------------------
#: Calls of one key that are packed and admitted together.
_SEGMENT = 1 << 20


def _first_free(times: list[float], oldest: float, horizon: float, at: int) -> int:
    """The first place from ``at`` on whose time is ``horizon`` or more behind ``oldest``."""
    j = bisect.bisect_left(times, oldest + horizon, at)
    while j > at and times[j - 1] - oldest >= horizon:  # sums and differences may round differently
        j -= 1
    while j < len(times) and times[j] - oldest < horizon:
        j += 1
    return j


def admit(times: list[float], before: Sequence[float], max_calls: int, horizon: float,
          guess: Sequence[int] = ()) -> list[int]:
    """Places of the admitted calls among ``times`` (sorted), after the admitted times ``before``.

    A call has to wait for the one admitted ``max_calls`` before it, so rejected calls are skipped by
    search.  ``guess`` is the answer for some other ``before``: once the last ``max_calls`` admitted calls
    are the guess's as well, its rest is the answer's.
    """
    if max_calls <= 0:
        return []
    admitted, out, at = deque(before, maxlen=max_calls), [], 0
    g = agreed = 0
    while at < len(times):
        if len(admitted) == max_calls and times[at] - admitted[0] < horizon:
            at = _first_free(times, admitted[0], horizon, at)
            if at == len(times):
                break
        admitted.append(times[at])
        out.append(at)
        passed = g
        while g < len(guess) and guess[g] < at:
            g += 1
        if g < len(guess) and guess[g] == at:
            agreed = agreed + 1 if g == passed else 1
            g += 1
            if agreed >= max_calls:
                return out + list(guess[g:])
        else:
            agreed = 0
        at += 1
    return out


def _speculated(keys: list[str], max_calls: int, horizon: float):
    """Calls of a laid-out partition as segments of one key: where they are, their times, and the places that
    would be admitted with nothing admitted before."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, times, first = None, [], 0

        def segment(part: pa.Scalar) -> pa.RecordBatch:
            guess = admit(times, (), max_calls, horizon)
            columns = [*held, pa.array([part]), pa.array([first], type=pa.int64()),
                       pa.array([np.array(times).tobytes()]), pa.array([np.array(guess, dtype=np.int32).tobytes()])]
            return pa.RecordBatch.from_arrays(columns, names=[*keys, "_part", "_first", "times", "guess"])

        part = None
        for batch in batches:
            part, n = batch.column("_part")[0].as_py(), batch.num_rows
            change = np.zeros(n, dtype=bool)
            for k in keys:
                c = batch.column(k)
                same = pc.fill_null(pc.equal(c[1:], c[:-1]), False)
                both_null = pc.and_(pc.is_null(c[1:]), pc.is_null(c[:-1]))
                change[1:] |= ~pc.or_(same, both_null).to_numpy(zero_copy_only=False)
            at = batch.column("_at").to_numpy()
            change[1:] |= np.diff(at) != 1  # calls without a time stand between
            starts = np.append(np.flatnonzero(np.append(True, change[1:])), n)
            values = batch.column("_tsd").to_numpy()
            for i, j in zip(starts.tolist(), starts[1:].tolist()):
                own = [batch.column(k).slice(i, 1) for k in keys]
                joins = held is not None and i == 0 and own == held and first + len(times) == at[0]
                if held is not None and not (joins and len(times) + j - i <= _SEGMENT):
                    yield segment(part)
                    held = None
                if held is None:
                    held, times, first = own, [], int(at[i])
                times.extend(values[i:j].tolist())
        if held is not None:
            yield segment(part)

    return pack


def _stitched(keys: list[str], max_calls: int, horizon: float):
    """Segments of each key in order: what is admitted in truth, after what was admitted before."""

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, before = None, deque(maxlen=max(1, max_calls))
        for batch in batches:
            own_keys = list(zip(*(batch.column(k).to_pylist() for k in keys))) if keys else [()] * batch.num_rows
            for row, own in enumerate(own_keys):
                if own != key:
                    key = own
                    before.clear()
                times = np.frombuffer(batch.column("times")[row].as_py(), dtype=np.float64)
                guess = np.frombuffer(batch.column("guess")[row].as_py(), dtype=np.int32)
                if not before or times[0] - before[-1] >= horizon:
                    found = guess
                else:
                    found = np.array(admit(times.tolist(), before, max_calls, horizon, guess.tolist()), dtype=np.int64)
                before.extend(times[found[-max_calls:]].tolist() if max_calls > 0 else ())
                if len(found):
                    part = np.full(len(found), batch.column("_part")[row].as_py(), dtype=np.int64)
                    places = batch.column("_first")[row].as_py() + found.astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(places)], names=["_p", "_a"])

    return stitch


def quota_admission(calls: DataFrame, ts: str, tie: str, max_calls: int, keys: Sequence[str] = (),
                    horizon_s: float = 3600.0) -> DataFrame:
    """Sequential admission: a call is admitted iff fewer than ``max_calls`` admitted calls of its
    quota key lie in the last ``horizon_s`` seconds (only admitted calls count).

    Calls are laid out by (key, time), so a busy key spans many partitions, and every segment of a key is admitted
    in its own task as if nothing had been admitted before it.  Then a key's segments are stitched in order: what
    is carried from segment to segment are the last ``max_calls`` admitted times, and a segment is gone through again
    only until it agrees with the guess.  Stitching sees eight bytes a call, skips rejected calls by search, and
    takes at most ``max_calls`` steps a horizon; whole rows never meet in one task.  Calls without a time are never
    admitted and take no room.  Output = input + ``admitted``.
    """
    keys = list(keys)
    laid = lay_out(calls.withColumn("_tsd", F.col(ts).cast("double")), keys, ["_tsd", tie])
    timed = laid.where(F.col("_tsd").isNotNull() & ~F.isnan("_tsd")).select(*keys, "_part", "_at", "_tsd")
    kept = T.StructType([calls.schema[k] for k in keys])
    places = [T.StructField("_part", T.LongType()), T.StructField("_first", T.LongType())]
    packed = [T.StructField("times", T.BinaryType()), T.StructField("guess", T.BinaryType())]
    segments = timed.mapInArrow(_speculated(keys, max_calls, horizon_s), T.StructType([*kept.fields, *places, *packed]))
    by_key = segments.repartition(*keys) if keys else segments.repartition(1)
    admitted = by_key.sortWithinPartitions(*keys, "_part", "_first").mapInArrow(
        _stitched(keys, max_calls, horizon_s), "_p long, _a long").withColumn("_admitted", F.lit(True))
    return (laid.join(admitted, (F.col("_part") == F.col("_p")) & (F.col("_at") == F.col("_a")), "left")
            .select(*calls.columns, F.coalesce("_admitted", F.lit(False)).alias("admitted")))


def trailing_call_count(calls: DataFrame, ts: str, keys: Sequence[str] = (), horizon_s: int = 3600) -> DataFrame:
    """Count-only form: calls of the key in (ts - horizon, ts] (all calls, admitted or not; ``ts`` in whole seconds).

    A key is cut into buckets of one horizon, and each call also goes to the next
    bucket, where it is counted but not returned: a busy key spans as many tasks as
    it has horizons.
    """
    own = F.floor(F.col(ts) / F.lit(horizon_s))
    places = F.array(F.struct(own.alias("b"), F.lit(True).alias("own")), F.struct((own + 1).alias("b"), F.lit(False).alias("own")))
    placed = calls.withColumn("_p", F.explode(places)).select("*", F.col("_p.b").alias("_bucket"), F.col("_p.own").alias("_own")).drop("_p")
    w = Window.partitionBy(*keys, "_bucket").orderBy(F.col(ts)).rangeBetween(-(horizon_s - 1), 0)
    return placed.withColumn("calls_last_hour", F.count(F.lit(1)).over(w)).where("_own").drop("_bucket", "_own")


# L7 -------------------------------------------------------------------------
def log_history(log: DataFrame, provider: str | None = None, n: int = 50, tie: Sequence[str] = ()) -> DataFrame:
    """Readable history: epoch -> timestamp, nested fields flattened, optional provider filter, newest n
    (calls of one second by the ``tie`` columns, descending)."""
    out = log.select(
        *tie,
        (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("ts"))).alias("time"), "ts", "provider", "method", "prompt_tokens", "completion_tokens", "cost",
        F.col("extra.success").alias("success"), F.col("extra.error").alias("error"),
        F.col("extra.api_usage.prompt_tokens").alias("api_prompt_tokens"),
        F.col("extra.api_usage.completion_tokens").alias("api_completion_tokens"),
    )
    if provider is not None:
        out = out.where(F.col("provider") == provider)
    return out.orderBy(F.col("ts").desc(), *[F.col(c).desc() for c in tie]).limit(n).drop(*tie)


def provider_list(log: DataFrame) -> DataFrame:
    return log.where(F.col("provider").isNotNull()).select("provider").distinct().orderBy("provider")


# L8 -------------------------------------------------------------------------
def cumulative_cost(log: DataFrame, order: Sequence[str] = ("ts",)) -> DataFrame:
    """Running cost per provider over time (split-safe two-level prefix sum)."""
    return prefix_sum(log, {"cum_cost": "cost"}, ["provider"], list(order))


# L14 ------------------------------------------------------------------------
def normalise_response(raw: Column, provider: Column, prompt_tokens_estimate: Column,
                       rates: Mapping[str, float] = RATES_PER_1K, default: float = DEFAULT_RATE) -> Column:
    """Provider JSON (three shapes, or an error) -> struct(text, prompt_tokens, completion_tokens, cost, success, error).

    text: choices[0].message.content | .text -> candidates[0].content.parts[0].text
          -> output | text | message -> body ; an empty string falls through.
    """
    def j(path):
        return F.nullif(F.get_json_object(raw, path), F.lit(""))

    text = F.coalesce(j("$.choices[0].message.content"), j("$.choices[0].message.text"),
                      j("$.candidates[0].content.parts[0].text"), j("$.output"), j("$.text"), j("$.message"), j("$.body"))
    usage_prompt = F.coalesce(*[F.get_json_object(raw, f"$.{u}.{k}") for u in ("usage", "token_usage", "meta.usage")
                                for k in ("prompt_tokens", "input_tokens", "prompt")],
                              F.get_json_object(raw, "$.promptTokenCount"), F.get_json_object(raw, "$.inputTokenCount"))
    usage_compl = F.coalesce(*[F.get_json_object(raw, f"$.{u}.{k}") for u in ("usage", "token_usage", "meta.usage")
                               for k in ("completion_tokens", "output_tokens", "completion")],
                             F.get_json_object(raw, "$.candidatesTokenCount"), F.get_json_object(raw, "$.outputTokenCount"))
    pt = F.coalesce(usage_prompt.try_cast("long"), prompt_tokens_estimate.cast("long"))
    ct = F.coalesce(usage_compl.try_cast("long"), estimate_tokens(text))
    err = F.get_json_object(raw, "$.error")
    return F.struct(
        text.alias("text"), pt.alias("prompt_tokens"), ct.alias("completion_tokens"),
        call_cost(pt, ct, provider, rates, default).alias("cost"),
        err.isNull().alias("success"), err.alias("error"),
    )


# L15 ------------------------------------------------------------------------
# The reference's placeholder texts, by reason.  Fields: {method}, {provider},
# {PROVIDER} (upper case), {max_calls}, {reason}, {preview}.
OUTCOME_TEMPLATES = {
    "disabled": "[LLM {method} by {provider} - DISABLED: Real API calls not enabled. Set LLM_CALLS_ENABLED=true. Input preview: {preview}...]",
    "quota": "[LLM {method} by {provider} - QUOTA EXHAUSTED: Max {max_calls} calls/hour reached. Input preview: {preview}...]",
    "no_url": "[LLM {method} by {provider} - CONFIG ERROR: API URL not configured. Set {PROVIDER}_API_URL. Input preview: {preview}...]",
    "no_key": "[LLM {method} by {provider} - CONFIG ERROR: API key not configured. Set {PROVIDER}_API_KEY_1. Input preview: {preview}...]",
    "no_provider": "[LLM {method} - NO PROVIDER: No LLM provider configured. Input preview: {preview}...]",
    "other": "[LLM {method} by {provider} - ERROR: {reason}. Input preview: {preview}...]",
}


def _render(template: str, fields: dict) -> Column:
    """Template with {name} fields -> concat of literals and columns."""
    import re

    parts = []
    for piece in re.split(r"(\{[A-Za-z_]+\})", template):
        if piece.startswith("{") and piece.endswith("}"):
            parts.append(fields[piece[1:-1]])
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def outcome_label(reason: Column, provider: Column, method: Column, text: Column, max_calls: int = 200) -> Column:
    """Placeholder text for a call that could not be made (100-char preview, newlines -> spaces)."""
    name = F.coalesce(provider, F.lit("unknown"))
    fields = {
        "method": method, "provider": name, "PROVIDER": F.upper(name), "max_calls": F.lit(str(max_calls)),
        "reason": reason.cast("string"),
        "preview": F.replace(F.substring(F.coalesce(text, F.lit("")), 1, 100), F.lit("\n"), F.lit(" ")),
    }
    expr = None
    for key, template in OUTCOME_TEMPLATES.items():
        if key == "other":
            continue
        rendered = _render(template, fields)
        expr = F.when(reason == key, rendered) if expr is None else expr.when(reason == key, rendered)
    return expr.otherwise(_render(OUTCOME_TEMPLATES["other"], fields))
