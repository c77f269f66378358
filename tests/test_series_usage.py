import random
import datetime as dt

import pytest
from pyspark.sql import functions as F

from quillstat.operators import dialogue as D
from quillstat.operators import ensemble as E
from quillstat.operators import series as TS
from quillstat.operators import usage as U


def _series(spark, values):
    base = dt.datetime(2024, 1, 1)
    rows = [(1, base + dt.timedelta(seconds=i), i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "s int, ts timestamp_ntz, id int, v double")


@pytest.mark.parametrize("values,expected", [
    ([1, 3, 1], [1]),
    ([1, 2, 2, 1], [1, 2]),
    ([2, 2, 2], []),
    ([5, 1, 5], []),
    ([1, 3, None, 1, 4, 1], [4]),
    ([1, 3], []),
])
def test_peak_rules(spark, values, expected):
    vals = [float(v) if v is not None else None for v in values]
    for chunk in (3, 1_000_000):
        got = TS.find_peaks(_series(spark, vals), "v", ["ts", "id"], ["s"], 1, chunk_rows=chunk)
        assert sorted(r["id"] for r in got.collect()) == expected


def test_peaks_chunked_equals_keyed(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    a = TS.find_peaks(ev, "value", ["ts", "event_id"], ["user_id"], 2, chunk_rows=5)
    b = TS.find_peaks(ev, "value", ["ts", "event_id"], ["user_id"], 2)
    assert a.select("event_id").exceptAll(b.select("event_id")).count() == 0
    assert a.count() == b.count()
    c = TS.find_peaks(ev, "value", ["ts", "event_id"], [], 1, chunk_rows=37)
    d = TS.find_peaks(ev, "value", ["ts", "event_id"], [], 1)
    assert sorted(r[0] for r in c.select("event_id").collect()) == sorted(r[0] for r in d.select("event_id").collect())


def test_window_fallback_and_clock(spark):
    df = _series(spark, [1.0, 2.0, 3.0, 4.0])
    empty = TS.window_or_fallback(df, "ts", "2025-01-01 00:00:00", 10, 2, ["ts", "id"])
    assert [r["id"] for r in empty.collect()] == [2, 3]
    hit = TS.window_or_fallback(df, "ts", "2024-01-01 00:00:03", 1, 10, ["ts", "id"])
    assert [r["id"] for r in hit.collect()] == [2, 3]
    shifted = TS.fix_future_clock(df, "ts", "2024-01-01 00:00:01").orderBy("id").collect()
    assert shifted[-1]["ts"] == dt.datetime(2024, 1, 1, 0, 0, 1)
    yearly = TS.fix_future_clock(df, "ts", "2023-06-01 00:00:00").orderBy("id").collect()
    assert yearly[0]["ts"] == dt.datetime(2023, 1, 1)
    leap = spark.createDataFrame([(dt.datetime(2024, 2, 29, 12),), (dt.datetime(2024, 3, 1),)], "ts timestamp_ntz")
    fixed = TS.fix_future_clock(leap, "ts", "2023-12-01 00:00:00").collect()
    assert fixed[0]["ts"] is None and fixed[1]["ts"] == dt.datetime(2023, 3, 1)


def test_token_estimate(spark):
    df = spark.createDataFrame([("",), ("a",), ("abcd",), ("abcde",), (None,)], "s string")
    assert [r[0] for r in df.select(U.estimate_tokens(F.col("s"))).collect()] == [0, 1, 1, 2, 0]


def test_quota_admission_sequence(spark):
    calls = spark.createDataFrame([(i, float(t), "k") for i, t in enumerate([0, 10, 20, 3600, 3610])],
                                  "id int, t double, key string")
    out = U.quota_admission(calls, "t", "id", 2, ["key"]).orderBy("id").collect()
    assert [r["admitted"] for r in out] == [True, True, False, True, True]


def _admitted_one_by_one(times, max_calls, horizon, before=()):
    state, out = list(before), []
    for i, t in enumerate(times):
        if sum(t - a < horizon for a in state) < max_calls:
            state.append(t)
            out.append(i)
    return out


def test_admit_after_any_state_and_guess():
    rng = random.Random(11)
    for _ in range(600):
        n, m, horizon = rng.randint(0, 60), rng.randint(1, 5), rng.choice([3.0, 10.0, 0.3])
        times = sorted(rng.choice([rng.uniform(0, 40), float(rng.randint(0, 40)), rng.randint(0, 400) / 10]) for _ in range(n))
        before = sorted(rng.uniform(-12, times[0] if times else 0) for _ in range(rng.randint(0, m)))
        want = _admitted_one_by_one(times, m, horizon, before)
        guess = U.admit(times, (), m, horizon)
        assert guess == _admitted_one_by_one(times, m, horizon)
        assert U.admit(times, before, m, horizon) == want
        assert U.admit(times, before, m, horizon, guess) == want


@pytest.mark.parametrize("max_calls, per_hour", [(1, 7), (3, 2), (3, 500), (40, 45)])
def test_a_run_without_a_pause_splits(spark, monkeypatch, max_calls, per_hour):
    """One key with all calls and no gap of an hour: admitted over many segments and tasks as one by one."""
    monkeypatch.setattr(U, "_SEGMENT", 300)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, "100")
    rng = random.Random(max_calls)
    t, rows = 0.0, []
    for i in range(4000):
        t += min(3500.0, rng.expovariate(per_hour / 3600)) if rng.random() < 0.9 else 0.0
        rows.append((i, float(round(t)), None))
    rng.shuffle(rows)
    calls = spark.createDataFrame(rows + [(4000, None, None)], "id int, t double, key string")
    rows.sort(key=lambda r: (r[1], r[0]))
    want = [rows[i][0] for i in _admitted_one_by_one([r[1] for r in rows], max_calls, 3600)]
    for keys in (["key"], []):
        out = U.quota_admission(calls, "t", "id", max_calls, keys).collect()
        assert len(out) == 4001
        assert sorted(r["id"] for r in out if r["admitted"]) == sorted(want)
    laid = U.lay_out(calls.withColumn("_tsd", F.col("t")), ["key"], ["_tsd", "id"])
    segments = laid.where("t IS NOT NULL").select("key", "_part", "_at", "_tsd").mapInArrow(
        U._speculated(["key"], max_calls, 3600.0), "key string, _part long, _first long, times binary, guess binary")
    assert segments.count() >= 14 and segments.select("_part").distinct().count() == 4
    spark.conf.set(batch, before)


def test_null_keys_are_a_key(spark):
    rows = [(i, float(i * 900), None if i % 3 == 0 else "k", 0.5) for i in range(60)]
    calls = spark.createDataFrame(rows, "id int, t double, provider string, cost double")
    out = U.quota_admission(calls, "t", "id", 1, ["provider"]).collect()
    assert len(out) == 60
    for key in (None, "k"):  # one call an hour
        admitted = [r["t"] for r in sorted(out, key=lambda r: r["t"]) if r["provider"] == key and r["admitted"]]
        assert admitted[0] == (0.0 if key is None else 900.0) and min(b - a for a, b in zip(admitted, admitted[1:])) >= 3600
    costs = U.cumulative_cost(calls, ["t", "id"]).collect()
    assert len(costs) == 60
    for key in (None, "k"):
        own = sorted((r["t"], r["cum_cost"]) for r in costs if r["provider"] == key)
        assert [c for _, c in own] == [0.5 * (i + 1) for i in range(len(own))]


def test_alert_window_boundary(spark):
    log = spark.createDataFrame([(0, 1.0), (-1, 2.0)], "ts long, cost double")
    a = U.hourly_cost_alert(log, 3600, 1.0).first()
    assert a["count_last_hour"] == 1 and a["cost_last_hour"] == 1.0 and a["alert"]


def test_votes(spark):
    df = spark.createDataFrame([(0.9, 0.1, 1, 0)], "p1 double, p2 double, v1 int, v2 int")
    soft = E.ensemble_predict(df, {"a": "p1", "b": "p2"}, weights={"a": 0.0, "b": 0.0}).first()
    assert soft["ensemble_proba"] == 0.0 and soft["ensemble_pred"] == 0
    hard = E.ensemble_predict(df, {}, {"a": "v1", "b": "v2"}).first()
    assert hard["ensemble_pred"] == 0


def test_first_acceptable_and_map_text(spark):
    c = spark.createDataFrame([(1, 1, "[placeholder]"), (1, 2, "real"), (2, 1, "[x]")], "g int, r int, t string")
    got = {r["g"]: r["chosen"] for r in D.first_acceptable(c, ["g"], F.col("r"), "t").collect()}
    assert got == {1: "real", 2: "[x]"}
    m = spark.createDataFrame([({"b": 2, "a": 1},)], "m map<string,int>")
    assert m.select(D.map_to_text(F.col("m"))).first()[0] == "a: 1; b: 2"


def test_chunked_moving_average_and_durbin_watson(spark):
    from pyspark.sql import Window

    from quillstat.operators import charts as V

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "value")
    small = V.moving_average(ev, "value", ["ts", "event_id"], size=6, chunk_rows=17)
    w = Window.orderBy("ts", "event_id").rowsBetween(-3, 2)
    ref = ev.withColumn("ref", F.avg("value").over(w))
    joined = small.join(ref.select("event_id", "ref"), "event_id")
    assert joined.count() == ev.count()
    assert joined.where(F.abs(F.col("trend") - F.col("ref")) > 1e-9).count() == 0
    v = [r["value"] for r in ev.orderBy("ts", "event_id").collect()]
    dw = sum((b - a) ** 2 for a, b in zip(v, v[1:])) / sum(x * x for x in v)
    assert TS.durbin_watson(ev, "value", ["ts", "event_id"]).first()["dw"] == pytest.approx(dw, rel=1e-12)
