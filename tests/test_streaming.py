import datetime
import glob
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from quillstat.operators import series as TS
from quillstat.operators import usage as U
from quillstat.streaming import live as L


def _feed(spark, scratch, ev):
    ev.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(f"{scratch}/src")
    days = sorted(x for x in os.listdir(f"{scratch}/src") if x.startswith("day="))
    inbox = f"{scratch}/inbox"
    os.makedirs(inbox)
    return days, inbox


def _run(stream, name, scratch, feeds):
    q = stream.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{scratch}/ck-{name}").start()
    try:
        for feed in feeds:
            feed()
            q.processAllAvailable()
        progress = q.lastProgress
    finally:
        q.stop()
    return progress["stateOperators"][0]["numRowsTotal"]


SCHEMA = "event_id long, user_id string, ts timestamp_ntz, value double"


def _events(n=400, users=5, seed=3):
    """Rows with ties in time, a NULL key, NULL values and bursts."""
    rng = random.Random(seed)
    start = datetime.datetime(2024, 3, 1)
    out = []
    for i in range(n):
        ts = start + datetime.timedelta(minutes=rng.choice([rng.randrange(1200), 60 * rng.randrange(20)]))
        out.append((i, rng.choice([None, *"abcde"[:users]]), ts, rng.choice([None, 1.0, 2.0, rng.random()])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_shuffled_batches_equal_batch(spark, scratch, seed):
    """Rows in any order within the delay give the batch results, ties and NULL keys included."""
    rows = _events(seed=seed)
    rng = random.Random(seed)
    rng.shuffle(rows)
    inbox = f"{scratch}/inbox"

    def land(some):
        return lambda: spark.createDataFrame(some, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)

    end = max(r[2] for r in rows)
    beats = [[(-1, "beat", end + datetime.timedelta(days=d), None)] for d in (4, 8)]
    feeds = [land(rows[i::4]) for i in range(4)] + [land(b) for b in beats]
    feeds[0]()
    ev = spark.createDataFrame(rows, SCHEMA)
    st = L.live_stream(spark, inbox, ev.schema, "parquet")
    _run(L.stream_peaks(st, ["user_id"], "ts", "event_id", "value", 2, delay="2 days"), f"peaks{seed}", scratch, [lambda: None, *feeds[1:]])
    got = spark.table(f"peaks{seed}").select("event_id", "user_id", "ts", "value")
    want = TS.find_peaks(ev, "value", ["ts", "event_id"], ["user_id"], 2)
    assert want.count() > 5 and sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), "ts")
    _run(L.stream_quota(st.drop("value"), ["user_id"], "ts", "event_id", 2, delay="2 days"), f"quota{seed}", scratch, [lambda: None])
    got = spark.table(f"quota{seed}").where("event_id >= 0").select("event_id", "admitted")
    want = U.quota_admission(ev.withColumn("t", seconds), "t", "event_id", 2, ["user_id"]).select("event_id", "admitted")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_late_rows_are_dropped_and_waiting_rows_wait(spark, scratch):
    at = lambda h: datetime.datetime(2024, 3, 1) + datetime.timedelta(hours=h)
    inbox = f"{scratch}/inbox"
    land = lambda *some: spark.createDataFrame(some, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
    land((1, "a", at(0), 1.0))
    st = L.live_stream(spark, inbox, spark.createDataFrame([], SCHEMA).schema, "parquet").drop("value")
    stream = L.stream_quota(st, ["user_id"], "ts", "event_id", 1, delay="2 hours")
    q = stream.writeStream.format("memory").queryName("late").option("checkpointLocation", f"{scratch}/ck").start()
    ids = lambda: sorted(r.event_id for r in spark.table("late").collect())
    try:
        q.processAllAvailable()
        assert ids() == []
        land((2, "b", at(5), 1.0))
        q.processAllAvailable()
        assert ids() == [1]  # woken by its timer: its key has no new row
        land((3, "a", at(2), 1.0), (4, "b", at(4), 1.0))  # behind the watermark; within the delay
        q.processAllAvailable()
        land((5, "b", at(9), 1.0), (6, "c", None, 1.0))
        q.processAllAvailable()
        assert ids() == [1, 2, 4]
        assert {r.event_id: r.admitted for r in spark.table("late").collect()} == {1: True, 2: True, 4: True}
    finally:
        q.stop()


@pytest.mark.parametrize("what", ["peaks", "quota"])
def test_idle_state_goes(spark, scratch, what):
    at = lambda h: datetime.datetime(2024, 3, 1) + datetime.timedelta(hours=h)
    inbox = f"{scratch}/inbox"
    land = lambda some: lambda: spark.createDataFrame(some, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
    many = [(i, f"u{i}", at(0), 1.0) for i in range(50)]
    land(many)()
    st = L.live_stream(spark, inbox, spark.createDataFrame([], SCHEMA).schema, "parquet")
    if what == "peaks":
        stream = L.stream_peaks(st, ["user_id"], "ts", "event_id", "value", 1, delay="1 hour", idle=datetime.timedelta(hours=3))
    else:
        stream = L.stream_quota(st, ["user_id"], "ts", "event_id", 1, delay="1 hour")
    kept = _run(stream, f"idle_{what}", scratch, [lambda: None, *(land([(100 + h, "live", at(h), 1.0)]) for h in (2, 8, 9))])
    assert kept == 1


def test_numbers_are_no_event_time(spark, scratch):
    schema = spark.range(1).selectExpr("id", "id AS k", "id AS t", "0.5D AS v").schema
    with pytest.raises(TypeError):
        L.stream_peaks(L.live_stream(spark, scratch, schema), ["k"], "t", "id", "v")


def test_window_stats_stream(spark, scratch):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    days, inbox = _feed(spark, scratch, ev)
    for i, day in enumerate(days):
        for f in glob.glob(f"{scratch}/src/{day}/*.parquet"):
            shutil.copy(f, f"{inbox}/{i:03d}-{os.path.basename(f)}")
    st = L.live_stream(spark, inbox, ev.schema, "parquet")
    q = (L.window_stats(st, "ts", ["value"], "1 day", "1 day").writeStream.format("memory").queryName("t_win")
         .outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{scratch}/ck").start())
    q.awaitTermination()
    got = spark.sql("select sum(n) from t_win").first()[0]
    # append mode emits windows closed by the watermark: all but the trailing open window(s)
    assert 0 < got <= ev.count()


LONG_SCHEMA = SCHEMA.replace("user_id string", "user_id long")


def _long_events(users, n, seed):
    rng = random.Random(seed)
    start = datetime.datetime(2024, 3, 1)
    return [(None if i % 97 == 0 else i, rng.choice(users), start + datetime.timedelta(minutes=10 * rng.randrange(120), microseconds=i),
             rng.choice([None, 1.0, rng.random()])) for i in range(n)]


@pytest.mark.parametrize("what", ["peaks", "quota"])
@pytest.mark.parametrize("buckets", [1, None])
def test_many_keys_share_few_states(spark, scratch, what, buckets):
    """A state per key, with a call for each in every batch, made the time grow by the keys; results are those of the batch."""
    users = [None, 0, 2**53, 2**53 + 1, *range(1, 700)]
    rows = _long_events(users, 3000, 5)
    inbox = f"{scratch}/inbox"
    land = lambda some: lambda: spark.createDataFrame(some, LONG_SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
    shuffled = random.Random(1).sample(rows, len(rows))
    end = max(r[2] for r in rows)
    beats = [[(-1, -1, end + datetime.timedelta(days=d), None)] for d in (4, 8)]
    land(shuffled[::2])()
    ev = spark.createDataFrame(rows, LONG_SCHEMA)
    st = L.live_stream(spark, inbox, ev.schema, "parquet")
    some = {"buckets": buckets} if buckets else {}
    if what == "peaks":
        stream = L.stream_peaks(st, ["user_id"], "ts", "event_id", "value", 1, delay="2 days", **some)
        want = TS.find_peaks(ev, "value", ["ts", "event_id"], ["user_id"], 1)
    else:
        stream = L.stream_quota(st, ["user_id"], "ts", "event_id", 2, horizon_s=36000, delay="2 days", **some)
        micros = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
        want = U.quota_admission(ev.withColumn("t", micros), "t", "event_id", 2, ["user_id"], 36000)
    states = _run(stream, f"few_{what}_{buckets}", scratch, [lambda: None, land(shuffled[1::2]), *map(land, beats)])
    got = spark.table(f"few_{what}_{buckets}").where("user_id IS NULL OR user_id >= 0")
    assert states <= (buckets or 256)
    assert want.count() > 100
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


def test_carried_rows_and_idle_keys_in_a_shared_state(spark, scratch):
    """Peaks across batches, one key silent meanwhile: it is dropped from the state that others still use."""
    at = lambda h: datetime.datetime(2024, 3, 1) + datetime.timedelta(hours=h)
    inbox = f"{scratch}/inbox"
    land = lambda *some: lambda: spark.createDataFrame(some, LONG_SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
    land((1, 1, at(0), 1.0), (2, 2, at(0), 1.0), (3, 2, at(1), 5.0))()
    st = L.live_stream(spark, inbox, spark.createDataFrame([], LONG_SCHEMA).schema, "parquet")
    stream = L.stream_peaks(st, ["user_id"], "ts", "event_id", "value", 1, delay="1 hour", idle=datetime.timedelta(hours=6), buckets=1)
    feeds = [lambda: None, land((4, 3, at(4), 0.0)), land((5, 2, at(6), 2.0)), land((6, 3, at(10), 0.0)), land((7, 1, at(11), 9.0)),
             land((8, 1, at(12), 1.0)), land((9, 3, at(30), 0.0)), land((10, 3, at(60), 0.0))]
    assert _run(stream, "shared", scratch, feeds) == 1
    assert [(r.user_id, r.event_id, r.value, r.ts) for r in spark.table("shared").collect()] == [(2, 3, 5.0, at(1))]
