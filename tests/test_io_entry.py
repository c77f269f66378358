import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quillstat.sources import files as IO
from quillstat.operators import ensemble as E


def _uri(scratch, name):
    return f"file://{scratch}/{name}"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and df.columns == ["o_orderpriority", "mean", "std", "min", "max"]


def test_catalog_contract():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q) and len(q) >= 150
    assert sum(name.startswith("op") for name in q) in (0, 13)  # the removable operators come all or none


def test_missing_csv_raises_and_live_is_empty(spark, scratch):
    with pytest.raises(FileNotFoundError):
        IO.load_csv(spark, _uri(scratch, "nope.csv"), IO.LIVE_SCHEMA)
    assert IO.read_live(spark, _uri(scratch, "nope-live"), "2024-01-01 00:00:00").count() == 0
    assert IO.read_json_log(spark, _uri(scratch, "nope-log")).count() == 0


def test_json_log_array_file(spark, scratch):
    path = f"{scratch}/log.json"
    with open(path, "w", encoding="utf-8") as fh:
        fh.write('[{"ts": 1, "provider": "groq", "method": "m", "prompt_tokens": 3, "completion_tokens": 4, "cost": 0.5,'
                 ' "extra": {"success": true}},\n {"ts": 2, "provider": null, "method": "m", "cost": 0.25, "extra": {}}]')
    df = IO.read_json_log(spark, path, array_file=True)
    assert df.count() == 2 and df.agg(F.sum("cost")).first()[0] == 0.75


def test_append_observations_ids(spark):
    existing = spark.createDataFrame([(1, 5.0), (7, 6.0)], "id long, y double")
    new = spark.createDataFrame([(30,), (10,), (20,)], "k long").withColumnRenamed("k", "k")
    out = IO.append_observations(existing, new.select(F.lit(None).cast("double").alias("y"), "k"), "id", ["k"], ["y"])
    assert [r["id"] for r in out.orderBy("id").collect()] == [8, 9, 10]


def test_weights_roundtrip(spark, scratch):
    E.save_weights(spark, _uri(scratch, "w"), {"a": 2.0, "b": 0.5})
    assert E.load_weights(spark, _uri(scratch, "w")) == {"a": 2.0, "b": 0.5}
    assert E.load_weights(spark, _uri(scratch, "missing")) == {}
