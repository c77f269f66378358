import duckdb
import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quillstat.functions.kernels import (exact_quantiles, kth_smallest, lay_out, mix_hash, mix_hash_sql, prefix_sum,
                                         previous_values, with_positions)
from quillstat.operators import charts as V
from quillstat.operators.series import find_peaks


def _np_quantile(x, q):
    return float(np.quantile(np.array(x, dtype=float), q))  # linear interpolation


def test_exact_quantiles_match_linear_interpolation(spark):
    rng = np.random.default_rng(0)
    vals = list(np.round(rng.normal(50, 5, 997), 1)) + [50.0] * 300 + [None] * 5  # ties + NULLs
    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in vals], "x double")
    clean = [v for v in vals if v is not None]
    got = {r["q"]: r["value"] for r in exact_quantiles(df, ["x"], [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]).collect()}
    for q, v in got.items():
        assert v == pytest.approx(_np_quantile(clean, q), abs=1e-9)


def test_exact_quantiles_small_accuracy_still_exact(spark):
    # a tiny accuracy forces a wide band; the answer must stay exact
    rng = np.random.default_rng(1)
    vals = rng.exponential(10, 5000)
    df = spark.createDataFrame([(float(v), int(i % 3)) for i, v in enumerate(vals)], "x double, g int")
    got = exact_quantiles(df, ["x"], [0.25, 0.5, 0.9], by=["g"], accuracy=50).collect()
    for r in got:
        sub = [v for i, v in enumerate(vals) if i % 3 == r["g"]]
        assert r["value"] == pytest.approx(_np_quantile(sub, r["q"]), rel=1e-12)


def test_kth_smallest_with_hash_ties(spark):
    rows = [(i % 97, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "h long, k long")
    expected = sorted(rows)
    for k in (1, 100, 1500, 3000):
        t, key = kth_smallest(df, "h", "k", k, band_limit=50, grid=10)
        assert (t, key) == (float(expected[k - 1][0]), expected[k - 1][1])


def _awkward(spark):
    """Events with NULL and hot keys, NULL and NaN values, tied and NaN order values."""
    nan = float("nan")
    rows = [(None if i % 3 == 0 else "hot" if i % 5 else f"k{i % 7}", [float(i // 20), nan, None][0 if i % 11 else i % 2 + 1], i,
             [float(i % 13), None, nan][0 if i % 9 else i % 2 + 1]) for i in range(400)]
    return spark.createDataFrame(rows, "k string, o double, id long, v double")


def _plain(df, keys, out):
    return df.withColumns({n: c.over(Window.partitionBy(*keys).orderBy("o", "id").rowsBetween(Window.unboundedPreceding, 0)) for n, c in out.items()})


@pytest.mark.parametrize("keys", [["k"], []])
def test_ordered_kernels_match_plain_windows(spark, keys):
    df = _awkward(spark)
    w = Window.partitionBy(*keys).orderBy("o", "id")
    pos = with_positions(df, keys, ["o", "id"])
    assert pos.count() == 400
    assert pos.withColumn("rn", F.row_number().over(w) - 1).where("rn <> _pos").count() == 0
    sums = prefix_sum(df.withColumn("v", F.nanvl("v", F.lit(None))), {"cum": "v", "n": "id"}, keys, ["o", "id"])
    want = _plain(df.withColumn("v", F.nanvl("v", F.lit(None))), keys, {"cum": F.sum("v"), "n": F.sum("id")})
    assert sorted(map(str, sums.collect())) == sorted(map(str, want.select(sums.columns).collect()))
    before = previous_values(lay_out(df, keys, ["o", "id"]), keys, {"b": "v", "i": "id"}).drop("_part", "_at")
    want = df.withColumns({"b": F.lag("v").over(w), "i": F.lag("id").over(w)})
    assert sorted(map(str, before.collect())) == sorted(map(str, want.collect()))


def test_chunk_size_changes_nothing(spark):
    df = _awkward(spark).withColumn("v", F.nanvl("v", F.lit(None)))
    got = [sorted(map(str, V.moving_average(df, "v", ["o", "id"], 5, ["k"], chunk_rows=c).collect())) for c in (7, 10**6)]
    assert got[0] == got[1] and len(got[0]) == 400
    w = Window.partitionBy("k").orderBy("o", "id").rowsBetween(-2, 2)
    assert got[0] == sorted(map(str, df.withColumn("trend", F.avg("v").over(w)).collect()))
    peaks = [sorted(map(str, find_peaks(df, "v", ["o", "id"], ["k"], 1, chunk_rows=c).collect())) for c in (7, 10**6)]
    assert peaks[0] == peaks[1] and peaks[0]


def test_ties_and_hot_keys_are_split(spark):
    # one key and one order value hold every row: the layout still uses all partitions
    df = spark.range(4000).select(F.lit("k").alias("k"), F.lit(1.0).alias("o"), "id")
    sizes = [r["count"] for r in lay_out(df, ["k"], ["o", "id"]).groupBy("_part").count().collect()]
    assert len(sizes) >= 3 and max(sizes) < 2500


def test_mixing_hash(spark):
    df = spark.range(20000).select((F.col("id") * 4).alias("id"))
    a, b = mix_hash("id", "a"), mix_hash("id", "b")
    cells = df.groupBy(F.pmod(a, F.lit(5)).alias("x"), F.pmod(b, F.lit(10)).alias("y")).count().collect()
    assert len(cells) == 50 and min(r["count"] for r in cells) > 300
    low = df.orderBy(a).limit(100).agg(F.max("id")).first()[0]
    assert low > 60000  # no prefix of the keys
    assert spark.sql("SELECT 1000000000000000000 AS id").select(a.alias("h")).first()["h"] >= 0  # no overflow
    con = duckdb.connect()
    for key in ("1", "10000000000000", "NULL"):
        got = spark.sql(f"SELECT CAST({key} AS BIGINT) AS id").select(a.alias("h")).first()["h"]
        assert con.sql(f"SELECT {mix_hash_sql(f'CAST({key} AS BIGINT)', 'a')}").limit(1).fetchall()[0][0] == got


def test_exact_quantiles_refinement_loop(spark):
    # a tiny band limit forces the grid refinement passes; results stay exact
    rng = np.random.default_rng(11)
    vals = np.round(rng.gamma(2.0, 3.0, 20000), 2)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = exact_quantiles(df, ["x"], [0.1, 0.5, 0.9], accuracy=100, band_limit=50).collect()
    for r in got:
        assert r["value"] == pytest.approx(_np_quantile(vals, r["q"]), abs=1e-9)


def test_grouped_quantiles_hot_group_refinement(spark):
    # one group holds most rows; a tiny band limit forces the grouped refinement rounds
    rng = np.random.default_rng(12)
    vals = np.round(rng.normal(100, 15, 12000), 1)
    groups = np.where(np.arange(12000) < 9000, 0, np.arange(12000) % 4 + 1)
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(groups, vals)], "g int, x double")
    got = exact_quantiles(df, ["x"], [0.25, 0.5, 0.95], by=["g"], accuracy=100, band_limit=40).collect()
    assert len(got) == 15
    for r in got:
        assert r["value"] == pytest.approx(_np_quantile(vals[groups == r["g"]], r["q"]), abs=1e-9)


def test_positions_bursty_order_column(spark):
    # 3/4 of the rows of one hot key fall in a tiny time range; positions must stay exact
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    rows = [(1 if i % 4 else 2, base + dt.timedelta(milliseconds=i) if i < 1500 else base + dt.timedelta(days=i), i)
            for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, id int")
    pos = with_positions(df, ["k"], ["ts", "id"])
    rn = pos.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("ts", "id")) - 1)
    assert rn.where("rn <> _pos").count() == 0 and pos.count() == 2000
