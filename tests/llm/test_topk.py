import math
import random

import pytest
from pyspark.sql import functions as F

from quillstat.llm import topk
from quillstat.llm.queries import op7_top_k

SF = "/root/testdata/sf0.01"


def brute(rows, queries, k):
    out = []
    for qid, q in queries:
        best = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in rows if (i, v) != (qid, q))[:k]
        out += [(qid, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("big", [False, True])
def test_random_vectors(spark, monkeypatch, big):
    monkeypatch.setattr(topk, "ROWS", 17)
    monkeypatch.setattr(topk, "QUERIES", 5)
    rng = random.Random(3)
    scale = 1 << 27 if big else 3  # beyond what doubles add exactly, and with many ties
    rows = [(i, [rng.randint(-scale, scale) for _ in range(rng.choice([7, 7, 3]))]) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, v array<long>")
    assert got(topk.top_k(df, df.where("id % 10 = 0"), 5)) == brute(rows, [r for r in rows if r[0] % 10 == 0], 5)


def test_fewer_rows_than_k_and_empty(spark):
    rows = [(0, [1, 2]), (1, [3, 4]), (2, [])]
    df = spark.createDataFrame(rows, "id long, v array<long>")
    assert got(topk.top_k(df, df, 5)) == brute(rows, rows, 5)
    assert got(topk.top_k(df.limit(0), df.limit(0), 5)) == [] == got(topk.top_k(df, df.limit(0), 5))


def test_rows_that_share_an_id(spark):
    rng = random.Random(5)
    rows = [(i % 30, [rng.randint(-9, 9) for _ in range(6)]) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, v array<long>")
    asked = [r for r in rows if r[0] % 10 == 0]
    assert got(topk.top_k(df, df.where("id % 10 = 0"), 5)) == brute(rows, asked, 5)


def test_blocks_do_not_follow_partitions(spark):
    rows = spark.range(1000).selectExpr("id", "array(id, 1L) AS v")
    assert topk._packed(rows.repartition(60), 300).count() == 4


def test_quantized(spark):
    rows = [
        (1, [0.5, -0.001]), (1, [0.5, -0.001]), (2, None), (3, [1.0, None]), (4, [float("nan")]), (5, [float("inf")]), (None, [1.0]), (6, []), (7, [2.0]), (7, [1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).withColumn("id", F.lit(1))
    assert got(topk.quantized(df, "vec_id", "embedding")) == [(1, [128, -1]), (6, []), (7, [256]), (7, [512])]


def test_query(spark):
    rows = [
        (r.vec_id, [math.floor(256 * x) for x in r.embedding]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ]
    assert got(op7_top_k(spark, SF)) == brute(rows, [r for r in rows if r[0] % 50 == 0], 5)
