import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillstat.llm import mixing as M


def brute_targets(sizes, share=1.5, limit=2.0, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    pot, full = share * sum(sizes.values()), set()
    while True:
        left = pot - sum(limit * sizes[s] for s in full)
        free = [s for s in names if s not in full]
        level = left / sum(w[s] for s in free) if free else 0
        over = {s for s in free if level * w[s] >= limit * sizes[s]}
        if not over:
            return {s: limit * sizes[s] if s in full else level * w[s] for s in names}
        full |= over


@pytest.mark.parametrize("seed", range(6))
def test_targets_against_brute_force(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 3, 10, 200, 5000]) * rng.randint(1, 9) for s in rng.sample(["a", "B", "b", "ä", "z", "", "src10", "src9", None], 1 + seed)}
    rows = [(s, n // 2) for s, n in sizes.items()] + [(s, n - n // 2) for s, n in sizes.items()]
    got = {r.source: r for r in M.source_rates(spark.createDataFrame(rows, "source string, size long")).collect()}
    want = brute_targets(sizes)
    assert set(got) == set(want)
    for s, r in got.items():
        assert r.source_size == sizes[s] and math.isclose(r.target, want[s], abs_tol=1e-9) and r.target <= 2 * sizes[s]


def brute_copies(rate, doc_id, text, number, seed):
    key = f"{'' if doc_id is None else doc_id}:{hashlib.md5((text or '').encode()).hexdigest()}"
    draw = int(hashlib.md5(f"{key}:{number}:{seed}".encode()).hexdigest()[:13], 16) / (1 << 52)
    return math.floor(rate) + (draw < rate - math.floor(rate))


def test_mix(spark):
    rows = [(i, "w " * (i % 7), f"s{i % 3}") for i in range(200)] + [(None, "x y", None), (5, None, "s0")] + [(5, "a b", "s0")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {c: F.lit(1) for c in ("size", "rate", "of__", "target", "source_size", "copies", "key__", "number__", "place__", "n")}
    )
    rates = {r.source: r.rate for r in M.source_rates(df.select("source", F.size(F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda x: x != "")).alias("size"))).collect()}
    numbers, want = Counter(), []
    for i, t, s in rows:
        want += [(-1 if i is None else i, t or "")] * brute_copies(rates[s], i, t, numbers[i, t, s], "mix")
        numbers[i, t, s] += 1
    for parts in (1, 7):
        out = M.mix(df.repartition(parts))
        assert out.columns == df.columns
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in out.collect()) == sorted(want)
    plan = M.planned(df.repartition(5)).collect()
    assert len(plan) == len(rows) and sum(r.copies for r in plan) == len(want)
    assert M.mix(df.limit(0)).collect() == [] == M.planned(df.limit(0)).collect()


@pytest.mark.parametrize("share_id", ["all NULL", "half equal", "half equal rows"])
def test_targets_are_met_with_repeated_ids(spark, share_id):
    """Taken words come within two mean deviations of a draw of their target."""
    ids = {
        "all NULL": lambda i: (None, f"word{i}"),
        "half equal": lambda i: (7 if i % 4 < 2 else i, f"word{i}"),
        "half equal rows": lambda i: (7, "same") if i % 4 < 2 else (i, f"word{i}"),
    }[share_id]
    rows = [(*ids(i), f"s{i % 2}") for i in range(20_000)]
    plan = M.planned(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6))
    for r in plan.groupBy("target").agg(F.sum(F.col("size") * F.col("copies")).alias("taken")).collect():
        assert abs(r.taken - r.target) <= 200


def test_query_comes_near_its_targets(spark):
    from quillstat.llm.queries import op10_mixing

    rows = op10_mixing(spark, "/root/testdata/sf0.1").groupBy("source_size").agg(F.first("target").alias("t"), F.sum("taken").alias("n")).collect()
    assert all(abs(r.n - r.t) <= 0.15 * r.t for r in rows)
    assert abs(sum(r.n for r in rows) / sum(r.t for r in rows) - 1) < 0.03
