"""Model operators against plain numpy."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quillstat.operators import charts as V
from quillstat.operators import classify as K
from quillstat.operators import cluster as U
from quillstat.operators import linkage as H
from quillstat.operators import profiling as P
from quillstat.operators import splits as S
from quillstat.operators import usage


def naive_agglomeration(points, linkage):
    groups = {i: [i] for i in range(len(points))}
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    out = []
    while len(groups) > 1:
        best = None
        for a in groups:
            for b in groups:
                if a < b:
                    pair = d[np.ix_(groups[a], groups[b])]
                    if linkage == "ward":
                        ca, cb = points[groups[a]].mean(0), points[groups[b]].mean(0)
                        na, nb = len(groups[a]), len(groups[b])
                        h = math.sqrt(2 * na * nb / (na + nb) * ((ca - cb) ** 2).sum())
                    else:
                        h = {"complete": pair.max(), "single": pair.min(), "average": pair.mean()}[linkage]
                    if best is None or h < best[0]:
                        best = (h, a, b)
        h, a, b = best
        new = len(points) + len(out)
        groups[new] = groups.pop(a) + groups.pop(b)
        out.append((a, b, h, len(groups[new])))
    return out


def lance_williams(points, sizes, linkage):
    """Agglomeration of (M, d) weighted points by Lance-Williams updates of one M x M matrix.  Merge table rows
    (left, right, distance, size) with new ids M + step."""
    m = len(points)
    size = np.asarray(sizes, dtype=float).copy()
    norm = (points ** 2).sum(1)
    d2 = np.maximum(norm[:, None] - 2 * points @ points.T + norm[None, :], 0.0)
    dist = 2 * size[:, None] * size[None, :] / (size[:, None] + size[None, :]) * d2 if linkage == "ward" else np.sqrt(d2)
    np.fill_diagonal(dist, np.inf)
    ids = np.arange(m)
    merges = []
    for step in range(m - 1):
        a, b = sorted(np.unravel_index(np.argmin(dist), dist.shape))
        da, db, dab, na, nb = dist[a].copy(), dist[b].copy(), dist[a, b], size[a], size[b]
        if linkage == "ward":
            new = ((size + na) * da + (size + nb) * db - size * dab) / (size + na + nb)
        elif linkage == "average":
            new = (na * da + nb * db) / (na + nb)
        else:
            new = (np.maximum if linkage == "complete" else np.minimum)(da, db)
        gone = np.isinf(da) | np.isinf(db)
        new[gone] = np.inf
        new[a] = new[b] = np.inf
        merges.append((int(min(ids[a], ids[b])), int(max(ids[a], ids[b])),
                       float(np.sqrt(dab) if linkage == "ward" else dab), int(na + nb)))
        dist[a], dist[:, a] = new, new
        dist[b], dist[:, b] = np.inf, np.inf
        size[a], ids[a] = na + nb, m + step
    return merges


def cut_tree(merges, m: int, k: int) -> np.ndarray:
    """Leaf -> cluster label after undoing the last k-1 merges (labels 0..k-1 by first leaf)."""
    parent = list(range(m + len(merges)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for step, (l, r, _, _) in enumerate(merges[: m - k]):
        new = m + step
        parent[find(l)] = new
        parent[find(r)] = new
    roots = [find(i) for i in range(m)]
    relabel = {}
    return np.array([relabel.setdefault(r, len(relabel)) for r in roots])


@pytest.mark.parametrize("linkage", H.LINKAGES)
def test_brute_force_and_chain_agree(linkage):
    points = np.random.default_rng(4).normal(size=(25, 3))
    got, want = lance_williams(points, np.ones(25), linkage), naive_agglomeration(points, linkage)
    assert [(a, b, n) for a, b, _, n in got] == [(a, b, n) for a, b, _, n in want]
    assert np.allclose([x[2] for x in got], [x[2] for x in want])
    d = H._distances(points, points)  # for two single points, ward has the distance itself
    chain = sorted(h for _, _, h in H.merge_matrix(d, np.ones(25), linkage))
    assert np.allclose(chain, [x[2] for x in want])


def test_cut_line():
    merges = [(0, 1, 1.0, 2), (2, 3, 2.0, 2), (4, 5, 6.0, 4)]
    assert H.cut_line(merges, 2) == 4.0 and H.cut_line(merges, 3) == 1.5 and H.cut_line(merges, 4) == 0.5
    assert H.cut_line(merges, 1) is None and H.cut_line(merges, 9) is None


def _same_tree(points, sizes, linkage, merges, labels, k):
    want = lance_williams(points, sizes, linkage)
    assert [(a, b, n) for a, b, _, n in merges] == [(a, b, n) for a, b, _, n in want]
    assert np.allclose([x[2] for x in merges], [x[2] for x in want])
    assert labels == cut_tree(want, len(points), k).tolist()


@pytest.mark.parametrize("linkage", H.LINKAGES)
def test_rounds_over_blocks_are_exact(spark, linkage):
    """Rounds, clusters larger than a block and the last task together give the tree of plain agglomeration."""
    rng = np.random.default_rng(len(linkage))
    rows = [[float(x) for x in rng.normal(loc=3 * (i % 4 == 0), size=3)] for i in range(34)]
    rows += rows[:6] + rows[:1] * 3  # repeated vectors are one leaf
    points = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, v array<double>")
    leaves = H.leaves(points, "v")
    got = leaves.orderBy("leaf").collect()
    x, w = np.array([r["v"] for r in got]), np.array([r["w"] for r in got])
    assert len(got) == 34 and sorted(w)[-1] == 5
    edges = H.tree(leaves, linkage, block=9, finish=12)
    labels = [r["cluster"] for r in H.cut(edges, leaves, 5).orderBy("leaf").collect()]
    _same_tree(x, w, linkage, H.merge_table(edges, leaves), labels, 5)
    top = H.merge_table(edges, leaves, top=4)
    assert len(top) == 4 and top[-1][3] == len(rows) and np.allclose([m[2] for m in top], sorted(r["height"] for r in edges.collect())[-4:])


@pytest.mark.parametrize("linkage", ["ward", "average"])
def test_two_thousand_vectors_are_exact(spark, linkage):
    leaves = H.leaves(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"), "embedding")
    got = leaves.orderBy("leaf").collect()
    edges = H.tree(leaves, linkage)
    labels = [r["cluster"] for r in H.cut(edges, leaves, 10).orderBy("leaf").collect()]
    _same_tree(np.array([r["v"] for r in got]), np.array([r["w"] for r in got]), linkage, H.merge_table(edges, leaves), labels, 10)


def test_kmeans_search_is_lloyd_from_the_same_starts(spark):
    rng = np.random.default_rng(9)
    x = np.vstack([rng.normal(c, 1.0, (40, 3)) for c in (0, 4, 9, 15)])
    df = spark.createDataFrame([([float(a) for a in v],) for v in x] + [(None,)], "v array<double>").repartition(3)
    found = U.kmeans_search(df, "v", [1, 2, 4, 6], n_init=3, seed=5, tol=0.0)
    starts = U.start_centres(U._matrix_blocks(df, "v"), 6, [5, 6, 7])
    for k, (cost, centres) in found.items():
        costs = []
        for start in starts:
            c = start[:k].copy()
            for _ in range(300):
                near = ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1)
                new = np.array([x[near == i].mean(0) if (near == i).any() else c[i] for i in range(k)])
                if (new == c).all():
                    break
                c = new
            costs.append(((x[:, None] - c[None]) ** 2).sum(-1).min(1).sum())
        assert math.isclose(cost, min(costs), rel_tol=1e-9) and len(centres) == k
    few = spark.createDataFrame([([1.0, 2.0],)] * 5 + [([3.0, 4.0],)] * 2, "v array<double>")
    assert [len(U.kmeans_search(few, "v", [3], n_init=2)[3][1]), U.kmeans_search(few, "v", [3], n_init=2)[3][0]] == [2, 0.0]
    assert U.kmeans_search(few.limit(0), "v", [2])[2][0] == 0.0


def test_components_by_rounds(spark):
    edges = [(9, 8), (8, 7), (7, 1), (20, 21), (21, 22), (22, 5), (3, 4)]
    df = spark.createDataFrame(edges, "u long, v long")
    want = {**dict.fromkeys((1, 7, 8, 9), 1), **dict.fromkeys((5, 20, 21, 22), 5), 3: 3, 4: 3}
    for small in (0, 100):
        assert dict(map(tuple, H.components(df, small).collect())) == want
    assert H.components(df.limit(0), 100).count() == 0


def test_small_and_empty_tables_are_clustered(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(loc=10 * (i % 3), size=2)]) for i in range(30)] + [(30, [0.0, 0.0]), (31, [0.0, 0.0]), (32, None)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    out, merges = H.hierarchical(df, "v", 3)
    groups = {}
    for r in out.collect():
        groups.setdefault(r["cluster"], set()).add(r["id"] % 3 if r["id"] < 30 else 0)
    assert groups.pop(None) == {0}
    assert sorted(map(sorted, groups.values())) == [[0], [1], [2]] and merges.count() == 30
    out, merges = H.hierarchical(df.limit(0), "v", 3)
    assert out.count() == merges.count() == 0
    out, merges = H.hierarchical(df.where("id = 0"), "v", 3)
    assert [r["cluster"] for r in out.collect()] == [0] and merges.count() == 0


def test_euclidean_silhouette(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 3))
    c = [0] * 40 + [1] * 19 + [2]
    df = spark.createDataFrame([(i, [float(a) for a in v], k) for i, (v, k) in enumerate(zip(x, c))] + [(60, None, 1), (61, [0.0] * 3, None)],
                               "id long, v array<double>, c int")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    c = np.array(c)
    for block in (8, 1024):
        H_block, H.distance_sums.__defaults__ = H.distance_sums.__defaults__, (block,)
        got = {r["id"]: r["silhouette"] for r in U.euclidean_silhouette(df, "v", "c", "id").collect()}
        H.distance_sums.__defaults__ = H_block
        assert set(got) == set(range(60))
        for i in range(60):
            if c[i] == 2:
                assert got[i] == 0.0
                continue
            a = d[i, c == c[i]].sum() / ((c == c[i]).sum() - 1)
            b = min(d[i, c == k].mean() for k in range(3) if k != c[i])
            assert math.isclose(got[i], (b - a) / max(a, b), rel_tol=1e-9)


def test_knn_keeps_true_neighbours_of_large_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [1e8 + rng.random(), -1e8 + rng.random(), rng.random()]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, v array<double>").withColumn("y", F.col("id") % 2)
    q, t = df.where("id % 10 = 0"), df.where("id % 10 <> 0")
    got = {(r["qid"], r["rank"]): r["id"] for r in K.knn_join(q.select(F.col("id").alias("qid"), "v"), t, "qid", "id", "v", 4, block=37).collect()}
    for i, v in rows[::10]:
        near = sorted((sum((a - b) ** 2 for a, b in zip(v, w)), j) for j, w in rows if j % 10)[:4]
        assert [got[i, k + 1] for k in range(4)] == [j for _, j in near]


def test_stratified_folds_are_even(spark):
    df = spark.range(1003).select("id", F.when(F.col("id") % 9 == 0, 1).otherwise(0).alias("y"))
    counts = S.stratified_folds(df, "id", "y", 5).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        n = [r["count"] for r in counts if r["y"] == y]
        assert len(n) == 5 and max(n) - min(n) <= 1


def test_best_model_ties_go_to_the_smaller_name(spark):
    df = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", 0.5)], "model string, roc_auc double")
    assert K.best_model(df).first()["best_model"] == "a"


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), None), (3.0, "y"), (None, "x")], "v double, s string")
    row = P.describe(df, ["v"]).first()
    assert (row["count"], row["mean"], row["max"], row["q50"]) == (2, 2.0, 3.0, 2.0)
    assert {r["col_name"]: r["n_missing"] for r in P.missing_report(df).collect()} == {"v": 2, "s": 1}
    assert {r["col_name"]: r["n_unique"] for r in P.missing_analysis(df).collect()} == {"v": 2, "s": 2}


def test_box_stats_and_kde(spark):
    rng = np.random.default_rng(9)
    v = np.round(rng.normal(size=400), 2)
    df = spark.createDataFrame([("a" if i % 4 else None if i % 8 else "b", float(x)) for i, x in enumerate(v)], "g string, v double")
    box = V.box_stats(df, ["v"]).first()
    q1, q2, q3 = np.quantile(v, [0.25, 0.5, 0.75])
    inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
    assert np.allclose([box[c] for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")], [q1, q2, q3, inside.min(), inside.max()])
    assert box["n_outliers"] == 400 - len(inside)
    assert {r["g"] for r in V.box_stats(df, ["v"], ["g"]).collect()} == {"a", "b"}
    h = v.std(ddof=1) * 400 ** -0.2
    for r in V.kde_curve(df, "v", 7).collect():
        assert math.isclose(r["density"], np.exp(-0.5 * ((r["x"] - v) / h) ** 2).sum() / (400 * h * math.sqrt(2 * math.pi)), rel_tol=1e-9)


def test_trailing_counts(spark):
    rng = random.Random(0)
    rows = [(i, rng.randint(0, 20000), rng.choice(["hot", "hot", "hot", None])) for i in range(300)]
    got = usage.trailing_call_count(spark.createDataFrame(rows, "id int, ts int, k string"), "ts", ["k"], 3600).collect()
    assert len(got) == 300
    for r in got:
        assert r["calls_last_hour"] == sum(r["ts"] - 3600 < t <= r["ts"] and k == r["k"] for _, t, k in rows)


def test_checkpoint_folder_is_asked_for_off_a_local_master():
    from types import SimpleNamespace

    from quillstat.session import ensure_checkpoint_dir

    none = SimpleNamespace(isDefined=lambda: False)
    sc = SimpleNamespace(master="spark://h:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none)))
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(fake)


def test_thousands_of_clusters_are_merged_without_rounds(spark, monkeypatch):
    """A cluster that is nearest to all others takes one of them in a round: thousands go to the last task at once."""
    monkeypatch.setattr(H, "_nearest", lambda *a: pytest.fail("a round"))
    x = np.random.default_rng(3).normal(size=(2100, 2))
    leaves = H.leaves(spark.createDataFrame(pd.DataFrame({"v": list(x)})), "v")
    assert H.tree(leaves, "ward").count() == 2099


def test_distances_of_near_and_large_vectors():
    rng = np.random.default_rng(8)
    x = np.vstack([rng.normal(size=(40, 5)), 1e8 + rng.normal(size=(40, 5)), [[np.inf] * 5]])
    with np.errstate(invalid="ignore"):
        want = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
        assert np.allclose(H._distances(x, x), want, rtol=1e-11, atol=0, equal_nan=True)


def test_tasks_meet_few_pairs(spark, monkeypatch):
    """What a task is sent at a time stays the same however many blocks there are."""
    n = 4 * 4 * spark.sparkContext.defaultParallelism
    blocks = spark.range(0, n, 1, n).withColumnRenamed("id", "at")
    assert H._pairs(blocks).rdd.getNumPartitions() >= (n // 4) ** 2

    def counted(k):
        def fn(batches):
            pairs = sum(len(b) for b in batches)
            yield pd.DataFrame({"_q": [TaskContext.get().partitionId()], "_t": [0], "d2": [float(pairs)]})

        return fn

    monkeypatch.setattr(K, "_local_topk", counted)
    rows = spark.range(n).select("id", F.array(F.col("id").cast("double")).alias("v"))
    got = K.knn_join(rows.withColumnRenamed("id", "q"), rows, "q", "id", "v", 1, block=1)
    assert got.agg(F.max("d2")).first()[0] <= 64


def test_silhouettes_of_several_clusterings(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(a) for a in rng.normal(size=3)], i % 2, i % 5, None if i % 4 else 300 + i) for i in range(70)]
    df = spark.createDataFrame(rows, "id long, v array<double>, a int, b int, c int")
    want = {c: U.silhouette_score(df, "v", c).first()[0] for c in "abc"}
    got = dict(map(tuple, U.silhouette_score(df, "v", ["a", "b", "c"]).collect()))
    assert set(got) == set(want) and all(math.isclose(got[c], want[c], rel_tol=1e-9, abs_tol=1e-12) for c in want)
    many = df.withColumn("d", F.col("id") % 35).withColumn("e", F.col("id") + 1000)
    narrow = U.silhouette_score(many, "v", ["d"]).first()["silhouette"]
    many = many.unionByName(many.select(F.col("id") + 70, "v", "a", "b", "c", F.lit(None).cast("long").alias("d"), "e").toDF(*many.columns))
    assert math.isclose(dict(map(tuple, U.silhouette_score(many, "v", ["d"]).collect()))["d"], narrow, rel_tol=1e-9)
    before, H.WIDE = H.WIDE, 3  # more clusters than travel side by side
    try:
        assert math.isclose(U.silhouette_score(many, "v", ["d"]).first()["silhouette"], narrow, rel_tol=1e-9)
    finally:
        H.WIDE = before


def test_box_stats_do_not_sort_the_rows_by_group(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = V.box_stats(df, ["v"], ["g"])
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_deep_trees_keep_the_nodes_of_rows(spark):
    df = K.assemble(spark.range(60).select((F.col("id") % 7).alias("x"), (F.col("id") % 2).alias("y")), ["x"])
    assert K.random_forest(df, "y", 2, None).getCacheNodeIds() and not K.random_forest(df, "y", 2, 3).getCacheNodeIds()
