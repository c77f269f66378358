"""What keeps the model operators within bounds on large tables."""

import threading

import numpy as np
import pandas as pd
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_models_exact import lance_williams

from quillstat.operators import classify as K
from quillstat.operators import linkage as H
from quillstat.plans import q_models


def test_a_task_keeps_k_rows_per_query():
    """However many blocks of rows a block of queries meets, a task returns each query's k nearest once."""
    rng = np.random.default_rng(8)
    q, t = np.round(rng.normal(size=(300, 2)), 1), np.round(rng.normal(size=(200, 2)), 1)  # with ties
    pairs = pd.DataFrame([{"q_at": 0, "qkeys": list(range(300)), "qmat": q.tobytes(), "keys": list(range(at, at + 40)), "mat": t[at:at + 40].tobytes()}
                          for at in range(0, 200, 40)])
    got = pd.concat(K._local_topk(3)(iter([pairs.iloc[:2], pairs.iloc[2:]]))).groupby("_q")
    assert (got.size() == 3).all()
    for i, rows in got:
        d = ((t - q[i]) ** 2).sum(1)
        assert list(rows["_t"]) == list(np.lexsort((np.arange(200), d))[:3])


def test_documents_are_read_once(spark):
    """What the models are fitted and scored on does not scan the texts again."""
    assert not [f for f in q_models._doc_split(spark, SF_SMALL).inputFiles() if "documents" in f]


def test_folds_are_fitted_side_by_side(spark):
    df = K.assemble(spark.range(60).select((F.col("id") % 7).alias("x"), (F.col("id") % 2).alias("y"), (F.col("id") % 4).cast("int").alias("fold")), ["x"])
    meet = threading.Barrier(2)

    def fit(train):
        meet.wait(60)  # for another fold's fit
        return K.logistic(train, "y")

    assert [r["fold"] for r in K.cross_validate(df, "y", fit, k=4)] == [0, 1, 2, 3]


@pytest.mark.parametrize("linkage", ["ward", "single"])
def test_lists_of_nearest_clusters_give_the_tree(spark, linkage):
    """Short lists leave much to later lists, rounds and the last task; whatever proves a merge, the tree is the same."""
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(150, 5)), rng.normal(size=(1, 5)) + rng.normal(size=(60, 5)) / 50])
    x = np.vstack([x, x[:20]])  # leaves of weight 2
    leaves = H.leaves(spark.createDataFrame(pd.DataFrame({"v": list(x)})), "v")
    rows = leaves.orderBy("leaf").collect()
    want = lance_williams(np.array([r["v"] for r in rows]), np.array([r["w"] for r in rows]), linkage)
    got = H.merge_table(H.tree(leaves, linkage, block=128, finish=40, near=6), leaves)
    assert np.allclose([m[2] for m in got], [m[2] for m in want], rtol=1e-9)
    assert [(m[0], m[1], m[3]) for m in got] == [(m[0], m[1], m[3]) for m in want]
    proved = H._by_lists(leaves.withColumn("c", F.col("leaf")), linkage, 210, 6).count()
    assert proved > 60  # a round of reciprocal nearest neighbours has far fewer


def test_every_merge_is_returned(spark):
    """A tree of more than 5,000 leaves: no merge is left out, and numbers and sizes are those of the whole tree."""
    df = spark.range(5200).select(F.array((F.col("id") * F.col("id")).cast("double"), F.lit(0.0)).alias("v"))
    _, merges = H.hierarchical(df, "v", 10, "single")
    got = merges.orderBy("step").collect()  # squares: the gaps grow, so every merge adds the next leaf
    assert [tuple(r) for r in got] == [(i, 0 if i == 0 else i + 1, 1 if i == 0 else 5199 + i, 2.0 * i + 1, i + 2) for i in range(5199)]


def test_rounds_do_not_grow_the_plan(spark):
    """What Spark infers about the columns does not double with every round."""
    edges = spark.range(40).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    roots = H.components(edges, 10)
    assert {r["root"] for r in roots.collect()} == {0}
    inferred = roots._jdf.queryExecution().analyzed().constraints().toString()
    assert "least" not in inferred and "coalesce" not in inferred
