import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quillstat.operators import classify as K
from quillstat.operators import cluster as U
from quillstat.operators import metrics as M
from quillstat.operators import reduce as D
from quillstat.operators import regression as R


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=(200, 4))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 0.5 * x[:, 2] + rng.normal(0, 0.5, 200) + 10
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(200)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double"), x, y


def test_ols_matches_numpy(planted):
    df, x, y = planted
    fit = R.fit_linear(df, ["a", "b", "c", "d"], "y")
    xa = np.column_stack([np.ones(len(y)), x])
    beta = np.linalg.lstsq(xa, y, rcond=None)[0]
    assert fit.intercept == pytest.approx(beta[0], abs=1e-9)
    assert np.allclose(fit.coef, beta[1:], atol=1e-9)
    m = R.regression_metrics(df.withColumn("p", fit.predict()), "y", "p", 4, digits=None).first()
    assert m["r2"] > 0 and m["rmse"] <= float(np.std(y))


def test_ridge_tends_to_ols_and_lasso_kkt(planted):
    df, x, y = planted
    ols = R.fit_linear(df, ["a", "b", "c", "d"], "y")
    ridge = R.fit_linear(df, ["a", "b", "c", "d"], "y", alpha=1e-9)
    assert np.allclose(ols.coef, ridge.coef, atol=1e-6)
    alpha = 0.1
    lasso = R.fit_linear(df, ["a", "b", "c", "d"], "y", l1=alpha)
    xc, yc = x - x.mean(0), y - y.mean()
    grad = xc.T @ (yc - xc @ lasso.coef) / len(y)
    for g, b in zip(grad, lasso.coef):
        if b != 0:
            assert g == pytest.approx(alpha * np.sign(b), abs=1e-6)
        else:
            assert abs(g) <= alpha + 1e-6


def test_cv_r2_one_job(planted):
    df, _, _ = planted
    cv = R.cross_val_r2(df, ["a", "b", "c", "d"], "y", "id", 5).collect()
    assert len(cv) == 5 and all(r["r2"] > 0.9 for r in cv)


def test_pca_properties(planted):
    df, _, _ = planted
    fit = D.pca_fit(df, ["a", "b", "c", "d"])
    assert np.allclose(fit.components @ fit.components.T, np.eye(4), atol=1e-9)
    assert fit.ratio.sum() == pytest.approx(1.0)
    assert all(np.diff(fit.eigenvalues) <= 1e-12)


def test_auc_perfect_and_roc_endpoints(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.3), (0, 0.1)], "y int, s double")
    assert M.roc_auc(df, "y", "s").first()[0] == 1.0
    pts = M.roc_curve(df, "y", "s").collect()
    assert (pts[0]["fpr"], pts[0]["tpr"]) == (0.0, 0.0)
    assert max(p["fpr"] for p in pts) == 1.0 and max(p["tpr"] for p in pts) == 1.0


def test_silhouette_closed_form_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    pts = np.vstack([rng.normal(0, 1, (15, 3)), rng.normal(5, 1, (12, 3)), rng.normal(-5, 1, (1, 3))])
    lab = [0] * 15 + [1] * 12 + [2]
    df = spark.createDataFrame([(i, [float(v) for v in p], lab[i]) for i, p in enumerate(pts)], "id int, v array<double>, c int")
    got = {r["id"]: r["silhouette"] for r in U.silhouette(df, "v", "c").collect()}
    d2 = ((pts[:, None] - pts[None]) ** 2).sum(-1)
    for i in range(len(pts)):
        own = [j for j in range(len(pts)) if lab[j] == lab[i] and j != i]
        if not own:
            assert got[i] == 0.0
            continue
        a = d2[i, own].mean()
        b = min(d2[i, [j for j in range(len(pts)) if lab[j] == c]].mean() for c in set(lab) - {lab[i]})
        assert got[i] == pytest.approx((b - a) / max(a, b), abs=1e-9)


def test_knn_join_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    train = rng.normal(size=(60, 4))
    query = rng.normal(size=(7, 4))
    t = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(train)], "tid long, v array<double>")
    q = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(query)], "qid long, v array<double>")
    got = K.knn_join(q, t.repartition(3), "qid", "tid", "v", 5, block=3).collect()
    for qi in range(7):
        d = ((train - query[qi]) ** 2).sum(1)
        want = list(np.lexsort((np.arange(60), d))[:5])
        have = [r["tid"] for r in sorted((r for r in got if r["qid"] == qi), key=lambda r: r["rank"])]
        assert have == want


def test_elbow_falls(spark):
    rng = np.random.default_rng(7)
    pts = np.vstack([rng.normal(c, 0.2, (30, 2)) for c in (0, 5, 10)])
    df = spark.createDataFrame([(i, [float(a), float(b)]) for i, (a, b) in enumerate(pts)], "id int, v array<double>")
    df = df.withColumn("features", array_to_vector("v"))
    costs = U.elbow(df, "features", [1, 2, 3], n_init=2).orderBy("k").collect()
    assert costs[0]["inertia"] > costs[1]["inertia"] > costs[2]["inertia"]
