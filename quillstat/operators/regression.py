"""Linear models from one Gram aggregation.

All models with a closed form are fitted from the (d+2)x(d+2) augmented Gram
``[1, x, y]^T [1, x, y]`` of globally centred data: one pass for the means,
one pass for the Gram (optionally grouped by fold / size bucket), then
driver-side linear algebra on matrices whose size depends on the number of
features only.  Scoring is a column expression (no UDF).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.kernels import gram, mix_hash


@dataclass
class LinearFit:
    features: list[str]
    coef: np.ndarray
    intercept: float
    n: int
    alpha: float = 0.0
    kind: str = "ols"
    x_mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    x_std_pop: np.ndarray = field(default_factory=lambda: np.zeros(0))
    y_mean: float = 0.0
    sse: float = float("nan")
    xtx_inv: np.ndarray | None = None

    def predict(self, prefix: Column | None = None) -> Column:
        expr = F.lit(float(self.intercept))
        for c, b in zip(self.features, self.coef):
            expr = expr + F.lit(float(b)) * F.col(c).cast("double")
        return expr

    def standardized_coef(self) -> np.ndarray:
        sd = np.where(self.x_std_pop == 0, 1.0, self.x_std_pop)
        return self.coef * sd

    def coefficient_rows(self) -> list[tuple[str, float]]:
        return [("intercept", float(self.intercept))] + [(f, float(b)) for f, b in zip(self.features, self.coef)]


# --------------------------------------------------------------------------- moments

def _clean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.where(cond)


def centred_grams(df: DataFrame, features: Sequence[str], target: str, by: Sequence[str] = ()):
    """Global means (1 row) + augmented Gram of centred [x, y] per group.

    Returns (means ndarray over features+[target], {group tuple: G}) where G is
    the (d+2)x(d+2) matrix over [1, xc_1..xc_d, yc].
    """
    cols = list(features) + [target]
    clean = _clean(df, cols)
    mrow = clean.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    means = np.array([mrow[f"m{i}"] if mrow[f"m{i}"] is not None else 0.0 for i in range(len(cols))], dtype=float)
    names = [f"c{i}" for i in range(len(cols))]
    centred = clean.select(*by, *[(F.col(c).cast("double") - F.lit(float(means[i]))).alias(names[i])
                                  for i, c in enumerate(cols)])
    rows = gram(centred, names, by, listwise=False).collect()  # one row per group: bounded
    out = {}
    d = len(names)
    for r in rows:
        g = np.zeros((d + 1, d + 1))
        g[0, 0] = r["n"]
        for i, a in enumerate(names):
            g[0, i + 1] = g[i + 1, 0] = r[f"s_{a}"] or 0.0
            for j in range(i, d):
                g[i + 1, j + 1] = g[j + 1, i + 1] = r[f"p_{a}_{names[j]}"] or 0.0
        out[tuple(r[b] for b in by)] = g
    return means, out


def _solve(g: np.ndarray, alpha: float = 0.0, l1: float = 0.0):
    """Fit with intercept on augmented centred Gram g over [1, x.., y]; returns (b0c, beta, Sxx)."""
    d = g.shape[0] - 2
    n = g[0, 0]
    mx = g[0, 1:d + 1] / n
    my = g[0, d + 1] / n
    sxx = g[1:d + 1, 1:d + 1] - n * np.outer(mx, mx)
    sxy = g[1:d + 1, d + 1] - n * mx * my
    if l1 > 0:
        beta = _lasso_cd(sxx, sxy, n, l1)
    else:
        beta = np.linalg.lstsq(sxx + alpha * np.eye(d), sxy, rcond=None)[0]
    b0c = my - mx @ beta
    return b0c, beta, sxx


def _lasso_cd(sxx: np.ndarray, sxy: np.ndarray, n: float, alpha: float, tol: float = 1e-12, max_iter: int = 100000):
    """Coordinate descent for (1/2n)||yc - Xc b||^2 + alpha ||b||_1 on the centred Gram."""
    d = len(sxy)
    beta = np.zeros(d)
    thr = n * alpha
    for _ in range(max_iter):
        delta = 0.0
        for j in range(d):
            if sxx[j, j] <= 0:
                continue
            rho = sxy[j] - sxx[j] @ beta + sxx[j, j] * beta[j]
            new = np.sign(rho) * max(abs(rho) - thr, 0.0) / sxx[j, j]
            delta = max(delta, abs(new - beta[j]))
            beta[j] = new
        if delta < tol:
            break
    return beta


def _sse(g: np.ndarray, b0c: float, beta: np.ndarray) -> float:
    theta = np.concatenate([[b0c], beta])
    d1 = len(theta)
    m = g[:d1, :d1]
    b = g[:d1, d1]
    yy = g[d1, d1]
    return float(yy - 2 * theta @ b + theta @ m @ theta)


def _sst(g: np.ndarray) -> float:
    n = g[0, 0]
    d1 = g.shape[0] - 1
    return float(g[d1, d1] - g[0, d1] ** 2 / n)


# --------------------------------------------------------------------------- fits

def fit_linear(df: DataFrame, features: Sequence[str], target: str, alpha: float = 0.0, l1: float = 0.0) -> LinearFit:
    """OLS (alpha=0), ridge (alpha, intercept unpenalised) or lasso (l1, sklearn objective) with intercept."""
    features = list(features)
    means, grams = centred_grams(df, features, target)
    g = grams[()]
    b0c, beta, sxx = _solve(g, alpha, l1)
    n = int(round(g[0, 0]))
    intercept = float(means[-1] + b0c - beta @ means[:-1])
    std = np.sqrt(np.maximum(np.diag(sxx) / n, 0.0))
    fit = LinearFit(features, beta, intercept, n, alpha, "lasso" if l1 else ("ridge" if alpha else "ols"),
                    means[:-1], std, float(means[-1]), _sse(g, b0c, beta))
    # (X^T X)^-1 in original coordinates, for standard errors
    d = len(features)
    xtx = np.zeros((d + 1, d + 1))
    mx = means[:-1] + g[0, 1:d + 1] / g[0, 0]
    xtx[0, 0] = n
    xtx[0, 1:] = xtx[1:, 0] = n * mx
    xtx[1:, 1:] = sxx + n * np.outer(mx, mx)
    fit.xtx_inv = np.linalg.pinv(xtx)
    return fit


def regression_metrics(scored: DataFrame, y: str, pred: str, k: int, digits: int | None = 4) -> DataFrame:
    """r2, adj_r2 (falls back to r2 when n-k-1 <= 0), rmse, mae, mse over the given rows."""
    e = F.col(y) - F.col(pred)
    a = scored.where(F.col(y).isNotNull() & F.col(pred).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("sse"), F.sum(F.abs(e)).alias("sae"),
        F.var_pop(F.col(y)).alias("vy"))
    n = F.col("n")
    r2 = 1 - F.col("sse") / (F.col("vy") * n)
    adj = F.when(n - k - 1 > 0, 1 - (1 - r2) * (n - 1) / (n - k - 1)).otherwise(r2)
    cols = {"r2": r2, "adj_r2": adj, "rmse": F.sqrt(F.col("sse") / n), "mae": F.col("sae") / n, "mse": F.col("sse") / n}
    return a.select(*[(F.round(v, digits) if digits is not None else v).alias(k_) for k_, v in cols.items()])


# R9 -------------------------------------------------------------------------
def cross_val_r2(df: DataFrame, features: Sequence[str], target: str, key: str, k: int = 5, seed: int = 42,
                 alpha: float = 0.0) -> DataFrame:
    """k-fold R² (hash folds) from ONE fold-grouped Gram: train = total - fold, test R² from the fold's Gram.

    Output rows (fold, r2) plus the mean and population std in columns r2_mean, r2_std.
    """
    fdf = df.withColumn("_fold", F.pmod(mix_hash(key, "fold", seed), F.lit(k)).cast("int"))
    _, grams = centred_grams(fdf, features, target, ["_fold"])
    total = sum(grams.values())
    scores = []
    for (f,), g in sorted(grams.items()):
        b0c, beta, _ = _solve(total - g, alpha)
        scores.append((f, 1 - _sse(g, b0c, beta) / _sst(g)))
    arr = np.array([s for _, s in scores])
    spark = df.sparkSession
    return spark.createDataFrame([(int(f), float(s), float(arr.mean()), float(arr.std())) for f, s in scores],
                                 "fold int, r2 double, r2_mean double, r2_std double")


# R11 ------------------------------------------------------------------------
def train_run(split: DataFrame, features: Sequence[str], target: str, key: str, flag: str = "is_test", k: int = 5) -> dict:
    """Fit on the training rows of ``split``; ``{"fit", "train", "test", "cv"}``: the model, its metrics on both
    parts, and the cross-validated R² of the training rows."""
    train, test = split.where(~F.col(flag)), split.where(F.col(flag))
    fit = fit_linear(train, features, target)
    scored = {part: regression_metrics(rows.withColumn("_pred", fit.predict()), target, "_pred", len(features))
              for part, rows in (("train", train), ("test", test))}
    return {"fit": fit, **scored, "cv": cross_val_r2(train, features, target, key, k)}


# R10 ------------------------------------------------------------------------
def learning_curve(df: DataFrame, features: Sequence[str], target: str, key: str, k: int = 5, sizes: int = 10,
                   seed: int = 42) -> DataFrame:
    """Train/test R² for nested training sizes (10 %..100 % of each training split), averaged over k folds.

    One aggregation grouped by (fold, size bucket); every (fold, size) model is
    solved on the driver from sums of Gram blocks.
    """
    fdf = df.withColumn("_fold", F.pmod(mix_hash(key, "fold", seed), F.lit(k)).cast("int")).withColumn(
        "_size", F.pmod(mix_hash(key, "size", seed), F.lit(sizes)).cast("int"))
    _, grams = centred_grams(fdf, features, target, ["_fold", "_size"])
    folds = sorted({f for f, _ in grams})
    zero = np.zeros_like(next(iter(grams.values())))
    rows = []
    for s in range(sizes):
        tr_scores, te_scores, n_train = [], [], []
        for f in folds:
            train = sum((g for (ff, ss), g in grams.items() if ff != f and ss <= s), zero)
            test = sum((g for (ff, _), g in grams.items() if ff == f), zero)
            if train[0, 0] <= len(features) + 1:
                continue
            b0c, beta, _ = _solve(train)
            tr_scores.append(1 - _sse(train, b0c, beta) / _sst(train))
            te_scores.append(1 - _sse(test, b0c, beta) / _sst(test))
            n_train.append(train[0, 0])
        if tr_scores:
            rows.append(((s + 1) / sizes, float(np.mean(n_train)), float(np.mean(tr_scores)), float(np.mean(te_scores))))
    return df.sparkSession.createDataFrame(rows, "train_fraction double, train_size double, train_r2 double, test_r2 double")


# R14 / R16 / R15 -------------------------------------------------------------
def jarque_bera(df: DataFrame, resid: str) -> DataFrame:
    """JB = n/6 (g1² + g2²/4) from biased moments over all rows; p = exp(-JB/2) (chi² with 2 df)."""
    a = df.agg(F.count(resid).alias("n"), F.skewness(resid).alias("g1"), F.kurtosis(resid).alias("g2"))
    jb = F.col("n") / 6.0 * (F.col("g1") * F.col("g1") + F.col("g2") * F.col("g2") / 4.0)
    return a.select("n", jb.alias("jb"), F.exp(-jb / 2).alias("p_value"))


def breusch_pagan(df: DataFrame, features: Sequence[str], resid: str) -> DataFrame:
    """LM = n * R² of e² regressed on the features (with intercept); df = #features."""
    e2 = df.withColumn("_e2", F.col(resid) * F.col(resid))
    _, grams = centred_grams(e2, features, "_e2")
    g = grams[()]
    b0c, beta, _ = _solve(g)
    r2 = 1 - _sse(g, b0c, beta) / _sst(g)
    n = g[0, 0]
    lm = n * r2
    dof = len(features)
    p = _chi2_sf(lm, dof)
    return df.sparkSession.createDataFrame([(float(lm), int(dof), float(p))], "lm double, dof int, p_value double")


def coefficient_tests(fit: LinearFit, spark) -> DataFrame:
    """Coefficient, standard error, t and two-sided p (Student t, n-k-1 df) — OLS only."""
    dof = fit.n - len(fit.features) - 1
    sigma2 = fit.sse / dof if dof > 0 else float("nan")
    se = np.sqrt(np.maximum(np.diag(fit.xtx_inv) * sigma2, 0.0))
    names = ["intercept"] + fit.features
    vals = [fit.intercept] + list(fit.coef)
    rows = []
    for nm, b, s in zip(names, vals, se):
        t = b / s if s > 0 else float("nan")
        rows.append((nm, float(b), float(s), float(t), float(_t_two_sided(t, dof)) if dof > 0 else float("nan")))
    return spark.createDataFrame(rows, "feature string, coefficient double, std_error double, t_value double, p_value double")


def _betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b) by continued fraction (Lentz)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _betainc(b, a, 1 - x)
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        m2 = 2 * m
        num = m * (b - m) * x / ((a + m2 - 1) * (a + m2))
        d = 1.0 + num * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + num / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        num = -(a + m) * (a + b + m) * x / ((a + m2) * (a + m2 + 1))
        d = 1.0 + num * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + num / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return math.exp(lbeta) * h / a


def _t_two_sided(t: float, dof: float) -> float:
    if math.isnan(t):
        return float("nan")
    return _betainc(dof / 2.0, 0.5, dof / (dof + t * t))


def _chi2_sf(x: float, k: int) -> float:
    """Upper tail of chi² with k dof (regularised upper incomplete gamma via series / continued fraction)."""
    if x <= 0:
        return 1.0
    a, z = k / 2.0, x / 2.0
    if z < a + 1:
        term = s = 1.0 / a
        ap = a
        for _ in range(1000):
            ap += 1
            term *= z / ap
            s += term
            if abs(term) < abs(s) * 1e-15:
                break
        return 1.0 - s * math.exp(-z + a * math.log(z) - math.lgamma(a))
    tiny = 1e-300
    b = z + 1 - a
    c = 1 / tiny
    d = 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-15:
            break
    return math.exp(-z + a * math.log(z) - math.lgamma(a)) * h
