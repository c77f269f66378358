"""Dimension reduction.

PCA and LDA are fitted from one (grouped) Gram aggregation; only d x d
matrices reach the driver; projections are column expressions.  The
non-linear 2-D map is landmark MDS (de Silva & Tenenbaum 2004), a scalable
stand-in for t-SNE: L landmarks (bounded) are broadcast and every row is
placed from its distances to them inside ``mapInPandas`` (numpy, Arrow batches).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.kernels import gram, mix_hash


def _centred_scatter(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()):
    """(means, {group: (n, group mean (centred coords), scatter about the group mean)})."""
    cols = list(cols)
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    clean = df.where(cond)
    mrow = clean.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    means = np.array([mrow[f"m{i}"] for i in range(len(cols))], dtype=float)
    names = [f"c{i}" for i in range(len(cols))]
    centred = clean.select(*by, *[(F.col(c).cast("double") - F.lit(float(means[i]))).alias(names[i])
                                  for i, c in enumerate(cols)])
    out = {}
    d = len(cols)
    for r in gram(centred, names, by, listwise=False).collect():
        n = r["n"]
        s = np.array([r[f"s_{a}"] for a in names])
        p = np.zeros((d, d))
        for i, a in enumerate(names):
            for j in range(i, d):
                p[i, j] = p[j, i] = r[f"p_{a}_{names[j]}"]
        mu = s / n
        out[tuple(r[b] for b in by)] = (n, mu, p - n * np.outer(mu, mu))
    return means, out


def _sign_rule(v: np.ndarray) -> np.ndarray:
    """Make the largest-|.| entry positive (first one on near ties)."""
    a = np.abs(v)
    i = int(np.argmax(a >= a.max() * (1 - 1e-9)))
    return v if v[i] >= 0 else -v


@dataclass
class PCAFit:
    features: list[str]
    mean: np.ndarray
    scale: np.ndarray
    components: np.ndarray  # rows = components
    eigenvalues: np.ndarray
    ratio: np.ndarray
    n: int

    @property
    def cumulative(self) -> np.ndarray:
        return np.cumsum(self.ratio)

    @property
    def n_for_95(self) -> int:
        return int(np.searchsorted(self.cumulative, 0.95) + 1)

    def loadings(self) -> np.ndarray:
        return self.components.T * np.sqrt(np.maximum(self.eigenvalues, 0.0))

    def scores(self, k: int | None = None, prefix: str = "pc") -> list[Column]:
        k = k or len(self.features)
        cols = []
        for i in range(k):
            e = F.lit(0.0)
            for j, c in enumerate(self.features):
                e = e + F.lit(float(self.components[i, j] / self.scale[j])) * (F.col(c).cast("double") - F.lit(float(self.mean[j])))
            cols.append(e.alias(f"{prefix}{i + 1}"))
        return cols

    def variance_frame(self, spark) -> DataFrame:
        rows = [(i + 1, float(l), float(r), float(c)) for i, (l, r, c) in
                enumerate(zip(self.eigenvalues, self.ratio, self.cumulative))]
        return spark.createDataFrame(rows, "component int, eigenvalue double, ratio double, cumulative double")

    def loadings_frame(self, spark, k: int | None = None, arrow_scale: float = 3.0) -> DataFrame:
        """(component, feature, weight, loading, arrow) — arrow = loading x 3 for biplots."""
        k = k or len(self.features)
        ld = self.loadings()
        rows = [(i + 1, f, float(self.components[i, j]), float(ld[j, i]), float(ld[j, i] * arrow_scale))
                for i in range(k) for j, f in enumerate(self.features)]
        return spark.createDataFrame(rows, "component int, feature string, weight double, loading double, arrow double")


# D1 / D2 --------------------------------------------------------------------
def pca_fit(df: DataFrame, cols: Sequence[str], standardize: bool = True) -> PCAFit:
    """PCA on (optionally) standardised columns (population sigma, sigma=0 -> 1), covariance ddof 1."""
    cols = list(cols)
    means, groups = _centred_scatter(df, cols)
    n, mu, scat = groups[()]
    mean = means + mu
    if standardize:
        sd = np.sqrt(np.maximum(np.diag(scat) / n, 0.0))
        sd = np.where(sd == 0, 1.0, sd)
    else:
        sd = np.ones(len(cols))
    cov = scat / np.outer(sd, sd) / (n - 1)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1]
    vals, vecs = vals[order], vecs[:, order]
    comps = np.array([_sign_rule(vecs[:, i]) for i in range(len(cols))])
    ratio = vals / vals.sum() if vals.sum() > 0 else np.zeros_like(vals)
    return PCAFit(cols, mean, sd, comps, vals, ratio, int(n))


# D4 -------------------------------------------------------------------------
@dataclass
class LDAFit:
    features: list[str]
    coef: np.ndarray          # discriminant direction, within-class unit variance, sign rule
    w: np.ndarray             # decision weights
    b: float                  # decision bias
    overall_mean: np.ndarray

    def decision(self) -> Column:
        e = F.lit(float(self.b))
        for c, wj in zip(self.features, self.w):
            e = e + F.lit(float(wj)) * F.col(c).cast("double")
        return e

    def projection(self) -> Column:
        e = F.lit(0.0)
        for j, c in enumerate(self.features):
            e = e + F.lit(float(self.coef[j])) * (F.col(c).cast("double") - F.lit(float(self.overall_mean[j])))
        return e


def lda_fit(df: DataFrame, cols: Sequence[str], label: str) -> LDAFit:
    """Binary linear discriminant: w = Sigma^-1 (mu1 - mu0), Sigma = pooled within-class scatter / (n - 2),
    bias from the class priors (labels 0/1)."""
    cols = list(cols)
    means, groups = _centred_scatter(df, cols, [label])
    g0, g1 = groups[(0,)], groups[(1,)]
    n0, mu0, s0 = g0
    n1, mu1, s1 = g1
    n = n0 + n1
    sw = s0 + s1
    sigma = sw / (n - 2)
    w = np.linalg.solve(sigma, mu1 - mu0)
    b = float(-0.5 * (mu1 + mu0) @ w + np.log(n1 / n0)) - float(w @ means)
    within = sw / (n - 2)
    coef = w / np.sqrt(w @ within @ w)
    coef = _sign_rule(coef)
    overall = means + (n0 * mu0 + n1 * mu1) / n
    return LDAFit(cols, coef, w, b, overall)


# D3 -------------------------------------------------------------------------
def landmark_mds(df: DataFrame, vec: str, key: str, landmarks: int = 200, dims: int = 2, seed: int = 42,
                 keep: Sequence[str] = ()) -> DataFrame:
    """2-D embedding by landmark MDS.  Landmarks = the ``landmarks`` smallest key hashes (TakeOrdered,
    bounded); classical MDS on them on the driver; rows triangulated in executors."""
    lm = df.select(F.col(vec).cast("array<double>").alias("v")).orderBy(mix_hash(key, "landmark", seed), key).limit(landmarks).collect()
    L = np.array([r["v"] for r in lm], dtype=float)
    d2 = ((L[:, None, :] - L[None, :, :]) ** 2).sum(-1)
    m = len(L)
    j = np.eye(m) - 1.0 / m
    bmat = -0.5 * j @ d2 @ j
    vals, vecs = np.linalg.eigh(bmat)
    order = np.argsort(vals)[::-1][:dims]
    vals, vecs = np.maximum(vals[order], 1e-12), vecs[:, order]
    pinv = (vecs / np.sqrt(vals)).T  # dims x m
    mean_d2 = d2.mean(axis=0)
    keep = list(keep)
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(f"dim{i + 1}", T.DoubleType()) for i in range(dims)])

    def place(batches):
        for pdf in batches:
            x = np.array(pdf["_v"].tolist(), dtype=float).reshape(len(pdf), -1)
            delta = (x ** 2).sum(1)[:, None] - 2 * x @ L.T + (L ** 2).sum(1)[None, :]
            y = -0.5 * (delta - mean_d2) @ pinv.T
            out = pdf[keep].copy()
            for i in range(dims):
                out[f"dim{i + 1}"] = y[:, i]
            yield out

    src = df.select(*keep, F.col(vec).cast("array<double>").alias("_v"))
    return src.mapInPandas(place, schema)


__all__ = ["pca_fit", "lda_fit", "landmark_mds", "PCAFit", "LDAFit"]
