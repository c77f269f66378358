"""Classifiers.

* Logistic regression / random forest: Spark ML with the reference's
  objective mapped onto Spark's parameters (C -> regParam = 1/(C n)).
* Features are standardised with population sigma as column expressions
  (Spark's StandardScaler uses the sample sigma).
* KNN: distributed exact top-k join — queries and training rows are packed into
  blocks, every block of queries meets every block of rows (numpy), and the
  tasks' top-k merge per query; nothing passes the driver.
* RBF-SVM: random Fourier features (Rahimi & Recht 2007) + LinearSVC + Platt
  scaling (a 1-feature logistic regression on the margin) — an approximation
  of the kernel SVM that scales linearly; named as such in the API.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .metrics import binary_metrics, roc_auc


# --------------------------------------------------------------------------- features

def standardize_exprs(df: DataFrame, features: Sequence[str]):
    """Population mean/sigma (one aggregation) -> list of standardised column expressions."""
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(features)]).first()
    exprs = []
    for i, c in enumerate(features):
        sd = row[f"s{i}"] or 0.0
        sd = sd if sd > 0 else 1.0
        exprs.append(((F.col(c).cast("double") - F.lit(float(row[f"m{i}"] or 0.0))) / F.lit(float(sd))).alias(c))
    return exprs


def assemble(df: DataFrame, features: Sequence[str], scaled_exprs=None, out: str = "features") -> DataFrame:
    base = df
    if scaled_exprs is not None:
        keep = [c for c in df.columns if c not in features]
        base = df.select(*keep, *scaled_exprs)
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(base)


# K1 / K2 / K3 ---------------------------------------------------------------
def logistic(train: DataFrame, label: str, C: float = 1.0, max_iter: int = 1000, features_col: str = "features"):
    n = train.count()
    return LogisticRegression(featuresCol=features_col, labelCol=label, regParam=1.0 / (C * n), elasticNetParam=0.0,
                              standardization=False, maxIter=max_iter, tol=1e-8).fit(train)


def random_forest(train: DataFrame, label: str, trees: int = 100, depth: int | None = 8, seed: int = 42,
                  features_col: str = "features"):
    """depth None = the reference's unlimited depth, capped at Spark's maximum of 30.  Deep trees keep each row's node, so
    a level does not walk down from the root again."""
    return RandomForestClassifier(featuresCol=features_col, labelCol=label, numTrees=trees,
                                  maxDepth=30 if depth is None else depth, featureSubsetStrategy="sqrt",
                                  seed=seed, cacheNodeIds=depth is None).fit(train)


# K5 -------------------------------------------------------------------------
class FourierSVM:
    """Approximate RBF-kernel SVM: z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2*gamma), linear SVM, Platt scaling."""

    def __init__(self, n_features: int, gamma: float, dim: int = 200, C: float = 1.0, seed: int = 42):
        rng = np.random.default_rng(seed)
        self.w = rng.normal(0.0, math.sqrt(2 * gamma), size=(dim, n_features))
        self.b = rng.uniform(0, 2 * math.pi, size=dim)
        self.dim, self.C = dim, C
        self.svc = self.platt = None

    def _z(self, df: DataFrame, features_col: str) -> DataFrame:
        """z = sqrt(2/D) cos(W x + b) as one compact higher-order expression (W, b literal, D x d)."""
        x = vector_to_array(features_col)
        w = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in self.w])
        b = F.array(*[F.lit(float(v)) for v in self.b])
        scale = F.lit(math.sqrt(2.0 / self.dim))
        z = F.transform(F.sequence(F.lit(0), F.lit(self.dim - 1)), lambda j: scale * F.cos(
            b[j] + F.aggregate(F.zip_with(w[j], x, lambda a, v: a * v), F.lit(0.0), lambda acc, t: acc + t)))
        return df.withColumn("_z", array_to_vector(z))

    def fit(self, train: DataFrame, label: str, features_col: str = "features"):
        # the iterative solvers scan the features many times: materialise them once
        z = self._z(train, features_col).select(label, "_z").persist()
        try:
            n = z.count()
            self.svc = LinearSVC(featuresCol="_z", labelCol=label, regParam=1.0 / (self.C * n), maxIter=200,
                                 rawPredictionCol="_raw", predictionCol="_svc_pred").fit(z)
            m = self.svc.transform(z).withColumn("_margin", array_to_vector(F.array(vector_to_array("_raw")[1])))
            self.platt = LogisticRegression(featuresCol="_margin", labelCol=label, regParam=0.0).fit(m)
        finally:
            z.unpersist()
        return self

    def transform(self, df: DataFrame, features_col: str = "features") -> DataFrame:
        z = self._z(df, features_col)
        m = self.svc.transform(z).withColumn("_margin", array_to_vector(F.array(vector_to_array("_raw")[1])))
        out = self.platt.transform(m.drop("_svc_pred"))
        return out.drop("_z", "_raw", "_margin")


# K4 -------------------------------------------------------------------------
#: Queries of a block that are compared at a time.
_STRIP = 256


def _pack(key: str, vec: str, size: int):
    """Rows -> blocks of at most ``size`` rows: their keys and one float64 matrix."""

    def fn(batches):
        for pdf in batches:
            for at in range(0, len(pdf), size):
                part = pdf.iloc[at:at + size]
                mat = np.array(part[vec].tolist(), dtype=np.float64)
                yield pd.DataFrame({"keys": [part[key].tolist()], "mat": [mat.tobytes()]})

    return fn


class _Nearest:
    """The k nearest rows met so far of one block of queries."""

    def __init__(self, pair, k: int):
        self.at, self.k, self.keys = pair.q_at, k, np.array(pair.qkeys)
        self.q = np.frombuffer(pair.qmat).reshape(len(self.keys), -1)
        self.norms = (self.q ** 2).sum(1)
        self.asked = np.column_stack([self.q, np.ones(len(self.q))])
        self.found: dict = {}  # strip -> queries, squared distances and keys, in order
        self.kth = np.full(len(self.q), np.inf)

    def meet(self, pair) -> None:
        keys = np.array(pair.keys)
        t = np.frombuffer(pair.mat).reshape(len(keys), -1)
        tn = (t ** 2).sum(1)
        against = np.column_stack([-2 * t, tn]).T
        room = np.empty((min(_STRIP, len(self.q)), len(t)))
        few = min(self.k, len(t))
        # the expanded form rounds in proportion to the norms: whatever may still be among the k is computed exactly
        slack = 16 * t.shape[1] * np.finfo(float).eps * (self.norms + tn.max())
        for at in range(0, len(self.q), _STRIP):
            s = slice(at, at + _STRIP)
            part = np.matmul(self.asked[s], against, out=room[:len(self.q[s])])  # less the queries' own norms
            most = self.kth[s] - self.norms[s]
            if np.isinf(most).any():
                most = np.minimum(most, np.partition(part, few - 1, axis=1)[:, few - 1])
            qi, ti = np.nonzero(part <= (most + slack[s])[:, None])
            if len(qi):
                diff = self.q[s][qi] - t[ti]
                self._add(at, qi, (diff * diff).sum(1), keys[ti])

    def _add(self, at: int, qi: np.ndarray, d2: np.ndarray, keys: np.ndarray) -> None:
        if at in self.found:
            qi, d2, keys = (np.concatenate(x) for x in zip(self.found[at], (qi, d2, keys)))
        order = pd.DataFrame({"q": qi, "d2": d2, "t": keys}).sort_values(["q", "d2", "t"]).index if keys.dtype == object else np.lexsort((keys, d2, qi))
        qi, d2, keys = qi[order], d2[order], keys[order]
        rank = np.arange(len(qi)) - np.searchsorted(qi, qi)
        keep = rank < self.k
        self.found[at] = qi, d2, keys = qi[keep], d2[keep], keys[keep]
        full = rank[keep] == self.k - 1
        self.kth[at + qi[full]] = d2[full]

    def rows(self) -> Iterator[pd.DataFrame]:
        for at, (qi, d2, keys) in self.found.items():
            yield pd.DataFrame({"_q": self.keys[at + qi], "_t": keys, "d2": d2})


def _local_topk(k: int):
    """The k nearest of the rows that a task meets for each query: a block of queries meets one block of rows after
    another, and only what is as near as its k-th so far is measured and kept."""

    def fn(batches):
        held = None
        for pair in (pair for batch in batches for pair in batch.itertuples(index=False)):
            if held is None or held.at != pair.q_at:
                if held is not None:
                    yield from held.rows()
                held = _Nearest(pair, k)
            held.meet(pair)
        if held is not None:
            yield from held.rows()

    return fn


def knn_join(queries: DataFrame, train: DataFrame, qkey: str, tkey: str, vec: str, k: int,
             keep: Sequence[str] = (), block: int = 2048) -> DataFrame:
    """Exact k nearest train rows (squared Euclidean, ties by train key) for every query row.

    Keys are unique and the vectors of one length.  Queries and rows are packed
    into blocks of at most ``block`` rows, whatever their partitions; each pair of blocks is computed where the
    two are brought together.  A task returns k rows for each query of a block at most, and the merge ranks those.
    Output: (qkey, tkey, d2, rank, *keep from train).
    """
    qt, tt = queries.schema[qkey].dataType, train.schema[tkey].dataType

    def packed(df, key, key_type):
        src = df.where(F.col(vec).isNotNull()).select(F.col(key).alias("_k"), F.col(vec).cast("array<double>").alias("_v"))
        schema = T.StructType([T.StructField("keys", T.ArrayType(key_type)), T.StructField("mat", T.BinaryType())])
        parts = max(1, -(-src.count() // block))
        blocks = src.repartition(parts).mapInPandas(_pack("_k", "_v", block), schema).checkpoint()
        # a task meets some 16 pairs at most, so what it is sent does not grow with the rows
        return blocks.coalesce(min(parts, max(df.sparkSession.sparkContext.defaultParallelism, -(-parts // 4))))

    asked = packed(queries, qkey, qt).withColumnsRenamed({"keys": "qkeys", "mat": "qmat"}).withColumn("q_at", F.monotonically_increasing_id())
    pairs = asked.crossJoin(packed(train, tkey, tt).hint("shuffle_replicate_nl"))  # pairs of blocks, not of rows
    schema = T.StructType([T.StructField("_q", qt), T.StructField("_t", tt), T.StructField("d2", T.DoubleType())])
    cand = pairs.mapInPandas(_local_topk(k), schema)
    w = Window.partitionBy("_q").orderBy("d2", "_t")
    top = cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    top = top.select(F.col("_q").alias(qkey), F.col("_t").alias(tkey), "d2", "rank")
    return top.join(train.select(tkey, *keep), tkey).select(qkey, tkey, "d2", "rank", *keep) if keep else top


def knn_classify(queries: DataFrame, train: DataFrame, qkey: str, tkey: str, vec: str, label: str, k: int = 7):
    """proba = share of class-1 neighbours, prediction = proba > 0.5 (majority)."""
    nn = knn_join(queries, train, qkey, tkey, vec, k, keep=[label])
    return nn.groupBy(qkey).agg(F.avg(F.col(label).cast("double")).alias("proba")).withColumn(
        "prediction", (F.col("proba") > 0.5).cast("int"))


class KNN:
    """The k-nearest-neighbours classifier with the interface of the other models (rows need a unique key)."""

    def __init__(self, key: str, k: int = 7, features_col: str = "features"):
        self.key, self.k, self.features_col = key, k, features_col

    def fit(self, train: DataFrame, label: str) -> KNN:
        self.label = label
        self.train = train.select(F.col(self.key).alias("_tk"), F.col(label).alias("_y"),
                                  vector_to_array(self.features_col).alias("_v"))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        asked = df.select(F.col(self.key).alias("_qk"), vector_to_array(self.features_col).alias("_v"))
        found = knn_classify(asked, self.train, "_qk", "_tk", "_v", "_y", self.k)
        p = F.col("proba")
        return df.join(found, F.col(self.key) == F.col("_qk")).withColumn(
            "probability", array_to_vector(F.array(1 - p, p))).withColumn(
            "prediction", F.col("prediction").cast("double")).drop("_qk", "proba")


# S10 / K18 ------------------------------------------------------------------
def scaled_pipeline(train: DataFrame, features: Sequence[str], fit) -> PipelineModel:
    """Standardising (population sigma), assembling and the model that ``fit`` returns, as one model that Spark ML
    saves and loads: the scaler travels with the coefficients."""
    row = train.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)],
                    *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(features)]).first()
    names = [f"{c}_scaled" for c in features]
    exprs = ", ".join(f"(CAST(`{c}` AS DOUBLE) - {float(row[f'm{i}'] or 0.0)!r}D) / {float(row[f's{i}'] or 1.0)!r}D AS `{n}`"
                      for i, (c, n) in enumerate(zip(features, names)))
    prepare = [SQLTransformer(statement=f"SELECT *, {exprs} FROM __THIS__"),
               VectorAssembler(inputCols=names, outputCol="features")]
    ready = train
    for stage in prepare:
        ready = stage.transform(ready)
    return PipelineModel([*prepare, fit(ready)])


# K6 / K7 / K16 / K17 ---------------------------------------------------------
def evaluate_scored(scored: DataFrame, label: str, pred: str = "prediction", proba: str = "proba") -> DataFrame:
    m = binary_metrics(scored, label, pred)
    a = roc_auc(scored, label, proba).select(F.round("roc_auc", 4).alias("roc_auc"))
    return m.crossJoin(a)


#: Folds of a cross-validation that are fitted at a time.
PARALLEL_FOLDS = 3


def cross_validate(data: DataFrame, label: str, fit, fold: str = "fold", k: int = 5) -> list[dict]:
    """Accuracy and F1 of each fold for the model ``fit`` returns for the others' rows (a fold without rows is left out)."""

    def one(f: int) -> dict | None:
        scored = fit(data.where(F.col(fold) != f)).transform(data.where(F.col(fold) == f))
        m = binary_metrics(scored, label, "prediction", digits=None).first()
        return None if m["accuracy"] is None else {"fold": f, "accuracy": float(m["accuracy"]), "f1": float(m["f1"])}

    with ThreadPool(PARALLEL_FOLDS) as pool:
        out = pool.map(inheritable_thread_target(data.sparkSession)(one), range(k), chunksize=1)
    return [row for row in out if row]


def compare_models(train: DataFrame, test: DataFrame, label: str, models: dict, fold: str | None = "fold") -> DataFrame:
    """One row per model: accuracy, precision, recall, f1, roc_auc on ``test``; mean and population std of the
    folds' F1 on ``train`` (without a fold column neither); and the best model (greatest roc_auc, ties to the smaller name)."""
    out = None
    for name, fit in models.items():
        row = evaluate_scored(proba_col(fit(train).transform(test)), label).select(F.lit(name).alias("model"), "*")
        if fold:
            f1 = [r["f1"] for r in cross_validate(train, label, fit, fold)]
            row = row.withColumns({"cv_f1_mean": F.lit(round(float(np.mean(f1)), 4)), "cv_f1_std": F.lit(round(float(np.std(f1)), 4))})
        out = row if out is None else out.unionByName(row)
    out = out.checkpoint()  # a few rows, each worth several fits
    return out.crossJoin(F.broadcast(best_model(out)))


def best_model(table: DataFrame, metric: str = "roc_auc") -> DataFrame:
    return table.agg(F.min_by("model", F.struct(-F.col(metric), F.col("model"))).alias("best_model"))


def feature_importance(model, features: Sequence[str], spark) -> DataFrame:
    if hasattr(model, "featureImportances"):
        vals = model.featureImportances.toArray()
    elif hasattr(model, "coefficients"):
        vals = np.abs(model.coefficients.toArray())
    else:
        return spark.createDataFrame([], "feature string, importance double")
    rows = sorted(((f, float(v)) for f, v in zip(features, vals)), key=lambda r: -r[1])
    return spark.createDataFrame(rows, "feature string, importance double")


def proba_col(scored: DataFrame, out: str = "proba") -> DataFrame:
    return scored.withColumn(out, vector_to_array("probability")[1])
