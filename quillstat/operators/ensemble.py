"""Weighted model ensemble.

Models are fitted Spark ML ``Transformer``s (or any callable DataFrame ->
DataFrame adding prediction/probability columns).  Voting is per-row column
arithmetic: no shuffle, no driver round trip.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# E3 -------------------------------------------------------------------------
def soft_vote(probas: Mapping[str, Column], weights: Mapping[str, float] | None = None) -> Column:
    """sum(w * p) / max(sum(w), 1e-12); a model without a weight counts 1.0."""
    weights = weights or {}
    num, den = None, 0.0
    for name, p in probas.items():
        w = float(weights.get(name, 1.0))
        term = p * F.lit(w)
        num = term if num is None else num + term
        den += w
    return num / F.lit(max(den, 1e-12))


def hard_vote(preds: Sequence[Column]) -> Column:
    """Majority label per row; ties -> smallest label (NULL votes ignored)."""
    arr = F.filter(F.array(*[p.cast("long") for p in preds]), lambda x: x.isNotNull())
    cands = F.array_distinct(arr)
    scored = F.transform(cands, lambda c: F.struct((-F.size(F.filter(arr, lambda x: x == c))).alias("nc"), c.alias("label")))
    return F.array_min(scored)["label"]


def ensemble_predict(df: DataFrame, probas: Mapping[str, str], preds: Mapping[str, str] | None = None,
                     weights: Mapping[str, float] | None = None, threshold: float = 0.5) -> DataFrame:
    """Soft vote over the models that expose probabilities; hard vote only if none does."""
    if probas:
        avg = soft_vote({k: F.col(v) for k, v in probas.items()}, weights)
        return df.withColumn("ensemble_proba", avg).withColumn(
            "ensemble_pred", (F.col("ensemble_proba") >= F.lit(threshold)).cast("int"))
    if preds:
        return df.withColumn("ensemble_proba", F.lit(None).cast("double")).withColumn(
            "ensemble_pred", hard_vote([F.col(v) for v in preds.values()]).cast("int"))
    return df.withColumn("ensemble_proba", F.lit(None).cast("double")).withColumn("ensemble_pred", F.lit(None).cast("int"))


# E2 / E4 --------------------------------------------------------------------
def predict_all(df: DataFrame, models: Mapping[str, tuple[object, Sequence[str]]],
                assemble: Callable[[DataFrame, Sequence[str]], DataFrame]) -> tuple[DataFrame, dict, dict]:
    """Score every model once; add ``{name}_preds`` / ``{name}_proba``.

    ``models``: name -> (fitted transformer, feature list).  A model whose
    features are missing gets NULL columns and ``{name}_status`` = 'missing_features'
    (never scored on a partial or unscaled matrix).
    """
    out = df
    probas, preds = {}, {}
    for name, (model, feats) in models.items():
        missing = [c for c in feats if c not in df.columns]
        if missing:
            out = out.withColumn(f"{name}_preds", F.lit(None).cast("int")) \
                     .withColumn(f"{name}_proba", F.lit(None).cast("double")) \
                     .withColumn(f"{name}_status", F.lit("missing_features"))
            continue
        scored = model.transform(assemble(out, feats))
        cols = [F.col(c) for c in out.columns]
        extra = [F.col("prediction").cast("int").alias(f"{name}_preds")]
        if "probability" in scored.columns:
            extra.append(vector_to_array("probability")[1].alias(f"{name}_proba"))
            probas[name] = f"{name}_proba"
        else:
            extra.append(F.lit(None).cast("double").alias(f"{name}_proba"))
        extra.append(F.lit("ok").alias(f"{name}_status"))
        preds[name] = f"{name}_preds"
        out = scored.select(*cols, *extra)
    return out, probas, preds


# S12 ------------------------------------------------------------------------
def weights_frame(spark, weights: Mapping[str, float]) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "model string, weight double")


def save_weights(spark, path: str, weights: Mapping[str, float]) -> None:
    """Weights as one JSON object {model: weight} (the reference's format), written through Spark."""
    line = json.dumps({k: float(v) for k, v in weights.items()})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_weights(spark, path: str) -> dict[str, float]:
    """Read the JSON map with Spark (multiLine) -> dict; unreadable -> {}."""
    try:
        row = spark.read.option("multiLine", True).json(path).first()
    except Exception:  # noqa: BLE001 - missing/garbled file means "no weights"
        return {}
    return {} if row is None else {k: float(v) for k, v in row.asDict().items() if v is not None}

