"""Classification metrics as aggregations.

Curves are computed from the per-threshold table (one row per distinct
score, a partial+final aggregation) followed by split-safe prefix sums, so
no step needs all scored rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.kernels import lay_out, prefix_sum, previous_values


# K11 ------------------------------------------------------------------------
def confusion_matrix(df: DataFrame, label: str, pred: str, classes=(0, 1)) -> DataFrame:
    """(actual, predicted, count) over the full class grid, zero-filled."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, p) for a in classes for p in classes], "actual int, predicted int")
    counts = df.groupBy(F.col(label).cast("int").alias("actual"), F.col(pred).cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("count"))
    return grid.join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("count", F.lit(0)).cast("long").alias("count"))


# K12 ------------------------------------------------------------------------
def threshold_table(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row per distinct score: positives and negatives at that score."""
    y = F.col(label).cast("long")
    return df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))


def _cumulated(df: DataFrame, label: str, score: str) -> DataFrame:
    t = threshold_table(df, label, score).withColumn("_neg_thr", -F.col("threshold"))
    t = prefix_sum(t, {"cum_pos": "pos", "cum_neg": "neg"}, [], ["_neg_thr"])
    tot = F.broadcast(t.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")))
    return t.crossJoin(tot).drop("_neg_thr")


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct threshold, descending, plus the (0, 0) start (threshold NULL)."""
    c = _cumulated(df, label, score)
    pts = c.select("threshold", (F.col("cum_neg") / F.col("N")).alias("fpr"), (F.col("cum_pos") / F.col("P")).alias("tpr"))
    start = df.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(pts)


# K13 ------------------------------------------------------------------------
def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC (trapezoid) = P(score+ > score-) + 0.5 P(tie), from the threshold table."""
    c = _cumulated(df, label, score)
    contrib = F.col("pos") * (F.col("N") - F.col("cum_neg")) + 0.5 * F.col("pos") * F.col("neg")
    return c.agg((F.sum(contrib) / (F.first("P") * F.first("N"))).alias("roc_auc"))


# K14 ------------------------------------------------------------------------
def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, precision, recall) descending thresholds up to the first full recall, plus (NULL, 1, 0)."""
    c = _cumulated(df, label, score)
    pts = c.where((F.col("cum_pos") - F.col("pos")) < F.col("P")).select(
        "threshold", (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        (F.col("cum_pos") / F.col("P")).alias("recall"))
    end = df.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return pts.unionByName(end)


def pr_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Trapezoid area under the PR curve in recall order."""
    curve = pr_curve(df, label, score).withColumn("_t", F.coalesce(-F.col("threshold"), F.lit(float("-inf"))))
    seg = previous_values(lay_out(curve, [], ["recall", "_t"]), [], {"_pr": "recall", "_pp": "precision"})
    area = (F.col("recall") - F.col("_pr")) * (F.col("precision") + F.col("_pp")) / 2
    return seg.agg(F.coalesce(F.sum(area), F.lit(0.0)).alias("pr_auc"))


# K9 / K6 --------------------------------------------------------------------
def binary_metrics(df: DataFrame, label: str, pred: str, digits: int | None = 4) -> DataFrame:
    """accuracy, precision, recall, f1 for the positive class (0 when undefined)."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    c = df.agg(F.count(F.when((y == 1) & (p == 1), 1)).alias("tp"), F.count(F.when((y == 0) & (p == 1), 1)).alias("fp"),
               F.count(F.when((y == 1) & (p == 0), 1)).alias("fn"), F.count(F.when((y == 0) & (p == 0), 1)).alias("tn"))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    acc = (F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))
    cols = {"accuracy": acc, "precision": prec, "recall": rec, "f1": f1}
    return c.select(*[(F.round(v, digits) if digits is not None else v).alias(k) for k, v in cols.items()])


# K15 ------------------------------------------------------------------------
def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision/recall/f1/support + 'macro avg' + 'weighted avg' rows (undefined -> 0)."""
    y, p = F.col(label).cast("string"), F.col(pred).cast("string")
    # one scan: every (label, prediction) count speaks for its label and for its prediction
    counts = df.groupBy(y.alias("y"), p.alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = F.array(F.struct(F.col("y").alias("cls"), F.lit(True).alias("of_label")),
                    F.struct(F.col("p").alias("cls"), F.lit(False).alias("of_label")))
    per = counts.withColumn("s", F.explode(sides)).where("s.cls IS NOT NULL").groupBy("s.cls").agg(
        F.sum(F.when(F.col("s.of_label") & (F.col("y") == F.col("p")), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(~F.col("s.of_label"), F.col("n")).otherwise(0)).alias("pred_n"),
        F.sum(F.when(F.col("s.of_label"), F.col("n")).otherwise(0)).alias("support"),
    )
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("pred_n")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    per = per.select(F.col("cls").alias("class"), prec.alias("precision"), rec.alias("recall"), "support")
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") /
                                      (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0)))
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                    F.sum("support").alias("support"), F.avg("f1").alias("f1"))
    weighted = per.agg(F.lit("weighted avg").alias("class"),
                       (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
                       F.sum("support").alias("support"),
                       (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"))
    return per.select("class", "precision", "recall", "f1", "support").unionByName(
        macro.select("class", "precision", "recall", "f1", "support")).unionByName(
        weighted.select("class", "precision", "recall", "f1", "support"))


# K19 ------------------------------------------------------------------------
def score_with_fallback(proba: Column | None, raw: Column | None, pred: Column | None) -> Column:
    """P(class 1) if available, else sigmoid(decision value), else the hard label."""
    out = None
    for c in (proba, None if raw is None else 1 / (1 + F.exp(-raw)), None if pred is None else pred.cast("double")):
        if c is None:
            continue
        out = c if out is None else F.coalesce(out, c)
    return out if out is not None else F.lit(None).cast("double")
