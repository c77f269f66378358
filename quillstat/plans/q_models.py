"""Catalog: splits, regression, metrics, ensemble, reduction, clustering, classification."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..functions.kernels import mix_hash_sql
from ..operators import charts as V
from ..operators import classify as K
from ..operators import cluster as U
from ..operators import ensemble as E
from ..operators import linkage as H
from ..operators import metrics as M
from ..operators import reduce as D
from ..operators import regression as R
from ..operators import splits as S
from ..operators.profiling import cluster_profiles
from .catalog import register, table
from .q_charts import _FIT, _scored_lineitem

_O_SPLIT = mix_hash_sql("o_orderkey", "split")

# ----------------------------------------------------------------------------- splits


@register("r_split", f"SELECT o_orderkey, {_O_SPLIT} % 100 < 20 AS is_test FROM orders", ops=("R1",))
def r_split(spark, sf):
    return S.hash_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 20, 42)


@register("r_stratified_split", f"""SELECT o_orderkey, rn <= floor(0.2 * n_c + 0.5) AS is_test FROM (
  SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus = 'F' ORDER BY {_O_SPLIT}, o_orderkey) AS rn,
         count(*) OVER (PARTITION BY o_orderstatus = 'F') AS n_c FROM orders)""", ops=("R2",))
def r_stratified_split(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    return S.stratified_split(o, "o_orderkey", "y", 0.2, 42).select("o_orderkey", "is_test")


@register("r_folds", f"SELECT o_orderkey, CAST({mix_hash_sql("o_orderkey", "fold")} % 5 AS INTEGER) AS fold FROM orders", ops=("R3",))
def r_folds(spark, sf):
    return S.fold_column(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 5, 42)


@register("r_contiguous_folds", """WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CAST(CASE WHEN i < (n % 7) * (n // 7 + 1) THEN i // (n // 7 + 1)
  ELSE n % 7 + (i - (n % 7) * (n // 7 + 1)) // (n // 7) END AS INTEGER) AS fold FROM o""", ops=("R3",))
def r_contiguous_folds(spark, sf):
    return S.contiguous_folds(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 7)


# ----------------------------------------------------------------------------- regression

Y, X1, X2 = "l_extendedprice", "l_quantity", "l_discount"
_LI_SPLIT, _LI_FOLD = mix_hash_sql("l_orderkey", "split"), mix_hash_sql("l_orderkey", "fold")
_VEC_SPLIT = mix_hash_sql("vec_id", "split")


def _ols2_sql(where: str = "TRUE", alpha: float = 0.0) -> str:
    return f"""m AS (SELECT avg({X1}) AS m1, avg({X2}) AS m2, avg({Y}) AS my, count(*) AS n FROM lineitem WHERE {where}),
s AS (SELECT sum(({X1} - m1) * ({X1} - m1)) + {alpha} AS s11, sum(({X1} - m1) * ({X2} - m2)) AS s12,
             sum(({X2} - m2) * ({X2} - m2)) + {alpha} AS s22, sum(({X1} - m1) * ({Y} - my)) AS s1y,
             sum(({X2} - m2) * ({Y} - my)) AS s2y FROM lineitem, m WHERE {where}),
b AS (SELECT (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM s),
fit AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM b, m)"""


def _coef_sql(alpha=0.0):
    return f"""WITH {_ols2_sql(alpha=alpha)}
SELECT 'intercept' AS feature, round(b0, 6) AS coefficient FROM fit
UNION ALL SELECT '{X1}', round(b1, 6) FROM fit UNION ALL SELECT '{X2}', round(b2, 6) FROM fit"""


def _coef_frame(spark, fit: R.LinearFit):
    return spark.createDataFrame(fit.coefficient_rows(), "feature string, coefficient double").withColumn(
        "coefficient", F.round("coefficient", 6))


@register("r_ols", _coef_sql(), ops=("R4",))
def r_ols(spark, sf):
    return _coef_frame(spark, R.fit_linear(table(spark, sf, "lineitem"), [X1, X2], Y))


@register("r_ridge", _coef_sql(alpha=1.0), ops=("R6",))
def r_ridge(spark, sf):
    return _coef_frame(spark, R.fit_linear(table(spark, sf, "lineitem"), [X1, X2], Y, alpha=1.0))


@register("r_standardised", f"""WITH {_ols2_sql()}
SELECT 'intercept' AS feature, round(my, 6) AS coefficient FROM m
UNION ALL SELECT '{X1}', round(b1 * (SELECT stddev_pop({X1}) FROM lineitem), 6) FROM fit
UNION ALL SELECT '{X2}', round(b2 * (SELECT stddev_pop({X2}) FROM lineitem), 6) FROM fit""", ops=("R5",))
def r_standardised(spark, sf):
    fit = R.fit_linear(table(spark, sf, "lineitem"), [X1, X2], Y)
    rows = [("intercept", fit.y_mean)] + [(f, float(b)) for f, b in zip(fit.features, fit.standardized_coef())]
    return spark.createDataFrame(rows, "feature string, coefficient double").withColumn("coefficient", F.round("coefficient", 6))


@register("v_coef_table", f"""WITH {_ols2_sql()}
SELECT '{X1}' AS feature, round(b1, 6) AS coefficient, round(abs(b1), 6) AS abs_coef FROM fit
UNION ALL SELECT '{X2}', round(b2, 6), round(abs(b2), 6) FROM fit""", ops=("V20",))
def v_coef_table(spark, sf):
    fit = R.fit_linear(table(spark, sf, "lineitem"), [X1, X2], Y)
    t = V.coefficient_table(spark, fit.features, fit.coef)
    return t.select("feature", F.round("coefficient", 6).alias("coefficient"), F.round("abs_coef", 6).alias("abs_coef"))


@register("r_ols_test_metrics", f"""WITH {_ols2_sql(where=f"NOT ({_LI_SPLIT} % 100 < 20)")},
t AS (SELECT {Y} AS y, {Y} - (b0 + b1 * {X1} + b2 * {X2}) AS e FROM lineitem, fit WHERE {_LI_SPLIT} % 100 < 20),
a AS (SELECT count(*) AS n, sum(e * e) AS sse, sum(abs(e)) AS sae, var_pop(y) AS vy FROM t)
SELECT round(1 - sse / (vy * n), 4) AS r2,
       round(CASE WHEN n - 3 > 0 THEN 1 - (sse / (vy * n)) * (n - 1) / (n - 3) ELSE 1 - sse / (vy * n) END, 4) AS adj_r2,
       round(sqrt(sse / n), 4) AS rmse, round(sae / n, 4) AS mae, round(sse / n, 4) AS mse FROM a""", ops=("R4",))
def r_ols_test_metrics(spark, sf):
    li = S.hash_split(table(spark, sf, "lineitem"), "l_orderkey", 20, 42)
    fit = R.fit_linear(li.where(~F.col("is_test")), [X1, X2], Y)
    scored = li.where(F.col("is_test")).withColumn("pred", fit.predict())
    return R.regression_metrics(scored, Y, "pred", k=2)


def _split_metrics_sql(part: str) -> str:
    where = {"train": f"NOT ({_LI_SPLIT} % 100 < 20)", "test": f"{_LI_SPLIT} % 100 < 20"}[part]
    return f"""SELECT '{part}' AS part, round(1 - sse / (vy * n), 4) AS r2, round(sqrt(sse / n), 4) AS rmse, round(sae / n, 4) AS mae
FROM (SELECT count(*) AS n, sum(e * e) AS sse, sum(abs(e)) AS sae, var_pop(y) AS vy
      FROM (SELECT {Y} AS y, {Y} - (b0 + b1 * {X1} + b2 * {X2}) AS e FROM lineitem, fit WHERE {where}))"""


@register("r_train_pipeline", f"""WITH {_ols2_sql(where=f"NOT ({_LI_SPLIT} % 100 < 20)")}
{_split_metrics_sql("train")} UNION ALL {_split_metrics_sql("test")}""", ops=("R11",))
def r_train_pipeline(spark, sf):
    """The training run's train and test metrics (its cross-validation is ``r_cv_r2``)."""
    li = S.hash_split(table(spark, sf, "lineitem"), "l_orderkey", 20, 42)
    run = R.train_run(li, [X1, X2], Y, "l_orderkey")
    return run["train"].withColumn("part", F.lit("train")).unionByName(run["test"].withColumn("part", F.lit("test"))).select(
        "part", "r2", "rmse", "mae")


@register("r_cv_r2", f"""WITH d AS (SELECT *, CAST({_LI_FOLD} % 5 AS INTEGER) AS fold FROM lineitem),
f AS (SELECT fold, count(*) AS n, sum({X1}) AS a1, sum({X2}) AS a2, sum({Y}) AS ay, sum({X1} * {X1}) AS a11,
             sum({X1} * {X2}) AS a12, sum({X2} * {X2}) AS a22, sum({X1} * {Y}) AS a1y, sum({X2} * {Y}) AS a2y FROM d GROUP BY fold),
t AS (SELECT sum(n) AS n, sum(a1) AS a1, sum(a2) AS a2, sum(ay) AS ay, sum(a11) AS a11, sum(a12) AS a12, sum(a22) AS a22,
             sum(a1y) AS a1y, sum(a2y) AS a2y FROM f),
tr AS (SELECT f.fold, t.n - f.n AS n, (t.a1 - f.a1) / (t.n - f.n) AS m1, (t.a2 - f.a2) / (t.n - f.n) AS m2,
              (t.ay - f.ay) / (t.n - f.n) AS my, t.a11 - f.a11 AS a11, t.a12 - f.a12 AS a12, t.a22 - f.a22 AS a22,
              t.a1y - f.a1y AS a1y, t.a2y - f.a2y AS a2y FROM f, t),
s AS (SELECT fold, m1, m2, my, a11 - n * m1 * m1 AS s11, a12 - n * m1 * m2 AS s12, a22 - n * m2 * m2 AS s22,
             a1y - n * m1 * my AS s1y, a2y - n * m2 * my AS s2y FROM tr),
fit AS (SELECT fold, my - b1 * m1 - b2 * m2 AS b0, b1, b2 FROM (
        SELECT fold, m1, m2, my, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
               (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM s)),
sc AS (SELECT d.fold, 1 - sum(power({Y} - (b0 + b1 * {X1} + b2 * {X2}), 2)) / (var_pop({Y}) * count(*)) AS r2
       FROM d JOIN fit USING (fold) GROUP BY d.fold)
SELECT fold, round(r2, 6) AS r2, round(avg(r2) OVER (), 6) AS r2_mean, round(stddev_pop(r2) OVER (), 6) AS r2_std FROM sc""",
          ops=("R9",))
def r_cv_r2(spark, sf):
    cv = R.cross_val_r2(table(spark, sf, "lineitem"), [X1, X2], Y, "l_orderkey", 5, 42)
    return cv.select("fold", *[F.round(c, 6).alias(c) for c in ("r2", "r2_mean", "r2_std")])


@register("r_lasso", None, ops=("R7",))
def r_lasso(spark, sf):
    return _coef_frame(spark, R.fit_linear(table(spark, sf, "lineitem"), [X1, X2, "l_tax"], Y, l1=0.1))


@register("r_lasso_checks", f"""SELECT unnest(['{X1}', '{X2}', 'l_tax']) AS feature, true AS optimal""", ops=("R7",))
def r_lasso_checks(spark, sf):
    """The optimality conditions of the lasso, from a second pass over the rows: the correlation of a feature with the
    residuals is alpha times the coefficient's sign, or at most alpha where the coefficient is zero."""
    li, feats = table(spark, sf, "lineitem"), [X1, X2, "l_tax"]
    fit = R.fit_linear(li, feats, Y, l1=0.1)
    res = li.withColumn("e", F.col(Y) - fit.predict())
    means = res.agg(*[F.avg(c).alias(c) for c in feats]).first()
    row = res.agg(*[F.avg((F.col(c) - F.lit(means[c])) * F.col("e")).alias(c) for c in feats]).first()
    ok = [(c, bool(abs(row[c] - 0.1 * np.sign(b)) < 1e-6 if b else abs(row[c]) <= 0.1 + 1e-6)) for c, b in zip(feats, fit.coef)]
    return spark.createDataFrame(ok, "feature string, optimal boolean")


_LC_SUMS = "count(*) AS n, sum({x}) AS sx, sum({y}) AS sy, sum({x} * {x}) AS sxx, sum({x} * {y}) AS sxy, sum({y} * {y}) AS syy"


@register("r_learning_curve_simple", f"""WITH d AS (SELECT {X1} AS x, {Y} / 1000 AS y, {_LI_FOLD} % 5 AS f, {mix_hash_sql("l_orderkey", "size")} % 10 AS z
  FROM lineitem),
tr AS (SELECT s, k, {_LC_SUMS.format(x="x", y="y")} FROM d, range(10) a(s), range(5) b(k) WHERE f <> k AND z <= s GROUP BY s, k),
te AS (SELECT f AS k, {_LC_SUMS.format(x="x", y="y")} FROM d GROUP BY f),
fit AS (SELECT s, k, n, (sxy - sx * sy / n) / (sxx - sx * sx / n) AS b1,
               (sy - (sxy - sx * sy / n) / (sxx - sx * sx / n) * sx) / n AS b0 FROM tr),
sc AS (SELECT fit.s, fit.n,
              1 - (tr.syy - 2 * b0 * tr.sy - 2 * b1 * tr.sxy + tr.n * b0 * b0 + 2 * b0 * b1 * tr.sx + b1 * b1 * tr.sxx) / (tr.syy - tr.sy * tr.sy / tr.n) AS a,
              1 - (te.syy - 2 * b0 * te.sy - 2 * b1 * te.sxy + te.n * b0 * b0 + 2 * b0 * b1 * te.sx + b1 * b1 * te.sxx) / (te.syy - te.sy * te.sy / te.n) AS b
       FROM fit JOIN tr USING (s, k) JOIN te USING (k))
SELECT round((s + 1) / 10.0, 1) AS train_fraction, round(avg(n), 2) AS train_size, round(avg(a), 6) AS train_r2, round(avg(b), 6) AS test_r2
FROM sc GROUP BY s""", ops=("R10",))
def r_learning_curve_simple(spark, sf):
    """The learning curve of one feature, which SQL can follow in closed form."""
    li = table(spark, sf, "lineitem").withColumn("y1000", F.col(Y) / 1000)
    lc = R.learning_curve(li, [X1], "y1000", "l_orderkey", 5, 10, 42)
    return lc.select(F.round("train_fraction", 1).alias("train_fraction"), F.round("train_size", 2).alias("train_size"),
                     F.round("train_r2", 6).alias("train_r2"), F.round("test_r2", 6).alias("test_r2"))


@register("r_learning_curve", None, ops=("R10",))
def r_learning_curve(spark, sf):
    return R.learning_curve(table(spark, sf, "lineitem"), [X1, X2], Y, "l_orderkey", 5, 10, 42)


@register("r_coef_std_errors", f"""WITH {_ols2_sql()},
e AS (SELECT sum(power({Y} - (b0 + b1 * {X1} + b2 * {X2}), 2)) / (count(*) - 3) AS s2 FROM lineitem, fit),
v AS (SELECT s2 * s22 / (s11 * s22 - s12 * s12) AS v1, s2 * s11 / (s11 * s22 - s12 * s12) AS v2,
             s2 * (1.0 / n + (m1 * m1 * s22 + m2 * m2 * s11 - 2 * m1 * m2 * s12) / (s11 * s22 - s12 * s12)) AS v0 FROM e, s, m)
SELECT 'intercept' AS feature, round(sqrt(v0), 6) AS std_error, round(b0 / sqrt(v0), 6) AS t_value FROM v, fit
UNION ALL SELECT '{X1}', round(sqrt(v1), 6), round(b1 / sqrt(v1), 6) FROM v, fit
UNION ALL SELECT '{X2}', round(sqrt(v2), 6), round(b2 / sqrt(v2), 6) FROM v, fit""", ops=("R15",))
def r_coef_std_errors(spark, sf):
    t = R.coefficient_tests(R.fit_linear(table(spark, sf, "lineitem"), [X1, X2], Y), spark)
    return t.select("feature", F.round("std_error", 6).alias("std_error"), F.round("t_value", 6).alias("t_value"))


@register("r_coef_tests", None, ops=("R15",))
def r_coef_tests(spark, sf):
    return R.coefficient_tests(R.fit_linear(table(spark, sf, "lineitem"), [X1, X2], Y), spark)


_RESID = f"(SELECT {Y} - (intercept + slope * {X1}) AS e, {X1} FROM lineitem, {_FIT})"


@register("r_jarque_bera", f"""WITH r AS {_RESID}, mu AS (SELECT avg(e) AS mu FROM r),
mo AS (SELECT count(e) AS n, avg(power(e - mu, 2)) AS m2, avg(power(e - mu, 3)) AS m3, avg(power(e - mu, 4)) AS m4 FROM r, mu)
SELECT n, round(n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4.0), 6) AS jb FROM mo""",
          ops=("R14",))
def r_jarque_bera(spark, sf):
    r = _scored_lineitem(spark, sf).withColumn("e", F.col(Y) - F.col("pred"))
    jb = R.jarque_bera(r, "e")
    return jb.select("n", F.round("jb", 6).alias("jb"))


@register("r_breusch_pagan", f"SELECT round(count(*) * power(corr(e * e, {X1}), 2), 6) AS lm, 1 AS dof FROM {_RESID}",
          ops=("R16",))
def r_breusch_pagan(spark, sf):
    r = _scored_lineitem(spark, sf).withColumn("e", F.col(Y) - F.col("pred"))
    bp = R.breusch_pagan(r, [X1], "e")
    return bp.select(F.round("lm", 6).alias("lm"), "dof")


# ----------------------------------------------------------------------------- metrics

def _scored_flags(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select((F.col("l_returnflag") == "R").cast("int").alias("y"), F.col("l_discount").alias("score"),
                     (F.col("l_discount") >= 0.05).cast("int").alias("pred"))


_THR = """t AS (SELECT l_discount AS threshold, sum(CAST(l_returnflag = 'R' AS BIGINT)) AS pos,
             sum(1 - CAST(l_returnflag = 'R' AS BIGINT)) AS neg FROM lineitem GROUP BY l_discount),
c AS (SELECT threshold, pos, neg, sum(pos) OVER (ORDER BY threshold DESC) AS cum_pos,
             sum(neg) OVER (ORDER BY threshold DESC) AS cum_neg, sum(pos) OVER () AS p, sum(neg) OVER () AS nn FROM t)"""


@register("k_confusion", """SELECT g.actual, g.predicted, coalesce(c.count, 0) AS count
FROM (SELECT * FROM (VALUES (0), (1)) a(actual), (VALUES (0), (1)) p(predicted)) g
LEFT JOIN (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS actual, CAST(l_discount >= 0.05 AS INTEGER) AS predicted,
                  count(*) AS count FROM lineitem GROUP BY 1, 2) c USING (actual, predicted)""", ops=("K11", "K9"))
def k_confusion(spark, sf):
    return M.confusion_matrix(_scored_flags(spark, sf), "y", "pred")


@register("k_roc_curve", f"""WITH {_THR}
SELECT NULL::DOUBLE AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL SELECT threshold, round(cum_neg / nn, 12), round(cum_pos / p, 12) FROM c""", ops=("K12",))
def k_roc_curve(spark, sf):
    r = M.roc_curve(_scored_flags(spark, sf), "y", "score")
    return r.select("threshold", F.round("fpr", 12).alias("fpr"), F.round("tpr", 12).alias("tpr"))


@register("k_roc_auc", f"""WITH {_THR}
SELECT round(sum(pos * (nn - cum_neg) + 0.5 * pos * neg) / (max(p) * max(nn)), 10) AS roc_auc FROM c""", ops=("K13",))
def k_roc_auc(spark, sf):
    return M.roc_auc(_scored_flags(spark, sf), "y", "score").select(F.round("roc_auc", 10).alias("roc_auc"))


@register("k_pr_curve", f"""WITH {_THR}
SELECT threshold, round(cum_pos / (cum_pos + cum_neg), 12) AS precision, round(cum_pos / p, 12) AS recall
FROM c WHERE cum_pos - pos < p
UNION ALL SELECT NULL::DOUBLE, 1.0, 0.0""", ops=("K14",))
def k_pr_curve(spark, sf):
    r = M.pr_curve(_scored_flags(spark, sf), "y", "score")
    return r.select("threshold", F.round("precision", 12).alias("precision"), F.round("recall", 12).alias("recall"))


@register("k_pr_auc", f"""WITH {_THR},
pts AS (SELECT threshold, cum_pos / (cum_pos + cum_neg) AS precision, cum_pos / p AS recall FROM c WHERE cum_pos - pos < p
        UNION ALL SELECT NULL, 1.0, 0.0),
o AS (SELECT recall, precision, lag(recall) OVER (ORDER BY recall, coalesce(-threshold, '-inf'::DOUBLE)) AS pr,
             lag(precision) OVER (ORDER BY recall, coalesce(-threshold, '-inf'::DOUBLE)) AS pp FROM pts)
SELECT round(coalesce(sum((recall - pr) * (precision + pp) / 2), 0.0), 10) AS pr_auc FROM o""", ops=("K14",))
def k_pr_auc(spark, sf):
    return M.pr_auc(_scored_flags(spark, sf), "y", "score").select(F.round("pr_auc", 10).alias("pr_auc"))


@register("k_binary_metrics", """WITH c AS (SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
       count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 0 AND p = 0) AS tn
  FROM (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, CAST(l_discount >= 0.05 AS INTEGER) AS p FROM lineitem)),
m AS (SELECT tp, fp, fn, tn, coalesce(tp / nullif(tp + fp, 0), 0.0) AS prec, coalesce(tp / nullif(tp + fn, 0), 0.0) AS rec FROM c)
SELECT round((tp + tn) / (tp + tn + fp + fn), 4) AS accuracy, round(prec, 4) AS precision, round(rec, 4) AS recall,
       round(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END, 4) AS f1 FROM m""", ops=("K9",))
def k_binary_metrics(spark, sf):
    return M.binary_metrics(_scored_flags(spark, sf), "y", "pred")


@register("k_class_report", """WITH yp AS (SELECT CAST(CAST(l_returnflag = 'R' AS INTEGER) AS VARCHAR) AS y,
                     CAST(CAST(l_discount >= 0.05 AS INTEGER) AS VARCHAR) AS p FROM lineitem),
cls AS (SELECT y AS cls FROM yp UNION SELECT p FROM yp),
per AS (SELECT cls AS class, coalesce(count(*) FILTER (WHERE y = cls AND p = cls) / nullif(count(*) FILTER (WHERE p = cls), 0), 0.0) AS precision,
               coalesce(count(*) FILTER (WHERE y = cls AND p = cls) / nullif(count(*) FILTER (WHERE y = cls), 0), 0.0) AS recall,
               count(*) FILTER (WHERE y = cls) AS support FROM cls, yp GROUP BY cls),
per2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM per)
SELECT class, round(precision, 10) AS precision, round(recall, 10) AS recall, round(f1, 10) AS f1, support FROM per2
UNION ALL SELECT 'macro avg', round(avg(precision), 10), round(avg(recall), 10), round(avg(f1), 10), sum(support) FROM per2
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 10), round(sum(recall * support) / sum(support), 10),
       round(sum(f1 * support) / sum(support), 10), sum(support) FROM per2""", ops=("K15",))
def k_class_report(spark, sf):
    r = M.classification_report(_scored_flags(spark, sf), "y", "pred")
    return r.select("class", *[F.round(c, 10).alias(c) for c in ("precision", "recall", "f1")],
                    F.col("support").cast("long").alias("support"))


@register("k_score_fallback", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(CASE WHEN l_returnflag = 'A' THEN l_discount * 10
                  WHEN l_returnflag = 'N' THEN 1 / (1 + exp(-(l_tax * 100 - 4)))
                  ELSE CAST(l_quantity > 25 AS DOUBLE) END, 12) AS score FROM lineitem""", ops=("K19",))
def k_score_fallback(spark, sf):
    li = table(spark, sf, "lineitem")
    proba = F.when(F.col("l_returnflag") == "A", F.col("l_discount") * 10)
    raw = F.when(F.col("l_returnflag") == "N", F.col("l_tax") * 100 - 4)
    pred = (F.col("l_quantity") > 25).cast("int")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     F.round(M.score_with_fallback(proba, raw, pred), 12).alias("score"))


@register("v_classification_diagnostics", f"""WITH {_THR}
SELECT 'roc' AS panel, round(cum_neg / nn, 9) AS x, round(cum_pos / p, 9) AS y FROM c
UNION ALL SELECT 'roc', 0.0, 0.0
UNION ALL SELECT 'pr', round(cum_pos / p, 9), round(cum_pos / (cum_pos + cum_neg), 9) FROM c WHERE cum_pos - pos < p
UNION ALL SELECT 'pr', 0.0, 1.0
UNION ALL SELECT 'confusion', CAST(CAST(l_returnflag = 'R' AS INTEGER) * 2 + CAST(l_discount >= 0.05 AS INTEGER) AS DOUBLE), CAST(count(*) AS DOUBLE)
  FROM lineitem GROUP BY 2
UNION ALL SELECT 'roc_auc', NULL, round(sum(pos * (nn - cum_neg) + 0.5 * pos * neg) / (max(p) * max(nn)), 9) FROM c""", ops=("V18", "K9"))
def v_classification_diagnostics(spark, sf):
    """ROC, precision-recall, confusion cells (2 * actual + predicted) and the ROC's area, as one long table."""
    d = V.classification_diagnostics(_scored_flags(spark, sf).checkpoint(), "y", "pred", "score")
    cols = {"roc": ("fpr", "tpr"), "pr": ("recall", "precision")}
    out = d["confusion"].select(F.lit("confusion").alias("panel"), (F.col("actual") * 2 + F.col("predicted")).cast("double").alias("x"),
                                F.col("count").cast("double").alias("y"))
    for panel, (x, y) in cols.items():
        out = out.unionByName(d[panel].select(F.lit(panel).alias("panel"), F.round(x, 9).alias("x"), F.round(y, 9).alias("y")))
    return out.unionByName(d["roc_auc"].select(F.lit("roc_auc").alias("panel"), F.lit(None).cast("double").alias("x"), F.round("roc_auc", 9).alias("y")))


# ----------------------------------------------------------------------------- ensemble

_E_W = {"m_disc": 2.0, "m_tax": 1.0}  # m_qty has no weight -> 1.0


@register("e_soft_vote", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round((2.0 * l_discount * 10 + 1.0 * l_tax * 12.5 + 1.0 * l_quantity / 50.0) / 4.0, 12) AS ensemble_proba,
       CAST((2.0 * l_discount * 10 + 1.0 * l_tax * 12.5 + 1.0 * l_quantity / 50.0) / 4.0 >= 0.5 AS INTEGER) AS ensemble_pred
FROM lineitem""", ops=("E3",))
def e_soft_vote(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_discount") * 10).alias("p_disc"),
        (F.col("l_tax") * 12.5).alias("p_tax"), (F.col("l_quantity") / 50.0).alias("p_qty"))
    out = E.ensemble_predict(li, {"m_disc": "p_disc", "m_tax": "p_tax", "m_qty": "p_qty"}, weights=_E_W)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                      F.round("ensemble_proba", 12).alias("ensemble_proba"), "ensemble_pred")


@register("e_hard_vote", """SELECT o_orderkey, CASE WHEN (v1 + v2 + v3) >= 2 THEN 1 ELSE 0 END AS ensemble_pred FROM (
  SELECT o_orderkey, CAST(o_totalprice > 200000 AS INTEGER) AS v1, CAST(o_orderstatus = 'F' AS INTEGER) AS v2,
         CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS v3 FROM orders)""", ops=("E3",))
def e_hard_vote(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_totalprice") > 200000).cast("int").alias("v1"),
        (F.col("o_orderstatus") == "F").cast("int").alias("v2"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("v3"))
    out = E.ensemble_predict(o, {}, {"a": "v1", "b": "v2", "c": "v3"})
    return out.select("o_orderkey", "ensemble_pred")


# ----------------------------------------------------------------------------- reduction

PX1, PX2 = "l_quantity", "l_extendedprice"


@register("d_pca_variance", f"""WITH r AS (SELECT corr({PX1}, {PX2}) AS r, count(*) AS n FROM lineitem)
SELECT 1 AS component, round(n / (n - 1.0) * (1 + abs(r)), 9) AS eigenvalue, round((1 + abs(r)) / 2, 9) AS ratio,
       round((1 + abs(r)) / 2, 9) AS cumulative FROM r
UNION ALL SELECT 2, round(n / (n - 1.0) * (1 - abs(r)), 9), round((1 - abs(r)) / 2, 9), 1.0 FROM r""", ops=("D1", "D2", "V16"))
def d_pca_variance(spark, sf):
    fit = D.pca_fit(table(spark, sf, "lineitem"), [PX1, PX2])
    v = fit.variance_frame(spark)
    return v.select("component", *[F.round(c, 9).alias(c) for c in ("eigenvalue", "ratio", "cumulative")])


@register("d_pca_scores", f"""WITH s AS (SELECT avg({PX1}) AS m1, stddev_pop({PX1}) AS s1, avg({PX2}) AS m2, stddev_pop({PX2}) AS s2,
                   sign(corr({PX1}, {PX2})) AS sg FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round((({PX1} - m1) / s1 + sg * ({PX2} - m2) / s2) / sqrt(2), 6) AS pc1,
       round((({PX1} - m1) / s1 - sg * ({PX2} - m2) / s2) / sqrt(2), 6) AS pc2 FROM lineitem, s""", ops=("D1",))
def d_pca_scores(spark, sf):
    li = table(spark, sf, "lineitem")
    fit = D.pca_fit(li, [PX1, PX2])
    sc = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *fit.scores(2))
    return sc.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("pc1", 6).alias("pc1"),
                     F.round("pc2", 6).alias("pc2"))


@register("d_pca_loadings", f"""WITH r AS (SELECT corr({PX1}, {PX2}) AS r, count(*) AS n FROM lineitem)
SELECT 1 AS component, '{PX1}' AS feature, round(sqrt(0.5), 9) AS weight, round(sqrt(0.5 * n / (n - 1.0) * (1 + abs(r))), 9) AS loading FROM r
UNION ALL SELECT 1, '{PX2}', round(sign(r) * sqrt(0.5), 9), round(sign(r) * sqrt(0.5 * n / (n - 1.0) * (1 + abs(r))), 9) FROM r
UNION ALL SELECT 2, '{PX1}', round(sqrt(0.5), 9), round(sqrt(0.5 * n / (n - 1.0) * (1 - abs(r))), 9) FROM r
UNION ALL SELECT 2, '{PX2}', round(-sign(r) * sqrt(0.5), 9), round(-sign(r) * sqrt(0.5 * n / (n - 1.0) * (1 - abs(r))), 9) FROM r""",
          ops=("D1", "V16"))
def d_pca_loadings(spark, sf):
    fit = D.pca_fit(table(spark, sf, "lineitem"), [PX1, PX2])
    ld = fit.loadings_frame(spark)
    return ld.select("component", "feature", F.round("weight", 9).alias("weight"), F.round("loading", 9).alias("loading"))


def doc_table(spark, sf):
    d = table(spark, sf, "documents")
    feats = d.select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("double").alias("n_lines"),
        (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).cast("double").alias("n_spaces"),
        (F.length("text") - F.length(F.regexp_replace("text", "[0-9]", ""))).cast("double").alias("n_digits"),
    )
    return table(spark, sf, "labels").join(feats, "doc_id")


_DOC_SQL = """docs AS (SELECT l.doc_id, l.quality, l.toxic, CAST(d.n_chars AS DOUBLE) AS n_chars,
       CAST(length(d.text) - length(replace(d.text, chr(10), '')) + 1 AS DOUBLE) AS n_lines FROM labels l JOIN documents d USING (doc_id))"""
_LDA_SQL = f"""{_DOC_SQL},
cm AS (SELECT quality, count(*) AS n, avg(n_chars) AS a, avg(n_lines) AS b FROM docs GROUP BY quality),
sw AS (SELECT sum((n_chars - a) * (n_chars - a)) AS saa, sum((n_chars - a) * (n_lines - b)) AS sab,
              sum((n_lines - b) * (n_lines - b)) AS sbb, count(*) AS n FROM docs JOIN cm USING (quality)),
mu AS (SELECT max(a) FILTER (WHERE quality = 1) AS a1, max(b) FILTER (WHERE quality = 1) AS b1,
              max(a) FILTER (WHERE quality = 0) AS a0, max(b) FILTER (WHERE quality = 0) AS b0,
              max(n) FILTER (WHERE quality = 1) AS n1, max(n) FILTER (WHERE quality = 0) AS n0 FROM cm),
w AS (SELECT n, saa, sab, sbb, a0, a1, b0, b1, n0, n1,
             (n - 2) * (sbb * (a1 - a0) - sab * (b1 - b0)) / (saa * sbb - sab * sab) AS wa,
             (n - 2) * (saa * (b1 - b0) - sab * (a1 - a0)) / (saa * sbb - sab * sab) AS wb FROM sw, mu)"""


@register("d_lda_accuracy", f"""WITH {_LDA_SQL}
SELECT round(avg(CAST(CAST((wa * n_chars + wb * n_lines - 0.5 * ((a1 + a0) * wa + (b1 + b0) * wb) + ln(n1 / n0) > 0) AS INTEGER)
                 = quality AS DOUBLE)), 10) AS accuracy FROM docs, w""", ops=("D4",))
def d_lda_accuracy(spark, sf):
    docs = doc_table(spark, sf)
    fit = D.lda_fit(docs, ["n_chars", "n_lines"], "quality")
    pred = (fit.decision() > 0).cast("int")
    return docs.agg(F.round(F.avg((pred == F.col("quality")).cast("double")), 10).alias("accuracy"))


@register("d_lda_coef", f"""WITH {_LDA_SQL},
u AS (SELECT wa / sqrt((wa * wa * saa + 2 * wa * wb * sab + wb * wb * sbb) / (n - 2)) AS ca,
             wb / sqrt((wa * wa * saa + 2 * wa * wb * sab + wb * wb * sbb) / (n - 2)) AS cb FROM w),
g AS (SELECT CASE WHEN (abs(ca) >= abs(cb) AND ca < 0) OR (abs(cb) > abs(ca) AND cb < 0) THEN -1 ELSE 1 END AS sg, ca, cb FROM u)
SELECT 'n_chars' AS feature, round(sg * ca, 9) AS coefficient FROM g UNION ALL SELECT 'n_lines', round(sg * cb, 9) FROM g""",
          ops=("D4", "V21"))
def d_lda_coef(spark, sf):
    fit = D.lda_fit(doc_table(spark, sf), ["n_chars", "n_lines"], "quality")
    rows = [(f, float(c)) for f, c in zip(fit.features, fit.coef)]
    return spark.createDataFrame(rows, "feature string, coefficient double").withColumn("coefficient", F.round("coefficient", 9))


@register("v_lda_histogram", f"""WITH {_LDA_SQL},
u AS (SELECT n, n0, n1, a0, a1, b0, b1, wa / sqrt((wa * wa * saa + 2 * wa * wb * sab + wb * wb * sbb) / (n - 2)) AS ca,
             wb / sqrt((wa * wa * saa + 2 * wa * wb * sab + wb * wb * sbb) / (n - 2)) AS cb FROM w),
g AS (SELECT *, CASE WHEN (abs(ca) >= abs(cb) AND ca < 0) OR (abs(cb) > abs(ca) AND cb < 0) THEN -1 ELSE 1 END AS sg FROM u),
p AS (SELECT quality, sg * (ca * (n_chars - (n0 * a0 + n1 * a1) / n) + cb * (n_lines - (n0 * b0 + n1 * b1) / n)) AS x FROM docs, g),
r AS (SELECT quality, min(x) AS mn, (max(x) - min(x)) / 25 AS w FROM p GROUP BY quality),
c AS (SELECT quality, least(floor((x - mn) / w), 24) AS bin, count(*) AS count FROM p JOIN r USING (quality) GROUP BY ALL)
SELECT r.quality, CAST(b.bin AS INTEGER) AS bin, round(mn + b.bin * w, 6) AS lo, coalesce(c.count, 0) AS count
FROM r CROSS JOIN range(25) b(bin) LEFT JOIN c ON c.quality = r.quality AND c.bin = b.bin""", ops=("V21",))
def v_lda_histogram(spark, sf):
    docs = doc_table(spark, sf)
    fit = D.lda_fit(docs, ["n_chars", "n_lines"], "quality")
    h = V.histogram(docs.withColumn("axis", fit.projection()), "axis", 25, by=["quality"])
    return h.select("quality", "bin", F.round("lo", 6).alias("lo"), "count")


@register("d_landmark_mds", None, ops=("D3", "D6"))
def d_landmark_mds(spark, sf):
    e = table(spark, sf, "embeddings")
    return D.landmark_mds(e, "embedding", "vec_id", landmarks=200, keep=["vec_id", "label"])


# ----------------------------------------------------------------------------- clustering

_EMB_D = "list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: power(x[1]::DOUBLE - x[2]::DOUBLE, 2)))"


def _centroids(spark, sf):
    e = table(spark, sf, "embeddings")
    return U.cluster_table(e, "embedding", "label").select("cid", "mean")


@register("u_assign_nearest", """WITH c AS (SELECT label AS cid, list(m ORDER BY i) AS mean FROM (
    SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, range(1, 65) t(i) GROUP BY label, i) GROUP BY label)
SELECT vec_id, first(cid ORDER BY d2, cid) AS cluster FROM (
  SELECT e.vec_id, c.cid, list_sum(list_transform(list_zip(e.embedding, c.mean), lambda x: power(x[1]::DOUBLE - x[2], 2))) AS d2
  FROM embeddings e, c) GROUP BY vec_id""", ops=("U6",))
def u_assign_nearest(spark, sf):
    e = table(spark, sf, "embeddings")
    return U.assign_nearest(e, "embedding", _centroids(spark, sf)).select("vec_id", "cluster")


_SIL_SQL = f"""p AS (SELECT a.vec_id, a.label AS la, b.label AS lb, {_EMB_D} AS d2 FROM embeddings a, embeddings b),
m AS (SELECT vec_id, la, lb, sum(d2) AS s, count(*) AS n FROM p GROUP BY 1, 2, 3),
ab AS (SELECT vec_id, max(CASE WHEN la = lb THEN CASE WHEN n > 1 THEN s / (n - 1) END END) AS a,
              min(CASE WHEN la <> lb THEN s / n END) AS b, max(CASE WHEN la = lb THEN n END) AS na FROM m GROUP BY vec_id),
sil AS (SELECT vec_id, CASE WHEN na <= 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM ab)"""


@register("u_silhouette", f"WITH {_SIL_SQL} SELECT vec_id, round(silhouette, 8) AS silhouette FROM sil", ops=("U4",))
def u_silhouette(spark, sf):
    s = U.silhouette(table(spark, sf, "embeddings"), "embedding", "label")
    return s.select("vec_id", F.round("silhouette", 8).alias("silhouette"))


_EUCLIDEAN_SQL = _SIL_SQL.replace("sum(d2)", "sum(sqrt(d2))")


@register("u_silhouette_euclidean", f"WITH {_EUCLIDEAN_SQL} SELECT vec_id, round(silhouette, 8) AS silhouette FROM sil", ops=("U4",))
def u_silhouette_euclidean(spark, sf):
    s = U.euclidean_silhouette(table(spark, sf, "embeddings"), "embedding", "label", "vec_id")
    return s.select("vec_id", F.round("silhouette", 8).alias("silhouette"))


@register("u_silhouette_score", f"WITH {_EUCLIDEAN_SQL} SELECT round(avg(silhouette), 8) AS silhouette FROM sil", ops=("U4", "U3"))
def u_silhouette_score(spark, sf):
    s = U.silhouette_score(table(spark, sf, "embeddings"), "embedding", "label")
    return s.select(F.round("silhouette", 8).alias("silhouette"))


def _emb_vectors(spark, sf):
    return table(spark, sf, "embeddings").withColumn("features", array_to_vector(F.col("embedding").cast("array<double>")))


@register("u_kmeans", None, ops=("U1",))
def u_kmeans(spark, sf):
    e = table(spark, sf, "embeddings")
    _, centres = U.kmeans_search(e, "embedding", [10], n_init=10, seed=42)[10]
    return U.assign_nearest(e, "embedding", U.centre_table(spark, centres)).select("vec_id", "label", "cluster")


@register("u_elbow", None, ops=("U2",))
def u_elbow(spark, sf):
    return U.elbow(_emb_vectors(spark, sf), "features", range(1, 11), n_init=10)


@register("u_best_k", None, ops=("U3",))
def u_best_k(spark, sf):
    return U.best_k_by_silhouette(_silhouettes(spark, sf, range(2, 11)))


def _silhouettes(spark, sf, ks):
    clustered = table(spark, sf, "embeddings").where("embedding IS NOT NULL")
    for k, (_, centres) in U.kmeans_search(clustered, "embedding", ks, n_init=10).items():
        clustered = U.assign_nearest(clustered, "embedding", U.centre_table(spark, centres), f"k{k}")
    scores = U.silhouette_score(clustered, "embedding", [f"k{k}" for k in ks])
    return scores.select(F.expr("CAST(substring(cluster, 2) AS INT)").alias("k"), "silhouette")


@register("u_argmax", """SELECT k AS best_k FROM (SELECT l_linenumber AS k, round(avg(l_quantity), 1) AS s FROM lineitem GROUP BY 1)
ORDER BY s DESC, k LIMIT 1""", ops=("U3",))
def u_argmax(spark, sf):
    """The choice among candidates by itself: greatest mean, ties to the smallest."""
    scores = table(spark, sf, "lineitem").groupBy(F.col("l_linenumber").alias("k")).agg(F.round(F.avg("l_quantity"), 1).alias("silhouette"))
    return U.best_k_by_silhouette(scores)


@register("u_kmeans_checks", """SELECT vec_id, true AS nearest, true AS settled, 10 AS clusters, true AS inertia_falls,
true AS inertia_is_cost FROM embeddings""", ops=("U1", "U2", "U6"))
def u_kmeans_checks(spark, sf):
    """No centre is nearer than a vector's own, centres are the means of their vectors, the cost is the sum of the squared
    distances, and more clusters never cost more (all k of the elbow, all starts)."""
    e = table(spark, sf, "embeddings")
    found = U.kmeans_search(e, "embedding", range(1, 11), n_init=10, seed=42, tol=0.0)
    costs = [found[k][0] for k in range(1, 11)]
    cost, centres = found[10]
    near = U.assign_nearest(e, "embedding", U.centre_table(spark, centres))
    centre = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centres])
    away = lambda c: F.aggregate(F.zip_with("embedding", c, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, d: a + d)
    least = F.array_min(F.transform(centre, away))
    own = F.element_at(centre, F.col("cluster") + 1)
    mean = near.select("cluster", F.posexplode("embedding").alias("i", "x")).groupBy("cluster", "i").agg(F.avg("x").alias("m"))
    off = mean.agg(F.max(F.abs(F.col("m") - F.element_at(F.element_at(centre, F.col("cluster") + 1), F.col("i") + 1))).alias("off"))
    total = near.agg(F.sum(away(own)).alias("total"))
    return near.crossJoin(off).crossJoin(total).select(  # one row each
        "vec_id", (away(own) <= least + 1e-9).alias("nearest"), (F.col("off") < 1e-6).alias("settled"), F.lit(len(centres)).alias("clusters"),
        F.lit(all(a >= b for a, b in zip(costs, costs[1:]))).alias("inertia_falls"),
        (F.abs(F.col("total") - F.lit(cost)) < 1e-6 * F.lit(cost)).alias("inertia_is_cost"))


@register("u_ward", None, ops=("U5",))
def u_ward(spark, sf):
    out, _ = H.hierarchical(table(spark, sf, "embeddings"), "embedding", k=10)
    return out.select("vec_id", "label", "cluster")


@register("u_linkages", None, ops=("U5",))
def u_linkages(spark, sf):
    """Cluster of every vector under each of the other linkages."""
    out = None
    for linkage in ("complete", "average", "single"):
        got = H.hierarchical(table(spark, sf, "embeddings"), "embedding", 10, linkage)[0].select(F.lit(linkage).alias("linkage"), "vec_id", "cluster")
        out = got if out is None else out.unionByName(got)
    return out


@register("v_dendrogram", None, ops=("V19",))
def v_dendrogram(spark, sf):
    _, merges = H.hierarchical(table(spark, sf, "embeddings"), "embedding", k=10)
    merges = merges.checkpoint()
    high = sorted(merges.orderBy(F.desc("step")).limit(10).collect())  # what the cut line lies between
    return merges.withColumn("cut_line", F.lit(H.cut_line([tuple(r)[1:] for r in high], 10)))


@register("u_cluster_run", None, ops=("U7", "P16", "V13"))
def u_cluster_run(spark, sf):
    """The full run: model comparison, elbow, and the profile of the best k-means over all features, as one long table."""
    docs = _doc_split(spark, sf).checkpoint()
    compared = _compared(spark, sf, False).unpivot(["model"], ["accuracy", "precision", "recall", "f1", "roc_auc"],
                                                   "item", "value").select(F.lit("models").alias("part"), F.col("model").alias("name"), "item", "value")
    elbow = U.elbow(docs, "features", range(2, 11)).select(
        F.lit("elbow").alias("part"), F.col("k").cast("string").alias("name"), F.lit("inertia").alias("item"), F.col("inertia").alias("value"))
    model, _ = U.kmeans_best(docs, "features", k=3, n_init=10)
    profile = cluster_profiles(model.transform(docs), "cluster", [*DOC_FEATURES, "quality"])
    profile = profile.select("cluster", *[F.col(c).cast("double").alias(c) for c in profile.columns if c != "cluster"])
    rows = profile.unpivot(["cluster"], [c for c in profile.columns if c != "cluster"], "item", "value").select(
        F.lit("profile").alias("part"), F.col("cluster").cast("string").alias("name"), "item", "value")
    return compared.unionByName(elbow).unionByName(rows)


# ----------------------------------------------------------------------------- classification

DOC_FEATURES = ["n_chars", "n_lines", "n_spaces", "n_digits"]


def _doc_split(spark, sf):
    docs = S.hash_split(doc_table(spark, sf), "doc_id", 20, 42).checkpoint()  # the texts are read once
    scaled = K.standardize_exprs(docs.where(~F.col("is_test")), DOC_FEATURES)
    return K.assemble(docs, DOC_FEATURES, scaled)


@register("k_knn_neighbours", f"""WITH q AS (SELECT * FROM embeddings WHERE {_VEC_SPLIT} % 100 < 20),
t AS (SELECT * FROM embeddings WHERE NOT ({_VEC_SPLIT} % 100 < 20))
SELECT q_id AS vec_id, t_id AS neighbour_id, round(d2, 6) AS d2, rank FROM (
  SELECT a.vec_id AS q_id, b.vec_id AS t_id, {_EMB_D} AS d2,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY {_EMB_D}, b.vec_id) AS rank FROM q a, t b) WHERE rank <= 5""",
          ops=("K4",))
def k_knn_neighbours(spark, sf):
    e = S.hash_split(table(spark, sf, "embeddings"), "vec_id", 20, 42)
    q = e.where(F.col("is_test")).select(F.col("vec_id").alias("q_id"), "embedding")
    t = e.where(~F.col("is_test")).select("vec_id", "embedding")
    nn = K.knn_join(q, t, "q_id", "vec_id", "embedding", 5)
    return nn.select(F.col("q_id").alias("vec_id"), F.col("vec_id").alias("neighbour_id"), F.round("d2", 6).alias("d2"), "rank")


@register("k_knn_classify", f"""WITH q AS (SELECT * FROM embeddings WHERE {_VEC_SPLIT} % 100 < 20),
t AS (SELECT * FROM embeddings WHERE NOT ({_VEC_SPLIT} % 100 < 20)),
nn AS (SELECT a.vec_id, CAST(b.label >= 5 AS DOUBLE) AS y,
              row_number() OVER (PARTITION BY a.vec_id ORDER BY {_EMB_D}, b.vec_id) AS rank FROM q a, t b)
SELECT vec_id, round(avg(y), 10) AS proba, CAST(avg(y) > 0.5 AS INTEGER) AS prediction FROM nn WHERE rank <= 7 GROUP BY vec_id""",
          ops=("K4",))
def k_knn_classify(spark, sf):
    e = S.hash_split(table(spark, sf, "embeddings"), "vec_id", 20, 42).withColumn("y", (F.col("label") >= 5).cast("int"))
    q = e.where(F.col("is_test")).select(F.col("vec_id").alias("q_id"), "embedding")
    t = e.where(~F.col("is_test")).select("vec_id", "embedding", "y")
    out = K.knn_classify(q, t, "q_id", "vec_id", "embedding", "y", 7)
    return out.select(F.col("q_id").alias("vec_id"), F.round("proba", 10).alias("proba"), "prediction")


GAMMA = 1.0 / len(DOC_FEATURES)  # standardised features: variance 1 -> 'scale' gamma = 1/d
MODELS = {
    "knn": lambda train: K.KNN("doc_id", 7).fit(train, "quality"),
    "logistic": lambda train: K.logistic(train, "quality"),
    "random_forest": lambda train: K.random_forest(train, "quality", 100, 8),
    "svm_rff": lambda train: K.FourierSVM(len(DOC_FEATURES), GAMMA).fit(train, "quality"),
}


def _compared(spark, sf, cross_validated: bool):
    """The four models on the documents' split, on request cross-validated on stratified folds of the training rows."""
    data = _doc_split(spark, sf).checkpoint()  # labelled rows: every fit scans them
    train, test = data.where(~F.col("is_test")), data.where(F.col("is_test"))
    if cross_validated:
        train = S.stratified_folds(train, "doc_id", "quality", 5, 42).checkpoint()
    return K.compare_models(train, test, "quality", MODELS, "fold" if cross_validated else None)


@register("k_logistic", None, ops=("K1", "K8"))
def k_logistic(spark, sf):
    data = _doc_split(spark, sf)
    model = K.logistic(data.where(~F.col("is_test")), "quality")
    return K.proba_col(model.transform(data.where(F.col("is_test")))).select("doc_id", "quality", "prediction", "proba")


@register("k_random_forest", None, ops=("K2",))
def k_random_forest(spark, sf):
    data = _doc_split(spark, sf)
    model = K.random_forest(data.where(~F.col("is_test")), "quality", 100, 8)
    return K.proba_col(model.transform(data.where(F.col("is_test")))).select("doc_id", "quality", "prediction", "proba")


@register("k_random_forest_deep", None, ops=("K3",))
def k_random_forest_deep(spark, sf):
    data = _doc_split(spark, sf).checkpoint()  # the texts are read once
    model = K.random_forest(data.where(~F.col("is_test")), "quality", 100, None)
    return K.proba_col(model.transform(data.where(F.col("is_test")))).select("doc_id", "quality", "prediction", "proba")


@register("k_svm_rff", None, ops=("K5",))
def k_svm_rff(spark, sf):
    data = _doc_split(spark, sf)
    svm = K.FourierSVM(len(DOC_FEATURES), 1.0 / len(DOC_FEATURES)).fit(data.where(~F.col("is_test")), "quality")
    return K.proba_col(svm.transform(data.where(F.col("is_test")))).select("doc_id", "quality", "prediction", "proba")


@register("k_train_all", None, ops=("K6", "K7", "K10"))
def k_train_all(spark, sf):
    return _compared(spark, sf, cross_validated=True)


@register("v_model_comparison", None, ops=("V17",))
def v_model_comparison(spark, sf):
    return _compared(spark, sf, False).unpivot(["model"], ["accuracy", "precision", "recall", "f1", "roc_auc"], "metric", "value")


@register("k_feature_importance", None, ops=("K17", "V15"))
def k_feature_importance(spark, sf):
    data = _doc_split(spark, sf)
    rf = K.random_forest(data.where(~F.col("is_test")), "quality", 100, 8)
    return K.feature_importance(rf, DOC_FEATURES, spark)


@register("r_stratified_folds", f"""SELECT doc_id, CAST((row_number() OVER (PARTITION BY quality
       ORDER BY {mix_hash_sql("doc_id", "fold")}, doc_id) - 1) % 5 AS INTEGER) AS fold FROM labels""", ops=("R3", "K16"))
def r_stratified_folds(spark, sf):
    return S.stratified_folds(table(spark, sf, "labels"), "doc_id", "quality", 5, 42).select("doc_id", "fold")


@register("k_cv_accuracy", None, ops=("K16",))
def k_cv_accuracy(spark, sf):
    data = S.stratified_folds(_doc_split(spark, sf), "doc_id", "quality", 5, 42).checkpoint()
    rows = []
    for name in ("knn", "logistic"):
        acc = [(r["fold"], r["accuracy"]) for r in K.cross_validate(data, "quality", MODELS[name])]
        values = np.array([a for _, a in acc])
        rows += [(name, f, a, float(values.mean()), float(values.std())) for f, a in acc]
    return spark.createDataFrame(rows, "model string, fold int, accuracy double, mean double, std double")


_DOC_SPLIT = mix_hash_sql("doc_id", "split")


@register("k_model_checks", f"""SELECT model, doc_id, true AS proba_in_range, true AS label_follows
FROM labels, (VALUES ('knn'), ('logistic'), ('random_forest'), ('svm_rff')) m(model)
WHERE doc_id IN (SELECT doc_id FROM documents) AND {_DOC_SPLIT} % 100 < 20""", ops=("K1", "K2", "K4", "K5", "K8"))
def k_model_checks(spark, sf):
    """Every test row gets a probability in [0, 1] from every model, and the label follows from it."""
    data = _doc_split(spark, sf).checkpoint()
    train, test = data.where(~F.col("is_test")), data.where(F.col("is_test"))
    out = None
    for name, fit in MODELS.items():
        p = F.col("proba")
        scored = K.proba_col(fit(train).transform(test)).select(
            F.lit(name).alias("model"), "doc_id", p.between(0.0, 1.0).alias("proba_in_range"),
            (((p > 0.5) == (F.col("prediction") == 1)) | (F.abs(p - 0.5) < 1e-9)).alias("label_follows"))
        out = scored if out is None else out.unionByName(scored)
    return out


@register("e_ensemble_predictions", None, ops=("E2", "E4"))
def e_ensemble_predictions(spark, sf):
    docs = S.hash_split(doc_table(spark, sf), "doc_id", 20, 42)
    train_raw = docs.where(~F.col("is_test"))
    scaled = K.standardize_exprs(train_raw, DOC_FEATURES)

    def assemble(df, feats):
        return K.assemble(df, feats, scaled)

    train = assemble(train_raw, DOC_FEATURES)
    lr = K.logistic(train, "quality")
    rf = K.random_forest(train, "quality", 100, 8)
    models = {"logistic": (lr, DOC_FEATURES), "random_forest": (rf, DOC_FEATURES),
              "live_only": (lr, ["value1", "value2"])}
    wide, probas, preds = E.predict_all(docs.where(F.col("is_test")), models, assemble)
    out = E.ensemble_predict(wide, probas, preds, weights={"logistic": 1.0, "random_forest": 2.0})
    return out.select("doc_id", "logistic_preds", "logistic_proba", "random_forest_preds", "random_forest_proba",
                      "live_only_preds", "live_only_status", "ensemble_pred", "ensemble_proba")
