"""Chart-ready aggregates (V1–V21): the table each chart would plot.

Every output is bounded (bins, grid points, columns, clusters) regardless of
input rows; drawing itself is out of scope.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distributions import inverse_normal
from ..functions.kernels import chunked_frame, exact_quantiles, few_groups, finish_chunked, with_positions
from .metrics import confusion_matrix, pr_auc, pr_curve, roc_auc, roc_curve
from .profiling import categorical_distribution, radar_rows  # noqa: F401 - V13 is one of the charts


# V1 / V2 --------------------------------------------------------------------
def histogram(df: DataFrame, col: str, nbins: int = 30, by: Sequence[str] = (), density: bool = False) -> DataFrame:
    """Equal-width bins over [min, max]; the max value falls in the last bin; empty bins included.

    Output: *by, bin, lo, hi, count (+ density = count / width).
    """
    by = list(by)
    x = F.col(col).cast("double")
    base = df.select(*by, x.alias("_x")).where(F.col("_x").isNotNull())
    st = base.groupBy(*by).agg(F.min("_x").alias("_mn"), F.max("_x").alias("_mx"))
    st = st.withColumn("_w", (F.col("_mx") - F.col("_mn")) / F.lit(nbins))
    st_j = F.broadcast(st) if not by else st
    b = F.when(F.col("_w") == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - F.col("_mn")) / F.col("_w")), F.lit(nbins - 1))).cast("int")
    counts = base.join(st_j, by, "inner") if by else base.crossJoin(st_j)
    counts = counts.groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = st.select(*by, "_mn", "_w", F.explode(F.sequence(F.lit(0), F.lit(nbins - 1))).alias("bin"))
    out = grid.join(counts, by + ["bin"], "left").select(
        *by, "bin",
        (F.col("_mn") + F.col("bin") * F.col("_w")).alias("lo"),
        (F.col("_mn") + (F.col("bin") + 1) * F.col("_w")).alias("hi"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"),
        F.col("_w"),
    )
    if density:
        out = out.withColumn("density", F.when(F.col("_w") > 0, F.col("count") / F.col("_w")))
    return out.drop("_w")


# V3 -------------------------------------------------------------------------
def kde_curve(df: DataFrame, col: str, points: int = 100) -> DataFrame:
    """Exact Gaussian KDE on a ``points`` grid over [min, max], Scott bandwidth (sigma * n^-1/5).

    The data's range and spread are one row; the curve is then one aggregation
    over the distinct values with a partial sum for each grid point, so no row
    is ever multiplied.
    """
    x = F.col(col).cast("double")
    base = df.select(F.nanvl(x, F.lit(None).cast("double")).alias("_x")).where(F.col("_x").isNotNull())
    st = base.agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("mn"), F.max("_x").alias("mx"), F.stddev_samp("_x").alias("sd")).first()
    schema = "i int, x double, density double"
    if not st["n"] or not st["sd"]:
        return df.sparkSession.createDataFrame([], schema)
    h = st["sd"] * float(st["n"]) ** -0.2
    grid = [st["mn"] + (st["mx"] - st["mn"]) * i / (points - 1) for i in range(points)]
    values = base.groupBy("_x").agg(F.count(F.lit(1)).alias("_c"))
    sums = values.agg(*[F.sum(F.col("_c") * F.exp(-0.5 * F.pow((F.lit(g) - F.col("_x")) / F.lit(h), 2))).alias(f"s{i}")
                        for i, g in enumerate(grid)])
    scale = F.lit(st["n"] * h * math.sqrt(2 * math.pi))
    return sums.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(g).alias("x"), (F.col(f"s{i}") / scale).alias("density"))
        for i, g in enumerate(grid)])).alias("e")).select("e.*")


# V4 -------------------------------------------------------------------------
def pie_shares(df: DataFrame, col: str) -> DataFrame:
    return categorical_distribution(df, col, digits=1)


# V6 -------------------------------------------------------------------------
def box_stats(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), factor: float = 1.5) -> DataFrame:
    """q1, median, q3, whiskers (extreme data within the 1.5*IQR fences), outlier count."""
    by = list(by)
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], by).groupBy(*by, "col_name").agg(
        F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3"),
    )
    # the quartiles of a group side by side: joined once (a row per group) and carried through one aggregation
    cols = list(cols)
    stats = ("q1", "median", "q3")
    wide = q.groupBy(*by).agg(*[F.max(F.when(F.col("col_name") == c, F.col(s))).alias(f"_{s}{i}")
                                for i, c in enumerate(cols) for s in stats])
    rows = df.select(*{*by, *cols}).join(few_groups(wide.checkpoint()), by) if by else df.crossJoin(F.broadcast(wide))
    aggs = []
    for i, c in enumerate(cols):
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        reach = factor * (F.col(f"_q3{i}") - F.col(f"_q1{i}"))
        inside = x.between(F.col(f"_q1{i}") - reach, F.col(f"_q3{i}") + reach)
        aggs += [F.min(F.when(inside, x)).alias(f"_lo{i}"), F.max(F.when(inside, x)).alias(f"_hi{i}"),
                 F.count(F.when(~inside, 1)).alias(f"_out{i}"), *[F.first(f"_{s}{i}").alias(f"_{s}{i}") for s in stats]]
    return rows.groupBy(*by).agg(*aggs).select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("col_name"), *[F.col(f"_{s}{i}").alias(s) for s in stats], F.col(f"_lo{i}").alias("whisker_lo"),
                 F.col(f"_hi{i}").alias("whisker_hi"), F.col(f"_out{i}").alias("n_outliers"))
        for i, c in enumerate(cols)])).alias("e")).select(*by, "e.*").where("q1 IS NOT NULL")


# V9 / R12 -------------------------------------------------------------------
def scatter_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least squares y = intercept + slope*x on pairwise-complete rows: slope, intercept, r2, n."""
    return df.agg(
        F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")).alias("slope"),
        F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")).alias("intercept"),
        F.regr_r2(F.col(y).cast("double"), F.col(x).cast("double")).alias("r2"),
        F.regr_count(F.col(y).cast("double"), F.col(x).cast("double")).alias("n"),
    )


def fit_line(df: DataFrame, x: str, y: str, points: int = 100) -> DataFrame:
    """``points`` evenly spaced points of the fitted line over [min x, max x]."""
    fit = scatter_fit(df, x, y).crossJoin(df.agg(F.min(x).alias("_mn"), F.max(x).alias("_mx")))
    g = fit.select("slope", "intercept", "_mn", "_mx", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    xs = F.col("_mn") + (F.col("_mx") - F.col("_mn")) * F.col("i") / F.lit(points - 1)
    return g.select("i", xs.alias("x"), (F.col("intercept") + F.col("slope") * xs).alias("y"))


# V10 / V11 ------------------------------------------------------------------
def residual_points(scored: DataFrame, y: str, pred: str, keep: Sequence[str] = ()) -> DataFrame:
    return scored.select(*keep, F.col(pred).alias("fitted"), (F.col(y) - F.col(pred)).alias("residual"))


def moving_average(df: DataFrame, value: str, order: Sequence[str], size: int = 30, keys: Sequence[str] = (),
                   out: str = "trend", chunk_rows: int = 1_000_000) -> DataFrame:
    """Centred moving mean over ``size`` rows (rows i-size//2 .. i+size-size//2-1), edges use available rows.

    Split-safe: chunks of ``chunk_rows`` with halo rows.
    """
    before, after = size // 2, size - size // 2 - 1
    halo = max(before, after)
    ch, part, ordc = chunked_frame(df, keys, order, halo, chunk_rows)
    w = Window.partitionBy(*part).orderBy(*ordc).rowsBetween(-before, after)
    return finish_chunked(ch.withColumn(out, F.avg(value).over(w)))


# V18 ------------------------------------------------------------------------
def regression_diagnostics(scored: DataFrame, y: str, pred: str, bins: int = 40) -> dict[str, DataFrame]:
    """The three panels: predicted against actual, the residuals' histogram, residuals against predicted."""
    r = residual_points(scored, y, pred, [F.col(y).alias("actual")])
    return {"predicted": r.select("actual", F.col("fitted").alias("predicted")), "residual_histogram": histogram(r, "residual", bins),
            "residuals": r.select("fitted", "residual")}


def classification_diagnostics(scored: DataFrame, label: str, pred: str, proba: str, importance: DataFrame | None = None) -> dict[str, DataFrame]:
    """The panels: ROC with its area, confusion matrix, precision-recall with its area, and importances if there are any."""
    out = {"roc": roc_curve(scored, label, proba), "roc_auc": roc_auc(scored, label, proba),
           "confusion": confusion_matrix(scored, label, pred), "pr": pr_curve(scored, label, proba), "pr_auc": pr_auc(scored, label, proba)}
    return out | ({"importance": importance} if importance is not None else {})


# V14 ------------------------------------------------------------------------
def weekly_progression(df: DataFrame, key: str, base: str | None, n: int = 20, weeks: int = 16,
                       noise_sd: float = 0.0, seed: int = 42, lo: float = 0.0, hi: float = 21.0) -> DataFrame:
    """For the first ``n`` keys: clip(base + 2*sin(linspace(0, 3*pi, weeks)) + noise, lo, hi); base 5 if absent."""
    first = df.orderBy(key).limit(n)
    b = F.col(base).cast("double") if base else F.lit(5.0)
    wk = first.select(F.col(key), b.alias("_b"), F.explode(F.sequence(F.lit(1), F.lit(weeks))).alias("week"))
    phase = F.lit(3 * math.pi) * (F.col("week") - 1) / F.lit(weeks - 1)
    val = F.col("_b") + 2 * F.sin(phase)
    if noise_sd:
        val = val + F.lit(noise_sd) * F.randn(seed)
    return wk.select(key, "week", F.least(F.greatest(val, F.lit(lo)), F.lit(hi)).alias("value"))


# V20 ------------------------------------------------------------------------
def coefficient_table(spark, names: Sequence[str], coefs: Sequence[float]) -> DataFrame:
    rows = [(n, float(c), abs(float(c))) for n, c in zip(names, coefs)]
    return spark.createDataFrame(rows, "feature string, coefficient double, abs_coef double").orderBy(F.col("abs_coef").desc())


# V12 ------------------------------------------------------------------------
def qq_points(df: DataFrame, value: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Normal QQ points: sorted values vs normal quantiles at Filliben positions.

    m_i = (i - .3175)/(n + .365); m_1 = 1 - .5^(1/n); m_n = .5^(1/n).  Ranks come
    from the ordered layout, normal quantiles from a column expression.  Columns: rank, value, theoretical.
    """
    base = df.where(F.col(value).isNotNull() & ~F.isnan(value))
    n = base.count()
    ranked = with_positions(base, [], [value, *tiebreak])
    i = F.col("_pos") + 1
    m = (F.when(i == 1, F.lit(1 - 0.5 ** (1 / n))).when(i == n, F.lit(0.5 ** (1 / n)))
         .otherwise((i - 0.3175) / F.lit(n + 0.365)))
    return ranked.select(i.alias("rank"), F.col(value).alias("value"), inverse_normal(m).alias("theoretical"))
