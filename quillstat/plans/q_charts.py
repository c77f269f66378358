"""Catalog: chart-ready aggregates (V*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import charts as V
from ..operators import profiling as P
from .catalog import register, table
from .q_profiling import DIMS, LI_NUM, _emb_dims


# lineitem has no unique (orderkey, linenumber); this column list is a total order
LI_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
LI_ORDER_SQL = ", ".join(LI_ORDER)


def _rnd(df, cols, digits):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def _hist_sql(tbl, col, nbins, density=False):
    dens = ", CASE WHEN w > 0 THEN coalesce(c.count, 0) / w END AS density" if density else ""
    return f"""WITH s AS (SELECT min({col}) AS mn, max({col}) AS mx, (max({col}) - min({col})) / {nbins} AS w FROM {tbl}),
c AS (SELECT CAST(CASE WHEN w = 0 THEN 0 ELSE least(floor(({col} - mn) / w), {nbins - 1}) END AS INTEGER) AS bin,
             count(*) AS count
      FROM {tbl}, s WHERE {col} IS NOT NULL GROUP BY 1)
SELECT g.bin, mn + g.bin * w AS lo, mn + (g.bin + 1) * w AS hi, coalesce(c.count, 0) AS count{dens}
FROM s, (SELECT CAST(range AS INTEGER) AS bin FROM range({nbins})) g LEFT JOIN c ON c.bin = g.bin"""


@register("v_histogram", _hist_sql("lineitem", "l_extendedprice", 30), ops=("V1", "V18"))
def v_histogram(spark, sf):
    return V.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 30)


@register("v_density_histogram", _hist_sql("events", "value", 100, density=True), ops=("V2",))
def v_density_histogram(spark, sf):
    return V.histogram(table(spark, sf, "events"), "value", 100, density=True)


@register("v_histogram_by_group", """WITH s AS (SELECT l_returnflag, min(l_quantity) AS mn, max(l_quantity) AS mx,
       (max(l_quantity) - min(l_quantity)) / 25 AS w FROM lineitem GROUP BY l_returnflag),
c AS (SELECT l.l_returnflag, CAST(CASE WHEN w = 0 THEN 0 ELSE least(floor((l_quantity - mn) / w), 24) END AS INTEGER) AS bin,
             count(*) AS count FROM lineitem l JOIN s USING (l_returnflag) WHERE l_quantity IS NOT NULL GROUP BY 1, 2)
SELECT s.l_returnflag, g.bin, mn + g.bin * w AS lo, mn + (g.bin + 1) * w AS hi, coalesce(c.count, 0) AS count,
       CASE WHEN w > 0 THEN coalesce(c.count, 0) / w END AS density
FROM s CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(25)) g
LEFT JOIN c ON c.bin = g.bin AND c.l_returnflag = s.l_returnflag""", ops=("V21",))
def v_histogram_by_group(spark, sf):
    return V.histogram(table(spark, sf, "lineitem"), "l_quantity", 25, by=["l_returnflag"], density=True)


@register("v_kde", """WITH s AS (SELECT count(value) AS n, min(value) AS mn, max(value) AS mx,
       stddev_samp(value) * pow(count(value), -0.2) AS h FROM events),
g AS (SELECT i, mn + (mx - mn) * i / 99 AS x, n, h FROM s, (SELECT range AS i FROM range(100)))
SELECT g.i, round(g.x, 9) AS x,
       round(sum(exp(-0.5 * ((g.x - e.value) / g.h) * ((g.x - e.value) / g.h))) / (g.n * g.h * sqrt(2 * pi())), 10) AS density
FROM g, events e WHERE e.value IS NOT NULL GROUP BY g.i, g.x, g.n, g.h""", ops=("V3",))
def v_kde(spark, sf):
    k = V.kde_curve(table(spark, sf, "events"), "value", 100)
    return k.select("i", F.round("x", 9).alias("x"), F.round("density", 10).alias("density"))


@register("v_pie", """SELECT o_orderstatus AS value, count(*) AS count,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS pct FROM orders GROUP BY o_orderstatus""", ops=("V4",))
def v_pie(spark, sf):
    return V.pie_shares(table(spark, sf, "orders"), "o_orderstatus")


@register("v_box_stats", "\nUNION ALL\n".join(f"""SELECT l_returnflag, '{c}' AS col_name, q1, median, q3,
       min({c}) FILTER (WHERE {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_lo,
       max({c}) FILTER (WHERE {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_hi,
       count(*) FILTER (WHERE NOT ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM lineitem JOIN (SELECT l_returnflag, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
                           quantile_cont({c}, 0.75) AS q3 FROM lineitem GROUP BY l_returnflag) q USING (l_returnflag)
WHERE {c} IS NOT NULL GROUP BY l_returnflag, q1, median, q3""" for c in ("l_quantity", "l_extendedprice")), ops=("V6",))
def v_box_stats(spark, sf):
    return V.box_stats(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], by=["l_returnflag"])


@register("v_corr_cells", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 10) AS r FROM lineitem"
    for i, a in enumerate(LI_NUM) for j, b in enumerate(LI_NUM) if i > j), ops=("V7",))
def v_corr_cells(spark, sf):
    return P.corr_lower_cells(table(spark, sf, "lineitem"), LI_NUM).withColumn("r", F.round("r", 10))


_FIT = "(SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept FROM lineitem)"


@register("v_scatter_fit", """SELECT round(regr_slope(l_extendedprice, l_quantity), 8) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 10) AS r2, regr_count(l_extendedprice, l_quantity) AS n
FROM lineitem""", ops=("V9", "R12"))
def v_scatter_fit(spark, sf):
    f = V.scatter_fit(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return f.select(F.round("slope", 8).alias("slope"), F.round("intercept", 6).alias("intercept"),
                    F.round("r2", 10).alias("r2"), F.col("n").cast("long").alias("n"))


@register("v_fit_line", f"""SELECT i, round(x, 9) AS x, round(intercept + slope * x, 6) AS y FROM (
  SELECT i, mn + (mx - mn) * i / 99 AS x, slope, intercept
  FROM {_FIT}, (SELECT min(l_quantity) AS mn, max(l_quantity) AS mx FROM lineitem), (SELECT range AS i FROM range(100)))""",
          ops=("V9",))
def v_fit_line(spark, sf):
    ln = V.fit_line(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 100)
    return ln.select("i", F.round("x", 9).alias("x"), F.round("y", 6).alias("y"))


def _scored_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    fit = F.broadcast(V.scatter_fit(li, "l_quantity", "l_extendedprice").select("slope", "intercept"))
    return li.crossJoin(fit).withColumn("pred", F.col("intercept") + F.col("slope") * F.col("l_quantity"))


@register("v_residuals", f"""SELECT l_orderkey, l_linenumber, round(intercept + slope * l_quantity, 6) AS fitted,
       round(l_extendedprice - (intercept + slope * l_quantity), 6) AS residual FROM lineitem, {_FIT}""",
          ops=("V10", "R8"))
def v_residuals(spark, sf):
    r = V.residual_points(_scored_lineitem(spark, sf), "l_extendedprice", "pred", ["l_orderkey", "l_linenumber"])
    return _rnd(r, ["fitted", "residual"], 6)


@register("v_residual_trend", f"""SELECT l_orderkey, l_linenumber, round(fitted, 6) AS fitted, round(residual, 6) AS residual,
       round(avg(residual) OVER (ORDER BY fitted, {LI_ORDER_SQL} ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING), 4) AS trend
FROM (SELECT {LI_ORDER_SQL}, intercept + slope * l_quantity AS fitted,
             l_extendedprice - (intercept + slope * l_quantity) AS residual FROM lineitem, {_FIT})""", ops=("V11",))
def v_residual_trend(spark, sf):
    r = V.residual_points(_scored_lineitem(spark, sf), "l_extendedprice", "pred", LI_ORDER)
    t = V.moving_average(r, "residual", ["fitted", *LI_ORDER], size=30)
    t = _rnd(t.select("l_orderkey", "l_linenumber", "fitted", "residual", "trend"), ["fitted", "residual"], 6)
    return t.withColumn("trend", F.round("trend", 4))


@register("v_radar", "\nUNION ALL\n".join(
    f"SELECT label, '{d}' AS axis, round(avg(embedding[{i + 1}]::DOUBLE), 2) AS mean FROM embeddings GROUP BY label"
    for i, d in enumerate(DIMS)), ops=("V13",))
def v_radar(spark, sf):
    return V.radar_rows(_emb_dims(spark, sf), "label", DIMS)


@register("v_progression", """SELECT o_orderkey, w AS week,
       round(least(greatest(o_totalprice / 25000.0 + 2 * sin(3 * pi() * (w - 1) / 15), 0), 21), 10) AS value
FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 20), (SELECT CAST(range AS INTEGER) AS w FROM range(1, 17))""",
          ops=("V14",))
def v_progression(spark, sf):
    o = table(spark, sf, "orders").withColumn("base", F.col("o_totalprice") / 25000.0)
    p = V.weekly_progression(o, "o_orderkey", "base", n=20, weeks=16)
    return p.withColumn("value", F.round("value", 10))


@register("v_regression_diagnostics", f"""WITH r AS (SELECT l_extendedprice AS y, intercept + slope * l_quantity AS p FROM lineitem, {_FIT}),
h AS (SELECT min(y - p) AS mn, (max(y - p) - min(y - p)) / 40 AS w FROM r)
SELECT 'predicted' AS panel, round(y, 4) AS x, round(p, 4) AS y, CAST(count(*) AS BIGINT) AS n FROM r GROUP BY ALL
UNION ALL SELECT 'residuals', round(p, 4), round(y - p, 4), count(*) FROM r GROUP BY ALL
UNION ALL SELECT 'residual_histogram', CAST(b AS DOUBLE), round(mn + b * w, 4), coalesce(n, 0)
FROM h, range(40) t(b) LEFT JOIN (SELECT least(floor((y - p - mn) / w), 39) AS bin, count(*) AS n FROM r, h GROUP BY 1) c ON c.bin = t.b""", ops=("V18",))
def v_regression_diagnostics(spark, sf):
    """The three panels as one long table; equal points are one with their number."""
    d = V.regression_diagnostics(_scored_lineitem(spark, sf), "l_extendedprice", "pred")
    points = None
    for name, (x, y) in {"predicted": ("actual", "predicted"), "residuals": ("fitted", "residual")}.items():
        part = d[name].groupBy(F.lit(name).alias("panel"), F.round(x, 4).alias("x"), F.round(y, 4).alias("y")).agg(F.count(F.lit(1)).alias("n"))
        points = part if points is None else points.unionByName(part)
    hist = d["residual_histogram"].select(F.lit("residual_histogram").alias("panel"), F.col("bin").cast("double").alias("x"),
                                          F.round("lo", 4).alias("y"), F.col("count").alias("n"))
    return points.unionByName(hist)
