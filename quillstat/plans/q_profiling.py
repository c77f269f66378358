"""Catalog: aggregations and profiling (P*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profiling as P
from .catalog import register, table
from .q_cleaning import INJECTED_SQL, injected_orders

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *LI_NUM]  # every numeric column


def _union(parts):
    return "\nUNION ALL\n".join(parts)


@register("p_group_summary", """SELECT o_orderpriority,
       round(avg(o_totalprice), 2) AS mean, round(stddev_samp(o_totalprice), 2) AS std,
       round(min(o_totalprice), 2) AS min, round(max(o_totalprice), 2) AS max
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority""", ops=("P10",))
def p_group_summary(spark, sf):
    return P.group_summary(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice")


@register("p_describe", _union([
    f"""SELECT '{c}' AS col_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
       round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
       round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM lineitem""" for c in LI_ALL]),
    ops=("P1",))
def p_describe(spark, sf):
    return P.describe(table(spark, sf, "lineitem"), digits=6)


@register("p_cat_distribution", f"""WITH {INJECTED_SQL}
SELECT o_orderpriority AS value, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM injected), 2) AS pct
FROM injected WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority""", ops=("P2",))
def p_cat_distribution(spark, sf):
    return P.categorical_distribution(injected_orders(spark, sf), "o_orderpriority")


@register("p_normalized_counts", _union([
    f"""SELECT '{c}' AS col_name, {c} AS value, round(count(*) / sum(count(*)) OVER (), 3) AS share
FROM orders WHERE {c} IS NOT NULL GROUP BY {c}""" for c in ("o_orderstatus", "o_orderpriority")]), ops=("P3",))
def p_normalized_counts(spark, sf):
    return P.normalized_counts(table(spark, sf, "orders"))


_PAIRS = [(a, b) for a in LI_NUM for b in LI_NUM]


@register("p_corr_matrix", _union([
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 10) AS r FROM lineitem" for a, b in _PAIRS]),
    ops=("P4",))
def p_corr_matrix(spark, sf):
    m = P.corr_matrix(table(spark, sf, "lineitem"), LI_NUM)
    return m.withColumn("r", F.round("r", 10))


@register("p_corr_target", _union([
    f"SELECT '{c}' AS col_name, round(corr({c}, l_extendedprice), 10) AS r FROM lineitem" for c in LI_NUM]),
    ops=("P5",))
def p_corr_target(spark, sf):
    return P.corr_with_target(table(spark, sf, "lineitem"), "l_extendedprice", LI_NUM).withColumn("r", F.round("r", 10))


@register("p_skew_kurtosis", _union([
    f"""SELECT '{c}' AS col_name,
       round(avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5), 8) AS skewness,
       round(avg(power({c} - m, 4)) / power(avg(power({c} - m, 2)), 2) - 3, 8) AS kurtosis
FROM lineitem, (SELECT avg({c}) AS m FROM lineitem)""" for c in LI_NUM]), ops=("P6",))
def p_skew_kurtosis(spark, sf):
    s = P.skew_kurtosis(table(spark, sf, "lineitem"), LI_NUM)
    return s.select("col_name", F.round("skewness", 8).alias("skewness"), F.round("kurtosis", 8).alias("kurtosis"))


@register("p_skew_kurtosis_unbiased", _union([
    f"SELECT '{c}' AS col_name, round(skewness({c}), 8) AS skewness, round(kurtosis({c}), 8) AS kurtosis FROM lineitem"
    for c in LI_NUM]), ops=("P7",))
def p_skew_kurtosis_unbiased(spark, sf):
    s = P.skew_kurtosis(table(spark, sf, "lineitem"), LI_NUM, unbiased=True)
    return s.select("col_name", F.round("skewness", 8).alias("skewness"), F.round("kurtosis", 8).alias("kurtosis"))


@register("p_iqr_outliers", """WITH f AS (SELECT quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS lo,
              quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS hi FROM events)
SELECT event_id, user_id, value FROM events, f WHERE value < f.lo OR value > f.hi""", ops=("P8",))
def p_iqr_outliers(spark, sf):
    return P.iqr_outliers(table(spark, sf, "events").select("event_id", "user_id", "value"), "value")


@register("p_zscore_outliers", "SELECT * FROM (" + _union([
    f"""SELECT '{c}' AS col_name, count(*) FILTER (WHERE abs(({c} - m) / s) > 3) AS n_outliers,
         round(count(*) FILTER (WHERE abs(({c} - m) / s) > 3) * 100.0 / count(*), 2) AS pct
  FROM lineitem, (SELECT avg({c}) AS m, nullif(stddev_samp({c}), 0) AS s FROM lineitem)""" for c in LI_ALL])
    + "\nUNION ALL\n" + """SELECT 'value', count(*) FILTER (WHERE abs((value - m) / s) > 3),
         round(count(*) FILTER (WHERE abs((value - m) / s) > 3) * 100.0 / count(*), 2)
  FROM events, (SELECT avg(value) AS m, nullif(stddev_samp(value), 0) AS s FROM events)) WHERE n_outliers > 0""", ops=("P9",))
def p_zscore_outliers(spark, sf):
    both = P.zscore_outliers(table(spark, sf, "lineitem"), 3.0)
    return both.unionByName(P.zscore_outliers(table(spark, sf, "events"), 3.0).where("col_name = 'value'"))


_INJ_COLS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
             ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]


@register("p_missing_analysis", f"WITH {INJECTED_SQL}\n" + _union([
    f"""SELECT '{c}' AS col_name, count(*) - count({c}) AS n_missing,
       round((count(*) - count({c})) * 100.0 / count(*), 2) AS pct_missing,
       count(DISTINCT {c}) AS n_unique, '{t}' AS dtype FROM injected""" for c, t in _INJ_COLS]), ops=("P11",))
def p_missing_analysis(spark, sf):
    inj = injected_orders(spark, sf).select(*[c for c, _ in _INJ_COLS])
    return P.missing_analysis(inj)


@register("p_missing_report", f"WITH {INJECTED_SQL}\nSELECT * FROM (" + _union([
    f"""SELECT '{c}' AS col_name, count(*) - count({c}) AS n_missing,
       round((count(*) - count({c})) * 100.0 / count(*), 2) AS pct_missing FROM injected""" for c, _ in _INJ_COLS])
    + ") WHERE n_missing > 0", ops=("P12",))
def p_missing_report(spark, sf):
    inj = injected_orders(spark, sf).select(*[c for c, _ in _INJ_COLS])
    return P.missing_report(inj)


@register("p_kpi", """SELECT count(*) AS n_rows, round(avg(o_totalprice), 2) AS mean_o_totalprice,
       round(avg(CAST(o_orderstatus = 'F' AS DOUBLE)) * 100, 2) AS rate_is_f FROM orders""", ops=("P14",))
def p_kpi(spark, sf):
    o = table(spark, sf, "orders").withColumn("is_f", (F.col("o_orderstatus") == "F").cast("int"))
    return P.kpi_row(o, ["o_totalprice"], "is_f")


@register("p_group_mean", """SELECT l_returnflag, round(avg(l_extendedprice), 6) AS mean_l_extendedprice
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag""", ops=("P15", "V5"))
def p_group_mean(spark, sf):
    return P.group_mean(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice", digits=6)


DIMS = [f"e{i}" for i in range(64)]  # the width of the embeddings


def _emb_dims(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(d) for i, d in enumerate(DIMS)])


@register("p_cluster_profiles", "SELECT label, count(*) AS n, " + ", ".join(
    f"round(avg(embedding[{i + 1}]::DOUBLE), 2) AS {d}" for i, d in enumerate(DIMS)) + " FROM embeddings GROUP BY label", ops=("P16",))
def p_cluster_profiles(spark, sf):
    return P.cluster_profiles(_emb_dims(spark, sf), "label", DIMS)


@register("p_value_frequency", "SELECT l_linenumber, count(*) AS count FROM lineitem GROUP BY l_linenumber",
          ops=("P17",))
def p_value_frequency(spark, sf):
    return P.value_frequency(table(spark, sf, "lineitem"), "l_linenumber")


_SC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@register("p_strong_correlations", "WITH m AS (" + _union([
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS r FROM lineitem" for a in _SC for b in _SC if a != b])
    + """)
SELECT col_a, col_b, round(r, 10) AS r, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY col_a ORDER BY r DESC, col_b) AS rank FROM m WHERE abs(r) > 0.3)
WHERE rank <= 3""", ops=("P19",))
def p_strong_correlations(spark, sf):
    s = P.strong_correlations(table(spark, sf, "lineitem"), _SC, 0.3, 3)
    return s.withColumn("r", F.round("r", 10))


@register("p_time_span", """SELECT min(ts) AS ts_min, max(ts) AS ts_max,
       date_diff('microsecond', min(ts), max(ts)) / 1e6 AS duration_s FROM events""", ops=("P22",))
def p_time_span(spark, sf):
    return P.time_span(table(spark, sf, "events"), "ts")


@register("p_vif", """SELECT col_name, round(g11 * g22 / (g11 * g22 - g12 * g12), 8) AS vif FROM (
  SELECT sum(l_quantity * l_quantity) AS g11, sum(l_tax * l_tax) AS g22, sum(l_quantity * l_tax) AS g12 FROM lineitem),
  (VALUES ('l_quantity'), ('l_tax')) v(col_name)""", ops=("P21",))
def p_vif(spark, sf):
    return P.vif(table(spark, sf, "lineitem"), ["l_quantity", "l_tax"]).withColumn("vif", F.round("vif", 8))


_TP_NUM = ["l_quantity", "l_discount"]
_TP_CAT = ["l_returnflag", "l_linestatus", "l_shipdate"]
_TP_ORDER = ["l_shipdate", "l_quantity", "l_discount", "l_returnflag", "l_linestatus"]
_TP_SQL_ORDER = ", ".join(_TP_ORDER)
_SPAN = """printf('%d days %02d:%02d:%02d', CAST(s // 86400 AS BIGINT), CAST(s % 86400 // 3600 AS BIGINT),
       CAST(s % 3600 // 60 AS BIGINT), CAST(s % 60 AS BIGINT))"""
_SPAN_FROM = "(SELECT min(l_shipdate) AS a, max(l_shipdate) AS b, date_diff('second', min(l_shipdate), max(l_shipdate)) AS s FROM lineitem)"


def _lines_sql(rows):
    return "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{t}')" for i, t in rows) + ") v(seq, line)"


@register("p_text_profile", "SELECT 0 AS seq, printf('Data Overview: %d rows', count(*)) AS line FROM lineitem\nUNION ALL " + _lines_sql([
    (1, "Columns: l_quantity, l_discount, l_returnflag, l_linestatus, l_shipdate"), (2, ""), (3, "Numeric Statistics:"),
    (6, ""), (7, "Categorical/Other Columns:"), (14, ""), (15, "Time Range:"), (19, ""), (20, "Sample (3 rows):")]) + "\nUNION ALL " + _union([
    f"""SELECT {4 + i}, printf('  %s: mean=%.4f, std=%.4f, min=%.4f, 25%%=%.4f, 50%%=%.4f, 75%%=%.4f, max=%.4f', '{c}',
       round(avg({c}), 4), round(stddev_samp({c}), 4), round(min({c}), 4), round(quantile_cont({c}, 0.25), 4),
       round(quantile_cont({c}, 0.5), 4), round(quantile_cont({c}, 0.75), 4), round(max({c}), 4)) FROM lineitem"""
    for i, c in enumerate(_TP_NUM)]) + "\nUNION ALL " + _union([
    f"SELECT {8 + 2 * i}, printf('  %s: %d unique values', '{c}', count(DISTINCT {c})) FROM lineitem" for i, c in enumerate(_TP_CAT)])
    + "\nUNION ALL " + _union([
    f"""SELECT {9 + 2 * i}, '    Values: ' || array_to_string(list_sort(list(DISTINCT CAST({c} AS VARCHAR))), ', ') FROM lineitem
HAVING count(DISTINCT {c}) <= 10""" for i, c in enumerate(_TP_CAT)]) + f"""
UNION ALL SELECT 16, '  Earliest: ' || CAST(a AS VARCHAR) FROM {_SPAN_FROM}
UNION ALL SELECT 17, '  Latest: ' || CAST(b AS VARCHAR) FROM {_SPAN_FROM}
UNION ALL SELECT 18, '  Duration: ' || {_SPAN} FROM {_SPAN_FROM}
UNION ALL SELECT * FROM (SELECT CAST(20 + row_number() OVER (ORDER BY {_TP_SQL_ORDER}) AS INTEGER),
       concat('  l_quantity=', l_quantity, ', l_discount=', l_discount, ', l_returnflag=', l_returnflag, ', l_linestatus=', l_linestatus,
              ', l_shipdate=', l_shipdate) FROM lineitem ORDER BY {_TP_SQL_ORDER} LIMIT 3)""", ops=("P18",))
def p_text_profile(spark, sf):
    li = table(spark, sf, "lineitem").select(*_TP_NUM, *_TP_CAT)
    return P.text_profile(li, ts="l_shipdate", order=_TP_ORDER)


_TX_NUM = ["l_quantity", "l_extendedprice"]
_TX_STATS = [("count", "printf('%.1f', CAST(count({c}) AS DOUBLE))"), ("mean", "printf('%.4f', round(avg({c}), 4))"),
             ("std", "printf('%.4f', round(stddev_samp({c}), 4))"), ("min", "printf('%.4f', round(min({c}), 4))"),
             *[(f"{q}%", f"printf('%.4f', round(quantile_cont({{c}}, 0.{q}), 4))") for q in (25, 50, 75)],
             ("max", "printf('%.4f', round(max({c}), 4))")]


@register("p_text_profile_extended", "SELECT 0 AS seq, printf('=== DATASET: %d lignes, 3 colonnes ===', count(*)) AS line FROM lineitem\nUNION ALL "
    + _lines_sql([(1, "Colonnes: l_quantity, l_extendedprice, l_shipdate"), (2, ""), (3, "📊 STATISTIQUES DÉTAILLÉES:"),
                  *[x for i, c in enumerate(_TX_NUM) for x in ((4 + 11 * i, ""), (5 + 11 * i, f"--- {c} ---"))],
                  (26, ""), (27, "⏰ TEMPS:"), (31, ""), (32, "📝 EXEMPLE (5 premières lignes):")]) + "\nUNION ALL "
    + _union([f"SELECT {6 + 11 * i + j}, '  {n}: ' || {e.format(c=c)} FROM lineitem"
              for i, c in enumerate(_TX_NUM) for j, (n, e) in enumerate(_TX_STATS)]) + "\nUNION ALL "
    + _union([f"SELECT {14 + 11 * i}, '  corrélations fortes: [''{_TX_NUM[1 - i]}'']' FROM lineitem HAVING abs(corr(l_quantity, l_extendedprice)) > 0.3"
              for i in range(2)]) + f"""
UNION ALL SELECT 28, '  Début: ' || CAST(a AS VARCHAR) FROM {_SPAN_FROM}
UNION ALL SELECT 29, '  Fin: ' || CAST(b AS VARCHAR) FROM {_SPAN_FROM}
UNION ALL SELECT 30, '  Durée: ' || {_SPAN} FROM {_SPAN_FROM}
UNION ALL SELECT * FROM (SELECT CAST(32 + row_number() OVER (ORDER BY l_shipdate, l_quantity, l_extendedprice) AS INTEGER),
       printf('  Row %d: l_quantity=%.3f, l_extendedprice=%.3f, l_shipdate=%s', row_number() OVER (ORDER BY l_shipdate, l_quantity, l_extendedprice) - 1,
              l_quantity, l_extendedprice, CAST(l_shipdate AS VARCHAR)) FROM lineitem ORDER BY l_shipdate, l_quantity, l_extendedprice LIMIT 5)""", ops=("P19",))
def p_text_profile_extended(spark, sf):
    li = table(spark, sf, "lineitem").select(*_TX_NUM, "l_shipdate")
    return P.text_profile_extended(li, ts="l_shipdate", order=["l_shipdate", *_TX_NUM])


@register("p_snapshot_line", """WITH pk AS (SELECT count(*) AS n FROM (
  SELECT value, max(value) OVER w AS mx, sum(value) OVER w AS sm, count(value) OVER w AS ct, count(*) OVER w AS rws
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))
  WHERE rws = 3 AND ct = 3 AND value = mx AND value > (sm - value) / 2.0)
SELECT printf('rows=%d mean(value)=%.4f mean(user_id)=%.4f peaks=%d', count(*), round(avg(value), 4),
       round(avg(user_id), 4), max(pk.n)) AS line FROM events, pk""", ops=("P20",))
def p_snapshot_line(spark, sf):
    from ..operators.series import find_peaks

    ev = table(spark, sf, "events")
    peaks = find_peaks(ev.select("event_id", "user_id", "ts", "value"), "value", ["ts", "event_id"], ["user_id"], 1)
    return P.snapshot_line(ev, "value", "user_id", peaks)

