"""Aggregations and profiling.

Moments are single partial+final aggregations; quantiles come from the exact
banded kernel; correlation is the built-in ``corr`` aggregate (pairwise
complete).  Results are long tables bounded by #columns (or #groups).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.kernels import exact_quantiles, gram, gram_to_numpy, numeric_cols, string_cols


def _total_row(counts: DataFrame, col: str = "count", alias: str = "_total") -> DataFrame:
    """1-row total of an already aggregated frame (bounded, broadcastable)."""
    return F.broadcast(counts.agg(F.sum(col).alias(alias)))


def _number(c: str) -> Column:
    """A column as double, NaN counting as missing."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def _per_column(df: DataFrame, cols: Sequence[str], aggs: dict) -> DataFrame:
    """One wide aggregation, then one row per column: ``col_name`` and the named aggregates."""
    row = df.agg(*[f(_number(c)).alias(f"{name}_{i}") for i, c in enumerate(cols) for name, f in aggs.items()])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col_name"), *[F.col(f"{name}_{i}").alias(name) for name in aggs])
        for i, c in enumerate(cols)])).alias("e")).select("e.*")


# P1 -------------------------------------------------------------------------
def describe(df: DataFrame, cols: Sequence[str] | None = None, digits: int | None = None) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (linear), max — one row per column."""
    cols = list(cols) if cols is not None else numeric_cols(df)
    mom = _per_column(df, cols, {
        "count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max})
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75]).groupBy("col_name").agg(
        F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q25"),
        F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("q50"),
        F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q75"),
    )
    out = mom.join(q, "col_name", "left").select("col_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max")
    if digits is not None:
        out = out.select("col_name", "count", *[F.round(c, digits).alias(c) for c in
                                              ("mean", "std", "min", "q25", "q50", "q75", "max")])
    return out


# P2 / V4 --------------------------------------------------------------------
def categorical_distribution(df: DataFrame, col: str, digits: int = 2) -> DataFrame:
    """count per non-null value and pct of ALL rows (NULLs in the denominator)."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    total = _total_row(counts)
    return counts.crossJoin(total).where(F.col("value").isNotNull()).select(
        "value", "count", F.round(F.col("count") * 100.0 / F.col("_total"), digits).alias("pct"))


# P3 -------------------------------------------------------------------------
def normalized_counts(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 3) -> DataFrame:
    """(column, value, share) for every string column; denominator = non-null rows of the column."""
    cols = list(cols) if cols is not None else string_cols(df)
    long = df.select(*cols).unpivot([], cols, "col_name", "value").where(F.col("value").isNotNull())
    counts = long.groupBy("col_name", "value").agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy("col_name").agg(F.sum("count").alias("_total"))
    return counts.join(totals, "col_name").select(
        "col_name", "value", F.round(F.col("count") / F.col("_total"), digits).alias("share"))


# P4 / V7 --------------------------------------------------------------------
def corr_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Full Pearson matrix in long form (col_a, col_b, r); pairwise-complete."""
    cols = list(cols) if cols is not None else numeric_cols(df)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        entries.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"{i}").alias("r")))
        if a != b:
            entries.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), F.col(f"{i}").alias("r")))
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.col_a", "e.col_b", "e.r")


def corr_lower_cells(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Heatmap cells strictly below the diagonal (the reference masks triu incl. diagonal)."""
    cols = list(cols) if cols is not None else numeric_cols(df)
    order = {c: i for i, c in enumerate(cols)}
    idx = F.create_map(*[x for c, i in order.items() for x in (F.lit(c), F.lit(i))])
    m = corr_matrix(df, cols)
    return m.where(idx[F.col("col_a")] > idx[F.col("col_b")])


# P5 -------------------------------------------------------------------------
def corr_with_target(df: DataFrame, target: str, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, r) of every numeric column with the target (target itself = 1), ordered desc."""
    cols = list(cols) if cols is not None else numeric_cols(df)
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in cols])
    return row.unpivot([], cols, "col_name", "r").orderBy(F.col("r").desc_nulls_last())


# P6 / P7 --------------------------------------------------------------------
def skew_kurtosis(df: DataFrame, cols: Sequence[str] | None = None, unbiased: bool = False) -> DataFrame:
    """Population (biased) skewness / excess kurtosis, or the bias-corrected G1/G2 (pandas)."""
    cols = list(cols) if cols is not None else numeric_cols(df)
    agg = _per_column(df, cols, {"n": F.count, "g1": F.skewness, "g2": F.kurtosis})
    if not unbiased:
        return agg.select("col_name", F.col("g1").alias("skewness"), F.col("g2").alias("kurtosis"))
    n = F.col("n").cast("double")
    skew = F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6))
    return agg.select("col_name", skew.alias("skewness"), kurt.alias("kurtosis"))


# P8 -------------------------------------------------------------------------
def iqr_outliers(df: DataFrame, col: str, factor: float = 1.5) -> DataFrame:
    """Rows strictly outside the fences; NULL is never an outlier."""
    from .cleaning import iqr_fences

    f = F.broadcast(iqr_fences(df, col, factor).select(F.col("lower").alias("_lo"), F.col("upper").alias("_hi")))
    return df.crossJoin(f).where((F.col(col) < F.col("_lo")) | (F.col(col) > F.col("_hi"))).drop("_lo", "_hi")


# P9 -------------------------------------------------------------------------
def zscore_outliers(df: DataFrame, threshold: float = 3.0, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, n_outliers, pct) for columns with at least one |z| > threshold (sample sigma)."""
    cols = list(cols) if cols is not None else numeric_cols(df)
    stats = df.agg(F.count(F.lit(1)).alias("_rows"),
                   *[F.avg(c).alias(f"_m_{i}") for i, c in enumerate(cols)],
                   *[F.nullif(F.stddev_samp(c), F.lit(0.0)).alias(f"_s_{i}") for i, c in enumerate(cols)])
    j = df.crossJoin(F.broadcast(stats))
    counts = j.agg(F.first("_rows").alias("_rows"), *[
        F.count(F.when(F.abs((F.col(c) - F.col(f"_m_{i}")) / F.col(f"_s_{i}")) > threshold, 1)).alias(c)
        for i, c in enumerate(cols)])
    long = counts.unpivot(["_rows"], cols, "col_name", "n_outliers")
    return long.where(F.col("n_outliers") > 0).select(
        "col_name", "n_outliers", F.round(F.col("n_outliers") * 100.0 / F.col("_rows"), 2).alias("pct"))


# P10 ------------------------------------------------------------------------
def group_summary(df: DataFrame, group: str, value: str, digits: int = 2) -> DataFrame:
    """mean/std/min/max per group, rounded; NULL group dropped."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.round(F.avg(value), digits).alias("mean"),
        F.round(F.stddev_samp(value), digits).alias("std"),
        F.round(F.min(value), digits).alias("min"),
        F.round(F.max(value), digits).alias("max"),
    )


# P11 / P12 ------------------------------------------------------------------
def _missing(df: DataFrame, c: str) -> Column:
    gone = F.col(c).isNull()
    return gone | F.isnan(c) if dict(df.dtypes)[c] in ("float", "double") else gone


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, n_missing, pct_missing) of every column; NULL and NaN are missing; one aggregation."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.when(_missing(df, c), 1)).alias(f"m{i}") for i, c in enumerate(cols)])
    entries = F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(f"m{i}").alias("n_missing")) for i, c in enumerate(cols)])
    return row.select("_rows", F.explode(entries).alias("e")).select(
        "e.col_name", "e.n_missing", F.round(F.col("e.n_missing") * 100.0 / F.col("_rows"), 2).alias("pct_missing"))


def missing_analysis(df: DataFrame, approx: bool = False) -> DataFrame:
    """(column, n_missing, pct_missing, n_unique, dtype) ordered by pct desc.

    ``approx`` replaces the exact distinct counts, which shuffle every value, by sketches.
    """
    cols, dtypes = df.columns, dict(df.dtypes)
    distinct = F.approx_count_distinct if approx else F.count_distinct
    row = df.agg(*[distinct(F.when(~_missing(df, c), F.col(c))).alias(f"u{i}") for i, c in enumerate(cols)])
    unique = row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col_name"), F.col(f"u{i}").alias("n_unique"), F.lit(dtypes[c]).alias("dtype"))
        for i, c in enumerate(cols)])).alias("e")).select("e.*")
    return missing_counts(df).join(unique, "col_name").orderBy(F.col("pct_missing").desc(), "col_name")


def missing_report(df: DataFrame) -> DataFrame:
    return missing_counts(df).where(F.col("n_missing") > 0)


# P13 ------------------------------------------------------------------------
def stats_bundle(df: DataFrame, digits: int = 3) -> dict[str, DataFrame]:
    num = numeric_cols(df)
    return {
        "summary": describe(df, num, digits),
        "skew_kurtosis": skew_kurtosis(df, num, unbiased=True),
        "correlations": corr_matrix(df, num),
        "categorical_counts": normalized_counts(df, string_cols(df), digits),
    }


def bundle_rows(bundle: dict[str, DataFrame]) -> DataFrame:
    """A statistics bundle as one long table: frame, col_name, item, value (6 decimals)."""
    out = None
    for frame, df in bundle.items():
        names = [c for c in df.columns if c not in ("col_name", "col_a", "col_b", "value")]
        if frame == "correlations":
            rows = df.select(F.col("col_a").alias("col_name"), F.col("col_b").alias("item"), F.col("r").alias("value"))
        elif frame == "categorical_counts":
            rows = df.select("col_name", F.col("value").alias("item"), F.col("share").alias("value"))
        else:
            rows = df.select("col_name", *[F.col(c).cast("double").alias(c) for c in names]).unpivot(
                ["col_name"], names, "item", "value")
        rows = rows.select(F.lit(frame).alias("frame"), "col_name", "item", F.round("value", 6).alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


# P14 ------------------------------------------------------------------------
def kpi_row(df: DataFrame, mean_cols: Sequence[str], rate_col: str | None = None, digits: int = 2) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.round(F.avg(c), digits).alias(f"mean_{c}") for c in mean_cols]
    if rate_col:
        aggs.append(F.round(F.avg(F.col(rate_col).cast("double")) * 100, digits).alias(f"rate_{rate_col}"))
    return df.agg(*aggs)


# P15 / V5 -------------------------------------------------------------------
def group_mean(df: DataFrame, group: str, value: str, digits: int | None = None) -> DataFrame:
    m = F.avg(value) if digits is None else F.round(F.avg(value), digits)
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(m.alias(f"mean_{value}")).orderBy(F.col(f"mean_{value}").desc())


# P16 / V13 ------------------------------------------------------------------
def cluster_profiles(df: DataFrame, cluster: str, cols: Sequence[str], digits: int = 2) -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(c), digits).alias(c) for c in cols])


def radar_rows(df: DataFrame, cluster: str, cols: Sequence[str], digits: int = 2) -> DataFrame:
    prof = cluster_profiles(df, cluster, cols, digits).drop("n")
    return prof.unpivot([cluster], list(cols), "axis", "mean")


# P17 ------------------------------------------------------------------------
def value_frequency(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(col)


# P19 ------------------------------------------------------------------------
def strong_correlations(df: DataFrame, cols: Sequence[str] | None = None, threshold: float = 0.3, top: int = 3) -> DataFrame:
    """Per column up to ``top`` partners with |r| > threshold, by signed r desc (self removed)."""
    m = corr_matrix(df, cols).where((F.col("col_a") != F.col("col_b")) & (F.abs("r") > threshold))
    w = Window.partitionBy("col_a").orderBy(F.col("r").desc(), "col_b")
    return m.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


# P20 / P22 ------------------------------------------------------------------
def time_span(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("ts_min"), F.max(ts).alias("ts_max")).withColumn(
        "duration_s", F.timestamp_diff("MICROSECOND", F.col("ts_min"), F.col("ts_max")) / F.lit(1e6))


def snapshot_line(df: DataFrame, v1: str, v2: str, n_peaks: DataFrame | None = None) -> DataFrame:
    """One text row: 'rows=N mean(v1)=.. mean(v2)=.. peaks=K'."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.avg(v1).alias("m1"), F.avg(v2).alias("m2"))
    if n_peaks is not None:
        row = row.crossJoin(n_peaks.agg(F.count(F.lit(1)).alias("peaks")))
    else:
        row = row.withColumn("peaks", F.lit(0).cast("long"))
    return row.select(F.format_string(f"rows=%d mean({v1})=%.4f mean({v2})=%.4f peaks=%d",
                                      "rows", F.round("m1", 4), F.round("m2", 4), "peaks").alias("line"))


# P18 / P19 ------------------------------------------------------------------
def _seq_of(names: Sequence[str], base: int, step: int = 1) -> Column:
    """Line number of a column's line: its place among ``names``, ``step`` apart, from ``base`` on."""
    return F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(base + step * i))])[F.col("col_name")]


def _lines(spark, rows: Sequence[tuple[int, str]]) -> DataFrame:
    return spark.createDataFrame(list(rows), "seq int, line string")


def _span_lines(df: DataFrame, ts: str, base: int, titles: Sequence[str]) -> DataFrame:
    """First and last time and the time between, as three lines."""
    s = F.floor("duration_s").cast("long")
    took = F.format_string("%d days %02d:%02d:%02d", F.floor(s / 86400).cast("long"), F.floor(s % 86400 / 3600).cast("long"),
                           F.floor(s % 3600 / 60).cast("long"), s % 60)
    texts = (F.col("ts_min").cast("string"), F.col("ts_max").cast("string"), took)
    entries = F.array(*[F.struct(F.lit(base + i).alias("seq"), F.concat(F.lit(f"  {t}: "), x).alias("line"))
                        for i, (t, x) in enumerate(zip(titles, texts))])
    return time_span(df, ts).select(F.explode(entries).alias("e")).select("e.*")


def _sample_lines(df: DataFrame, order: Sequence[str], n: int, base: int, cols: Sequence[str], prefix: str) -> DataFrame:
    """The first ``n`` rows in ``order`` as 'a=1, b=2' lines (a bounded top-n)."""
    first = df.orderBy(*order).limit(n)
    text = F.concat_ws(", ", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("None"))) for c in cols])
    place = F.row_number().over(Window.orderBy(*order)) - 1  # over n rows
    out = first.select(place.alias("i"), text.alias("t"))
    return out.select((F.col("i") + base).cast("int").alias("seq"), F.concat(F.lit("  "), F.format_string(prefix, "i") if "%d" in prefix else F.lit(prefix), "t").alias("line"))


def _union_lines(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part.select(F.col("seq").cast("int").alias("seq"), "line"))
    return out


def text_profile(df: DataFrame, ts: str | None = None, order: Sequence[str] = (), max_cat: int = 5, max_values: int = 10,
                 sample: int = 3) -> DataFrame:
    """Numbered lines (seq, line) that describe a table for a text prompt.

    Row count, columns, statistics of each numeric column, distinct counts of up
    to ``max_cat`` others (with the sorted values where they are few), the time
    range, and the first ``sample`` rows in ``order`` (left out without one).  An empty line
    precedes each section's title.
    """
    spark = df.sparkSession
    num = numeric_cols(df)
    cat = [c for c in df.columns if c not in num][:max_cat]
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(0).alias("seq"), F.format_string("Data Overview: %d rows", "n").alias("line"))]
    titles = [(1, "Columns: " + ", ".join(df.columns))]
    at = 2
    if num:
        titles += [(at, ""), (at + 1, "Numeric Statistics:")]
        parts.append(describe(df, num).select(_seq_of(num, at + 2).alias("seq"), F.format_string(
            "  %s: mean=%.4f, std=%.4f, min=%.4f, 25%%=%.4f, 50%%=%.4f, 75%%=%.4f, max=%.4f",
            "col_name", *[F.round(c, 4) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]).alias("line")))
        at += 2 + len(num)
    if cat:
        titles += [(at, ""), (at + 1, "Categorical/Other Columns:")]
        long = df.select(*[F.col(c).cast("string").alias(c) for c in cat]).unpivot([], cat, "col_name", "v")
        vals = long.where(F.col("v").isNotNull()).select("col_name", "v").distinct()
        counts = vals.groupBy("col_name").agg(F.count(F.lit(1)).alias("nd"))
        # values are gathered only for columns with few distinct values (bounded lists)
        few = vals.join(counts.where(F.col("nd") <= max_values), "col_name").groupBy("col_name").agg(
            F.array_sort(F.collect_list("v")).alias("vals"))
        parts.append(counts.select(_seq_of(cat, at + 2, 2).alias("seq"), F.format_string("  %s: %d unique values", "col_name", "nd").alias("line")))
        parts.append(few.select(_seq_of(cat, at + 3, 2).alias("seq"), F.concat(F.lit("    Values: "), F.array_join("vals", ", ")).alias("line")))
        at += 2 + 2 * len(cat)
    if ts:
        titles += [(at, ""), (at + 1, "Time Range:")]
        parts.append(_span_lines(df, ts, at + 2, ("Earliest", "Latest", "Duration")))
        at += 5
    if order:
        titles.append((at, ""))
        parts.append(df.select(F.lit(1)).limit(sample).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(at + 1).alias("seq"), F.format_string("Sample (%d rows):", "n").alias("line")))
        parts.append(_sample_lines(df, order, sample, at + 2, df.columns, ""))
    return _union_lines([*parts, _lines(spark, titles)])


def text_profile_extended(df: DataFrame, ts: str | None = None, order: Sequence[str] = (), sample: int = 5) -> DataFrame:
    """The longer profile: one line per statistic, each numeric column's strong correlations, time, first rows."""
    spark = df.sparkSession
    num = numeric_cols(df)
    stats = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(0).alias("seq"), F.format_string(
        f"=== DATASET: %d lignes, {len(df.columns)} colonnes ===", "n").alias("line"))]
    titles = [(1, "Colonnes: " + ", ".join(df.columns))]
    at = 2
    if num:
        titles += [(at, ""), (at + 1, "📊 STATISTIQUES DÉTAILLÉES:")]
        at += 2
        step = 2 + len(stats) + 1
        for i, c in enumerate(num):
            titles += [(at + i * step, ""), (at + i * step + 1, f"--- {c} ---")]
        values = (F.format_string("%.1f", F.col("count").cast("double")),
                  *[F.format_string("%.4f", F.round(c, 4)) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])
        entries = F.array(*[F.struct(F.lit(j).alias("j"), F.concat(F.lit(f"  {n}: "), v).alias("line"))
                            for j, (n, v) in enumerate(zip(stats, values))])
        parts.append(describe(df, num).select("col_name", F.explode(entries).alias("e")).select(
            (_seq_of(num, at + 2, step) + F.col("e.j")).alias("seq"), "e.line"))
        strong = strong_correlations(df, num).groupBy(F.col("col_a").alias("col_name")).agg(
            F.array_sort(F.collect_list(F.struct("rank", "col_b"))).alias("p"))
        parts.append(strong.select(_seq_of(num, at + step - 1, step).alias("seq"), F.concat(
            F.lit("  corrélations fortes: ['"), F.array_join(F.col("p.col_b"), "', '"), F.lit("']")).alias("line")))
        at += step * len(num)
    if ts:
        titles += [(at, ""), (at + 1, "⏰ TEMPS:")]
        parts.append(_span_lines(df, ts, at + 2, ("Début", "Fin", "Durée")))
        at += 5
    if order:
        titles += [(at, ""), (at + 1, f"📝 EXEMPLE ({sample} premières lignes):")]
        shown = [F.format_string("%.3f", F.col(c).cast("double")).alias(c) if t in ("double", "float") else F.col(c)
                 for c, t in df.dtypes if c in df.columns[:4]]
        keep = [c for c in order if c not in df.columns[:4]]
        first = df.orderBy(*order).limit(sample).select(*shown, *keep, *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
        parts.append(_sample_lines(first, [f"_o{i}" for i in range(len(order))], sample, at + 2, df.columns[:4], "Row %d: "))
    return _union_lines([*parts, _lines(spark, titles)])


# P21 ------------------------------------------------------------------------
def vif(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Variance inflation factor without intercept (uncentred), listwise NULL deletion.

    VIF_j = G_jj * (G^-1)_jj with G = X^T X (d x d from one aggregation).
    """
    row = gram(df, cols).first()
    _, g = gram_to_numpy(row, cols)
    x = g[1:, 1:]
    inv = np.linalg.pinv(x)
    vals = [(c, float(x[i, i] * inv[i, i])) for i, c in enumerate(cols)]
    spark = df.sparkSession
    return spark.createDataFrame(vals, "col_name string, vif double").orderBy(F.col("vif").desc())
