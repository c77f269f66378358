"""Projection, filtering and cleaning operators.

All functions are DataFrame -> DataFrame and lazy; statistics they need
(medians, modes, fences, moments) are computed as small aggregated frames and
cross-joined back (one row, broadcast), never collected.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.kernels import exact_quantiles, kth_smallest, mix_hash, numeric_cols, string_cols

# Columns the reference never imputes (identifier and class label).


# C1 -------------------------------------------------------------------------
def select_numeric(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    return df.select(*numeric_cols(df, exclude))


def select_categorical(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    return df.select(*string_cols(df, exclude))


# C2 -------------------------------------------------------------------------
def median_row(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the exact median of each column (named like the column)."""
    long = exact_quantiles(df, cols, [0.5])
    return long.groupBy().pivot("col_name", list(cols)).agg(F.first("value"))


def impute_median(df: DataFrame, cols: Sequence[str] | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Fill numeric NULLs with the exact column median; filled columns become double."""
    cols = list(cols) if cols is not None else numeric_cols(df, exclude)
    if not cols:
        return df
    med = median_row(df, cols).select(*[F.col(c).alias(f"_med_{c}") for c in cols])
    joined = df.crossJoin(F.broadcast(med))
    out = [
        F.coalesce(F.col(f.name).cast("double"), F.col(f"_med_{f.name}")).alias(f.name) if f.name in cols else F.col(f.name)
        for f in df.schema.fields
    ]
    return joined.select(*out)


# C3 -------------------------------------------------------------------------
def mode_row(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent non-null value per column; ties -> smallest value.  Long (column, mode)."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "col_name", "v")
    counts = long.where(F.col("v").isNotNull()).groupBy("col_name", "v").agg(F.count(F.lit(1)).alias("c"))
    best = counts.groupBy("col_name").agg(F.min(F.struct((-F.col("c")).alias("nc"), F.col("v").alias("v"))).alias("b"))
    return best.select("col_name", F.col("b.v").alias("mode"))


def impute_mode(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols) if cols is not None else string_cols(df)
    if not cols:
        return df
    modes = mode_row(df, cols).groupBy().pivot("col_name", cols).agg(F.first("mode"))
    modes = modes.select(*[F.col(c).alias(f"_mode_{c}") for c in cols])
    joined = df.crossJoin(F.broadcast(modes))
    return joined.select(
        *[F.coalesce(F.col(f.name), F.col(f"_mode_{f.name}")).alias(f.name) if f.name in cols else F.col(f.name)
          for f in df.schema.fields]
    )


def handle_missing(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Reference cleaning step: median for numerics (except id/label), mode for strings."""
    return impute_mode(impute_median(df, exclude=exclude))


# C4 / C18 -------------------------------------------------------------------
def iqr_fences(df: DataFrame, col: str, factor: float = 1.5) -> DataFrame:
    """One row: q1, q3, iqr, lower, upper (exact linear quantiles)."""
    long = exact_quantiles(df, [col], [0.25, 0.75])
    row = long.groupBy().agg(
        F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3"),
    )
    iqr = F.col("q3") - F.col("q1")
    return row.select("q1", "q3", iqr.alias("iqr"),
                      (F.col("q1") - F.lit(factor) * iqr).alias("lower"),
                      (F.col("q3") + F.lit(factor) * iqr).alias("upper"))


def iqr_filter(df: DataFrame, col: str, factor: float = 1.5) -> DataFrame:
    """Keep rows with lower <= x <= upper (inclusive); NULL rows are dropped."""
    f = F.broadcast(iqr_fences(df, col, factor).select(F.col("lower").alias("_lo"), F.col("upper").alias("_hi")))
    return df.crossJoin(f).where(F.col(col).between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")


def iqr_filter_report(df: DataFrame, col: str, factor: float = 1.5) -> DataFrame:
    """One row: rows before, kept, removed."""
    kept = iqr_filter(df, col, factor)
    return df.agg(F.count(F.lit(1)).alias("n_before")).crossJoin(kept.agg(F.count(F.lit(1)).alias("n_kept"))).select(
        "n_before", "n_kept", (F.col("n_before") - F.col("n_kept")).alias("n_removed"))


def winsorise(df: DataFrame, col: str, factor: float = 1.5, out: str | None = None) -> DataFrame:
    """Clip to the IQR fences (NULL stays NULL)."""
    f = F.broadcast(iqr_fences(df, col, factor).select(F.col("lower").alias("_lo"), F.col("upper").alias("_hi")))
    return df.crossJoin(f).withColumn(out or col, clip(F.col(col), F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")


# C5 -------------------------------------------------------------------------
def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


# C6 / C7 --------------------------------------------------------------------
def ordinal_encode(df: DataFrame, col: str, mapping: Mapping[str, int], out: str | None = None) -> DataFrame:
    """Dictionary lookup; unseen or NULL -> NULL."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn(out or f"{col}_num", F.when(F.col(col).isNotNull(), F.try_element_at(m, F.col(col))))


def binary_flag(df: DataFrame, col: str, positive: str, out: str | None = None) -> DataFrame:
    """(x == positive) -> 1 else 0, NULL -> 0."""
    return df.withColumn(out or f"{col}_num", F.coalesce((F.col(col) == F.lit(positive)).cast("int"), F.lit(0)))


# The reference's encodings of the student table.
LEVEL_CODES = {"L1": 1, "L2": 2, "L3": 3, "M1": 4, "M2": 5}
INCOME_CODES = {"Bas": 0, "Moyen": 1, "Élevé": 2}
INTERNET_CODES = {"Limité": 0, "Instable": 1, "Stable": 2}


def encode_student(df: DataFrame) -> DataFrame:
    df = ordinal_encode(df, "niveau_etudes", LEVEL_CODES, "niveau_etudes_num")
    df = binary_flag(df, "genre", "M", "genre_num")
    df = ordinal_encode(df, "revenu_famille", INCOME_CODES, "revenu_famille_num")
    return ordinal_encode(df, "acces_internet", INTERNET_CODES, "acces_internet_num")


# C8 / C17 -------------------------------------------------------------------
# The reference's feature-matrix column order and its targets.
STUDENT_FEATURES = [
    "age", "genre_num", "niveau_etudes_num",
    "nb_connexions_semaine", "temps_etude_hebdo",
    "exercices_completes_pct", "videos_vues_pct",
    "participation_forums", "nb_devoirs_rendus",
    "revenu_famille_num", "score_motivation",
    "nombre_absences", "acces_internet_num",
    "note_mi_parcours",
]
STUDENT_TARGETS = ["note_finale", "reussite"]


def feature_matrix(df: DataFrame, features: Sequence[str], targets: Sequence[str] = ()) -> DataFrame:
    return df.select(*features, *targets)


def subset_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Keep the requested features that exist, in request order."""
    present = set(df.columns)
    return df.select(*[c for c in features if c in present])


# C9 -------------------------------------------------------------------------
def clean_table(df: DataFrame, encoders: Iterable = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Impute (median/mode) -> encode -> drop exact duplicates."""
    out = handle_missing(df, exclude)
    for enc in encoders:
        out = enc(out)
    return out.dropDuplicates()


def clean_job(df: DataFrame, path: str, encoders: Iterable = (), exclude: Sequence[str] = (), fmt: str = "csv") -> dict:
    """The whole cleaning run: missing report, clean, write the table to ``path``; ``{"report", "n_duplicates", "path"}``."""
    from ..sources.files import write_table
    from .profiling import missing_report

    report = missing_report(df)
    out = clean_table(df, encoders, exclude)
    write_table(out, path, fmt)
    before = df.count()
    kept = df.sparkSession.read.option("header", fmt == "csv").format(fmt).load(path).count()
    return {"report": report, "n_duplicates": before - kept, "path": path}


# C10 ------------------------------------------------------------------------
def standardise(df: DataFrame, cols: Sequence[str], suffix: str = "_z", by: Sequence[str] = ()) -> DataFrame:
    """(x - mean) / population sigma; sigma = 0 -> divide by 1 (as the reference's scaler)."""
    stats = df.groupBy(*by).agg(
        *[F.avg(c).alias(f"_mu_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_sd_{c}") for c in cols]
    )
    joined = df.crossJoin(F.broadcast(stats)) if not by else df.join(stats, list(by))
    for c in cols:
        sd = F.when(F.col(f"_sd_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_sd_{c}"))
        joined = joined.withColumn(f"{c}{suffix}", (F.col(c) - F.col(f"_mu_{c}")) / sd)
    return joined.drop(*[f"_mu_{c}" for c in cols], *[f"_sd_{c}" for c in cols])


# C11 / C12 / C13 ------------------------------------------------------------
def clip(x: Column, lo, hi) -> Column:
    lo = lo if isinstance(lo, Column) else F.lit(lo)
    hi = hi if isinstance(hi, Column) else F.lit(hi)
    return F.when(x.isNull(), x).otherwise(F.least(F.greatest(x, lo), hi))


def threshold_label(x: Column, threshold: float) -> Column:
    return (x >= F.lit(threshold)).cast("int")


def to_numeric(x: Column) -> Column:
    """Coerce text to double, bad values -> NULL (ANSI-safe ``try_cast``)."""
    return x.try_cast("double")


# C14 ------------------------------------------------------------------------
def rule_flags(df: DataFrame, id_cols: Sequence[str], rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """One output row per (id, triggered rule)."""
    arr = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]), lambda x: x.isNotNull())
    return df.select(*id_cols, F.explode(arr).alias("recommendation"))


# C15 ------------------------------------------------------------------------
def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, reproducible: smallest mixing hash of the key (TakeOrdered)."""
    return df.withColumn("_h", mix_hash(key, "sample", seed)).orderBy("_h", key).limit(n).drop("_h")


# C16 ------------------------------------------------------------------------
def replace_text(df: DataFrame, col: str, pairs: Sequence[tuple[str, str]], out: str | None = None,
                 longest_first: bool = True) -> DataFrame:
    """Fold of literal replacements; longer keys first (stable); adds ``changed`` flag."""
    ordered = sorted(pairs, key=lambda kv: -len(kv[0])) if longest_first else list(pairs)
    expr = F.col(col)
    for k, v in ordered:
        expr = F.replace(expr, F.lit(k), F.lit(v))
    out = out or col
    return df.withColumn("_orig", F.col(col)).withColumn(out, expr).withColumn(
        "changed", (F.col(out) != F.col("_orig")).cast("int")).drop("_orig")


# C19 ------------------------------------------------------------------------
def one_hot(df: DataFrame, col: str, values: Sequence[str], prefix: str | None = None) -> DataFrame:
    """0/1 indicator per listed value (values fixed up-front: no data-dependent schema)."""
    prefix = prefix or col
    out = df
    for v in values:
        name = f"{prefix}_" + "".join(ch if ch.isalnum() else "_" for ch in str(v)).lower()
        out = out.withColumn(name, F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)))
    return out


# S15 -----------------------------------------------------------------------
def inject_missing(df: DataFrame, cols: Sequence[str], key: str, rate: float = 0.03, seed: int = 42) -> DataFrame:
    """NULL exactly floor(rate * n) rows per column, an independent row set per column.

    Row set of a column = the floor(rate*n) smallest (hash, key) pairs, the hash
    salted by the column's name.  The cut pair is found by ``kth_smallest`` (bounded scalar passes);
    the NULLing itself is a per-row predicate against that scalar.
    """
    n = df.count()
    k = int(rate * n)
    out = df
    for c in cols:
        h = mix_hash(key, c, seed)
        if k <= 0:
            continue
        t, tkey = kth_smallest(df.select(h.alias("_h"), F.col(key).alias("_k")), "_h", "_k", k)
        hit = (h < F.lit(t)) | ((h == F.lit(t)) & (F.col(key) <= F.lit(tkey)))
        out = out.withColumn(c, F.when(hit, F.lit(None).cast(df.schema[c].dataType)).otherwise(F.col(c)))
    return out
