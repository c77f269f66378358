"""Reproducible splits and folds (R1–R3) from a mixing hash of a key.

``randomSplit`` depends on partitioning; a hash of the row key does not, and
the same expression runs in DuckDB for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.kernels import kth_smallest, mix_hash, with_positions


# R1 -------------------------------------------------------------------------
def hash_split(df: DataFrame, key: str, test_pct: int = 20, seed: int = 42, out: str = "is_test") -> DataFrame:
    """is_test = hash(key) % 100 < test_pct (about test_pct % of rows)."""
    return df.withColumn(out, F.pmod(mix_hash(key, "split", seed), F.lit(100)) < F.lit(test_pct))


# R2 -------------------------------------------------------------------------
def stratified_split(df: DataFrame, key: str, label: str, test_frac: float = 0.2, seed: int = 42,
                     out: str = "is_test") -> DataFrame:
    """Exactly floor(test_frac * n_c + 0.5) test rows per class: the smallest (hash, key) pairs of each class.

    Per class the cut pair comes from ``kth_smallest`` (bounded passes), so a
    large class never has to be ranked inside one task.
    """
    h = mix_hash(key, "split", seed)
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per class
    cond = F.lit(False)
    for row in counts:
        c, n = row[label], row["n"]
        k = int(test_frac * n + 0.5)
        if k <= 0:
            continue
        sub = df.where(F.col(label) == F.lit(c)) if c is not None else df.where(F.col(label).isNull())
        t, tkey = kth_smallest(sub.select(h.alias("_h"), F.col(key).alias("_k")), "_h", "_k", k)
        in_class = (F.col(label) == F.lit(c)) if c is not None else F.col(label).isNull()
        cond = cond | (in_class & ((h < F.lit(t)) | ((h == F.lit(t)) & (F.col(key) <= F.lit(tkey)))))
    return df.withColumn(out, cond)


# R3 -------------------------------------------------------------------------
def fold_column(df: DataFrame, key: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Shuffled K-fold: ``fold`` = hash(key) % k."""
    return df.withColumn(out, F.pmod(mix_hash(key, "fold", seed), F.lit(k)).cast("int"))


def contiguous_folds(df: DataFrame, order: list[str], k: int = 5, out: str = "fold") -> DataFrame:
    """Unshuffled K-fold: runs of neighbouring rows in ``order`` (unique), the first ``n % k`` folds one row longer."""
    placed = with_positions(df, [], order)
    n = df.count()
    short, longer = divmod(n, k)
    head = longer * (short + 1)  # rows in the longer folds
    fold = F.when(F.col("_pos") < head, F.floor(F.col("_pos") / (short + 1))) \
        .otherwise(longer + F.floor((F.col("_pos") - head) / max(1, short)))
    return placed.withColumn(out, fold.cast("int")).drop("_pos")


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Shuffled stratified K-fold: each class is dealt over the folds in hash order, so the folds' class
    counts differ by one at most."""
    ranked = with_positions(df.withColumn("_mix", mix_hash(key, "fold", seed)), [label], ["_mix", key])
    return ranked.withColumn(out, F.pmod("_pos", F.lit(k)).cast("int")).drop("_mix", "_pos")
