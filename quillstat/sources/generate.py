"""Spark-native synthetic sources.

Generated from ``spark.range`` with seeded ``rand``/``randn`` columns, so
generation is parallel and partition-count independent only in
distribution (not bit-identical to any NumPy stream).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Coefficients of the reference's target equations (shipped generator).
MIDTERM = {"intercept": 2.0, "temps_etude_hebdo": 0.35, "exercices_completes_pct": 0.08,
           "score_motivation": 0.10, "nombre_absences": -0.15, "noise": 1.5}
FINAL = {"intercept": -7.5, "temps_etude_hebdo": 0.22, "exercices_completes_pct": 0.03,
         "nb_connexions_semaine": 0.04, "nb_devoirs_rendus": 0.12, "score_motivation": 0.40,
         "nombre_absences": -0.50, "videos_vues_pct": 0.01, "note_mi_parcours": 0.90, "noise": 4.0}


def _choice(u: Column, options: list[tuple[str, float]]) -> Column:
    """Weighted categorical choice from one uniform draw (cumulative thresholds)."""
    expr, cum = None, 0.0
    for value, p in options[:-1]:
        cum += p
        expr = F.when(u < cum, F.lit(value)) if expr is None else expr.when(u < cum, F.lit(value))
    return expr.otherwise(F.lit(options[-1][0]))


def _poisson(u: Column, lam: float, kmax: int = 40) -> Column:
    """Inverse-CDF Poisson sample from one uniform draw."""
    cdf, p = 0.0, math.exp(-lam)
    expr = None
    for k in range(kmax):
        cdf += p
        expr = F.when(u < cdf, F.lit(k)) if expr is None else expr.when(u < cdf, F.lit(k))
        p *= lam / (k + 1)
    return expr.otherwise(F.lit(kmax))


def _kth_uniform(seed: int, n: int, k: int) -> Column:
    """k-th smallest of n uniforms ~ Beta(k, n + 1 - k)."""
    return F.element_at(F.array_sort(F.array(*[F.rand(seed + i) for i in range(n)])), k)


def _clip_round(x: Column, lo: float, hi: float, digits: int) -> Column:
    return F.round(F.least(F.greatest(x, F.lit(lo)), F.lit(hi)), digits)


def generate_students(spark: SparkSession, n: int = 500, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """The 17-column student table (distributions of the reference generator)."""
    base = spark.range(1, n + 1, numPartitions=partitions) if partitions else spark.range(1, n + 1)
    s = seed * 1000
    df = base.select(
        F.col("id").alias("etudiant_id"),
        F.least(F.greatest(F.lit(22.0) + 5 * F.randn(s + 1), F.lit(17.0)), F.lit(45.0)).cast("int").alias("age"),
        _choice(F.rand(s + 2), [("M", 0.52), ("F", 0.48)]).alias("genre"),
        _choice(F.rand(s + 3), [("L1", .30), ("L2", .30), ("L3", .20), ("M1", .15), ("M2", .05)]).alias("niveau_etudes"),
        _clip_round(F.lit(8.0) + 3 * F.randn(s + 4), 1, 21, 1).alias("nb_connexions_semaine"),
        _clip_round(F.lit(12.0) + 5 * F.randn(s + 5), 0, 35, 1).alias("temps_etude_hebdo"),
        F.round(_kth_uniform(s + 100, 6, 5) * 100, 1).alias("exercices_completes_pct"),  # Beta(5, 2)
        F.round(_kth_uniform(s + 200, 5, 4) * 100, 1).alias("videos_vues_pct"),        # Beta(4, 2)
        _poisson(F.rand(s + 6), 5.0).alias("participation_forums"),
        F.aggregate(F.array(*[(F.rand(s + 300 + i) < 0.75).cast("int") for i in range(10)]), F.lit(0),
                    lambda a, x: a + x).alias("nb_devoirs_rendus"),
        _choice(F.rand(s + 7), [("Bas", .30), ("Moyen", .50), ("Élevé", .20)]).alias("revenu_famille"),
        _clip_round(F.lit(6.5) + 1.8 * F.randn(s + 8), 1, 10, 1).alias("score_motivation"),
        _poisson(F.rand(s + 9), 3.0).alias("nombre_absences"),
        _choice(F.rand(s + 10), [("Stable", .60), ("Instable", .25), ("Limité", .15)]).alias("acces_internet"),
        F.randn(s + 11).alias("_e1"), F.randn(s + 12).alias("_e2"),
    )
    mid = F.lit(MIDTERM["intercept"]) + MIDTERM["noise"] * F.col("_e1")
    for c, b in MIDTERM.items():
        if c not in ("intercept", "noise"):
            mid = mid + F.lit(b) * F.col(c)
    df = df.withColumn("note_mi_parcours", _clip_round(mid, 0, 20, 2))
    fin = F.lit(FINAL["intercept"]) + FINAL["noise"] * F.col("_e2")
    for c, b in FINAL.items():
        if c not in ("intercept", "noise"):
            fin = fin + F.lit(b) * F.col(c)
    df = df.withColumn("note_finale", _clip_round(fin, 0, 20, 2))
    return df.withColumn("reussite", (F.col("note_finale") >= 10).cast("int")).drop("_e1", "_e2")


def oscillating_series(spark: SparkSession, n: int, interval: float = 0.5, noise: float = 0.05, seed: int = 42,
                       start: str = "2024-01-01 00:00:00") -> DataFrame:
    """Live-table rows: t = i*interval, value1 = sin(.5t) + .2 sin(3t) + noise, value2 = cos(.25t) + noise."""
    t = F.col("id") * F.lit(interval)
    return spark.range(n).select(
        (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(secs=t)).alias("timestamp"),
        t.alias("t"),
        (F.sin(t * 0.5) + 0.2 * F.sin(t * 3.0) + F.lit(noise) * (F.rand(seed) - 0.5)).alias("value1"),
        (F.cos(t * 0.25) + F.lit(noise) * (F.rand(seed + 1) - 0.5)).alias("value2"),
    )
