import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstat.operators import cleaning as C
from quillstat.operators import profiling as P
from quillstat.sources.generate import generate_students


@pytest.fixture(scope="module")
def students(spark):
    return generate_students(spark, 50, seed=0).cache()


def test_generated_shape_and_domains(students):
    assert students.count() == 50 and len(students.columns) == 17
    r = students.agg(F.min("note_finale").alias("lo"), F.max("note_finale").alias("hi"),
                     F.min("age").alias("amin"), F.max("age").alias("amax")).first()
    assert 0 <= r["lo"] and r["hi"] <= 20 and 17 <= r["amin"] and r["amax"] <= 45
    assert students.where(F.col("reussite") != (F.col("note_finale") >= 10).cast("int")).count() == 0
    assert {x[0] for x in students.select("genre").distinct().collect()} <= {"M", "F"}
    nulls = students.select(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in students.columns]).first()
    assert sum(nulls) == 0


def test_missing_report_and_imputation(spark, students):
    dirty = C.inject_missing(students, ["temps_etude_hebdo", "score_motivation"], "etudiant_id", rate=0.04)
    rep = {r["col_name"]: r["n_missing"] for r in P.missing_report(dirty).collect()}
    assert rep == {"temps_etude_hebdo": 2, "score_motivation": 2}
    clean = C.handle_missing(dirty)
    assert clean.count() == 50
    assert P.missing_report(clean).count() == 0


def test_encoding_ranges(students):
    enc = C.encode_student(students)
    r = enc.agg(*[F.min(c).alias(f"min_{c}") for c in ("niveau_etudes_num", "genre_num", "revenu_famille_num")],
                *[F.max(c).alias(f"max_{c}") for c in ("niveau_etudes_num", "genre_num", "revenu_famille_num")]).first()
    assert r["min_niveau_etudes_num"] >= 1 and r["max_niveau_etudes_num"] <= 5
    assert r["min_genre_num"] >= 0 and r["max_genre_num"] <= 1
    assert r["min_revenu_famille_num"] >= 0 and r["max_revenu_famille_num"] <= 2
    fm = C.feature_matrix(enc, C.STUDENT_FEATURES, C.STUDENT_TARGETS)
    assert len(fm.columns) == 16 and len(C.STUDENT_FEATURES) == 14


def test_iqr_filter_reference_vector(spark):
    df = spark.createDataFrame([(float(v),) for v in [10, 12, 13, 11, 12, 200, 9, 11]], "x double")
    f = C.iqr_fences(df, "x").first()
    assert (f["q1"], f["q3"], f["lower"], f["upper"]) == (10.75, 12.25, 8.5, 14.5)
    kept = [r["x"] for r in C.iqr_filter(df, "x").collect()]
    assert 200.0 not in kept and len(kept) == 7


def test_iqr_filter_keeps_most_of_normal(spark):
    rng = np.random.default_rng(42)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(50, 5, 100)], "x double")
    assert C.iqr_filter(df, "x").count() >= 95


def test_iqr_filter_drops_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (3.0,)], "x double")
    assert C.iqr_filter(df, "x").count() == 3
    assert P.iqr_outliers(df, "x").count() == 0


def test_mode_tie_and_null(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "c string")
    assert C.mode_row(df, ["c"]).first()["mode"] == "a"
    assert [r["c"] for r in C.impute_mode(df, ["c"]).collect()].count("a") == 3


def test_standardise_zero_sigma(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "x double")
    assert {r["x_z"] for r in C.standardise(df, ["x"]).collect()} == {0.0}
    assert P.zscore_outliers(df, 3.0, ["x"]).count() == 0


def test_inject_missing_exact_count(spark):
    df = spark.range(1, 1001).withColumn("v", F.col("id").cast("double"))
    out = C.inject_missing(df, ["v"], "id", rate=0.03)
    assert out.where(F.col("v").isNull()).count() == 30


def test_text_replace_longest_first(spark):
    df = spark.createDataFrame([("the theme",)], "t string")
    out = C.replace_text(df, "t", [("th", "X"), ("the", "Y")]).first()
    assert out["t"] == "Y Yme" and out["changed"] == 1
