"""Rule ensemble: held-out accuracy, and the compiled expression against plain evaluation."""

import math
import zlib

import pytest
from pyspark.sql import functions as F

from quillstat.llm import rule_ensemble as re_
from quillstat.llm.queries import op11_quality_rules

SF = "/root/testdata/sf0.01"
TREE = """DecisionTreeClassificationModel: uid=dtc, depth=2, numNodes=5, numClasses=2, numFeatures=15
  If (feature 3 <= 0.25)
   If (feature 0 <= 9.5)
    Predict: 0.0
   Else (feature 0 > 9.5)
    Predict: 1.0
  Else (feature 3 > 0.25)
   If (feature 3 <= 0.5)
    Predict: 0.0
   Else (feature 3 > 0.5)
    Predict: 1.0
"""


def test_paths():
    assert re_.paths(TREE) == {
        frozenset({(3, True, 0.25)}),
        frozenset({(3, True, 0.25), (0, True, 9.5)}),
        frozenset({(3, True, 0.25), (0, False, 9.5)}),
        frozenset({(3, False, 0.25)}),
        frozenset({(3, False, 0.25), (3, True, 0.5)}),
        frozenset({(3, False, 0.5)}),
    }
    assert re_.paths("DecisionTreeClassificationModel: depth=0\n  Predict: 1.0\n") == set()


@pytest.fixture(scope="module")
def ensemble(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return re_.fit(re_.sample(docs, labels, "doc_id", "text", "quality"))


def test_sparse(ensemble):
    assert 1 <= len(ensemble.rules) < re_.TREES * (2 ** (re_.DEPTH + 1) - 2) / 2


HARD = [(1, None), (2, ""), (3, " \n\t "), (None, "a b c"), (4, "wort " * 40_000), (4, "wort " * 40_000), (5, "é" * 100_000), (6, "!!! $$$ ###")]


def test_expression_is_plain_evaluation(spark, ensemble):
    docs = spark.createDataFrame(HARD, "doc_id long, text string").selectExpr("*", "1 AS stats__", "2 AS n_words")
    rows = re_.score(docs, "text", ensemble, "score").collect()
    assert len(rows) == len(HARD) and rows[0].asDict().keys() == {"doc_id", "text", "stats__", "n_words", "score"}
    for row in rows:
        stats = re_.statistics(row["text"])
        total = ensemble.intercept + sum(
            w for rule, w in ensemble.rules if all((stats[p] <= b) == low for p, low, b in rule)
        )
        assert row["score"] == pytest.approx(1 / (1 + math.exp(-total)), rel=1e-12)
        assert 0 < row["score"] < 1
    assert re_.score(docs.limit(0), "text", ensemble, "score").count() == 0


def test_statistics():
    one = dict(zip(re_.STATISTICS, re_.statistics("Ab ab ab\n\nab!! 12 $é\nab!! 12 $é")))
    assert one["n_words"] == 9 and one["longest"] == 4 and one["line_words"] == 3
    assert one["dup_lines"] == pytest.approx(1 / 3) and one["stutter"] == pytest.approx(1 / 9)
    assert one["distinct"] == pytest.approx(5 / 9) and one["repeated"] == 0
    assert one["capitals"] == pytest.approx(1 / 10)
    twice = dict(zip(re_.STATISTICS, re_.statistics("a b c d e a b c d e")))
    assert twice["repeated"] == pytest.approx(2 / 6)
    assert re_.statistics(None) == re_.statistics(" \n") == (0.0,) * len(re_.STATISTICS)


def test_labels(spark):
    docs = spark.createDataFrame([(i, f"text {'x ' * i}") for i in range(30)] + [(3, "text x x x ")] * 50 + [(None, "n")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] * 3 + [(None, 1), (4, None), (5, 7)], "doc_id long, quality int")
    rows = re_.sample(docs, labels, "doc_id", "text", "quality").toPandas()
    assert len(rows) == 30 and set(rows["weight"]) == {1.0}
    some = re_.sample(docs, labels, "doc_id", "text", "quality", most=10).toPandas()
    assert sorted(some["label"]) == [0.0] * 10 + [1.0] * 10 and set(some["weight"]) == {1.5}


def test_one_label_or_none(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    for labels, want in (([], 0.5), ([(1, 1), (2, 1)], 0.999), ([(1, 0)], 0.001)):
        rows = re_.sample(docs, spark.createDataFrame(labels, "doc_id long, quality int"), "doc_id", "text", "quality")
        scores = re_.score(docs, "text", re_.fit(rows), "s").collect()
        assert [r["s"] for r in scores] == pytest.approx([want] * 2)


def test_query_on_held_out_rows(spark):
    rows = op11_quality_rules(spark, SF)
    assert rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    judged = rows.join(labels, "doc_id").collect()
    held = [r for r in judged if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in judged)
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.95
    good, bad = ([r["score"] for r in held if r["quality"] == q] for q in (1, 0))
    above = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert above > 0.97
    assert rows.where((F.col("score") >= 0.3) != (F.col("predicted") == 1)).count() == 0
