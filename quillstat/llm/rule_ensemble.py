"""Quality classifier: a sparse ensemble of rules.

Every text has a row of statistics.  A small forest is grown over the statistics
of labelled texts; each path from a root to a node is a conjunctive rule ("few
distinct words and many symbols").  A logistic regression with a lasso penalty
over all rules gives most of them the weight zero; what is left is compiled into
one Spark column expression, so scoring is arithmetic on the statistics' columns.

The forest and the weights are fitted on a bounded sample, ``SAMPLE`` labelled
documents of each label by the hash of their id; rows count by what they stand
for, so scores keep the labels' proportions.  The statistics of whole texts and the
scores are one map over the documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored

#: Labelled documents of each label that are learned from, at most.
SAMPLE = 20_000
#: Trees, their depth, the rows a leaf holds at least, and the weight of the lasso penalty.
TREES, DEPTH, LEAF, PENALTY = 30, 3, 5, 1e-3
#: Words of a window whose repeats count.
WINDOW = 5

#: The statistics, in order.
STATISTICS = (
    "n_words word_length longest symbols capitals digits marks stops high distinct repeated stutter dup_lines line_words white"
).split()
#: Characters that count as symbols, as marks and as stops.
_SYMBOLS, _MARKS, _STOPS = b"#$%&*|<>@^~=+_\\/{}[]`", b"!?", b".,;:"


def statistics(text: str | None) -> tuple[float, ...]:
    """The statistics of one text, in the order of ``STATISTICS``; all zero without a word."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return (0.0,) * len(STATISTICS)
    of = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    inked = len(raw) - int(of[[9, 10, 11, 12, 13, 32]].sum())
    share = lambda chars: int(of[list(chars)].sum()) / inked
    letters = int(of[65:91].sum() + of[97:123].sum())
    sizes = [len(w) for w in words]
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    windows = Counter(zip(*(words[i:] for i in range(WINDOW))))
    again = sum(k for k in windows.values() if k > 1)
    return (
        float(n),
        sum(sizes) / n,
        float(max(sizes)),
        share(_SYMBOLS),
        int(of[65:91].sum()) / max(1, letters),
        share(range(48, 58)),
        share(_MARKS),
        share(_STOPS),
        int(of[128:].sum()) / inked,
        len(set(words)) / n,
        again / max(1, n - WINDOW + 1),
        sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(set(lines)) / len(lines),
        n / len(lines),
        1 - inked / len(raw),
    )


def measured(docs: DataFrame, text_col: str, out: str) -> DataFrame:
    """``docs`` with ``out``: the struct of statistics of each text."""

    @F.pandas_udf(", ".join(f"{s} double" for s in STATISTICS))
    def udf(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(t) for t in texts], columns=STATISTICS, dtype="float64")

    return docs.withColumn(out, udf(F.col(f"`{text_col}`")))


#: One condition: place of the statistic, whether it is at most the bound (else above), the bound.
Condition = tuple[int, bool, float]
Rule = frozenset[Condition]


@dataclass(frozen=True)
class Ensemble:
    """Weighted rules and an intercept."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...] = ()

    def score(self, stats: Column) -> Column:
        """Probability of label 1 as an expression over a struct of statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def holds(rule: Rule, stats: Column) -> Column:
    """A rule as a condition on a struct of statistics."""
    out = F.lit(True)
    for place, low, bound in sorted(rule):
        value = stats[STATISTICS[place]]
        out = out & ((value <= bound) if low else (value > bound))
    return out


_IF = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) ([^)]+)\)")


def paths(tree: str) -> set[Rule]:
    """The rules of a tree as Spark prints it: the conditions on the way to each node, the narrowest of each kind."""
    out: set[Rule] = set()
    open_: list[tuple[int, Condition]] = []
    for line in tree.splitlines():
        if found := _IF.match(line):
            depth = len(found[1])
            while open_ and open_[-1][0] >= depth:
                open_.pop()
            open_.append((depth, (int(found[2]), found[3] == "<=", float(found[4]))))
            bounds: dict[tuple[int, bool], float] = {}
            for _, (place, low, bound) in open_:
                old = bounds.get((place, low), bound)
                bounds[place, low] = min(old, bound) if low else max(old, bound)
            out.add(frozenset((place, low, bound) for (place, low), bound in bounds.items()))
    return out


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int = SAMPLE) -> DataFrame:
    """``stats array<double>, label double, weight double`` of at most ``most`` labelled documents of each label.

    Labels other than 0 and 1 and NULL ids teach nothing; repeated labels count once, and an id with both
    labels teaches both.  Rows of an id that are equal in their statistics count once.
    """
    clean = (
        labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .where("id IS NOT NULL AND label IN (0, 1)")
        .distinct()
    )
    clean = stored(clean)
    there = {r["label"]: r["count"] for r in clean.groupBy("label").count().collect()}
    order = F.xxhash64(F.lit("quality"), "id", "label")
    picked = None
    for label, count in sorted(there.items()):
        some = clean.where(F.col("label") == label).orderBy(order, "id").limit(most).withColumn("weight", F.lit(max(1.0, count / most)))
        picked = some if picked is None else picked.union(some)
    if picked is None:
        picked = clean.withColumn("weight", F.lit(1.0))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(stored(picked), "id")
    rows = (
        measured(texts, "text", "m")
        .select("id", F.array(*(F.col("m")[s] for s in STATISTICS)).alias("stats"), F.col("label").cast("double").alias("label"), "weight")
        .distinct()
    )
    # one id may have any number of different texts
    return stored(rows.orderBy(F.xxhash64("id", "stats", "label"), "id").limit(2 * most).drop("id"))


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY, seed: int = 42) -> Ensemble:
    """Rules and weights from a sample.  Without two labels the score is constant: 1/2 without rows, else the label
    up to a thousandth."""
    share = rows.agg(F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).first()[0]
    if share is None or share in (0.0, 1.0):
        share = 0.5 if share is None else min(0.999, max(0.001, share))
        return Ensemble(math.log(share / (1 - share)))
    data = rows.select(array_to_vector("stats").alias("features"), "stats", "label", "weight")
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=LEAF, subsamplingRate=0.5, weightCol="weight", seed=seed
    ).fit(data)
    found = sorted(set().union(*(paths(t.toDebugString) for t in forest.trees)), key=lambda rule: sorted(rule))
    if not found:
        return Ensemble(math.log(share / (1 - share)))
    # a rule is a column: each of its conditions holds for the array of statistics
    holds_ = [
        F.array(*(((F.col("stats")[p] <= b) if low else (F.col("stats")[p] > b)) for p, low, b in sorted(rule))) for rule in found
    ]
    every = F.array(*(F.forall(h, lambda x: x).cast("double") for h in holds_))
    table = stored(rows.select(every.alias("rules"), "label", "weight")).select(
        array_to_vector("rules").alias("features"), "label", "weight"
    )
    model = LogisticRegression(
        elasticNetParam=1.0, regParam=penalty, maxIter=100, weightCol="weight", standardization=False
    ).fit(table)
    weights = model.coefficients.toArray().tolist()
    return Ensemble(model.intercept, tuple((r, w) for r, w in zip(found, weights) if w))


def score(docs: DataFrame, text_col: str, ensemble: Ensemble, out: str) -> DataFrame:
    """``docs`` with ``out double``, the probability of label 1.

    NULL and empty texts, and texts without a word, have statistics of zero and a score like any other; rows
    are scored one by one, so repeated rows and an empty table need no care.
    """
    (m,) = fresh(docs, "stats__")
    return measured(docs, text_col, m).withColumn(out, ensemble.score(F.col(m))).drop(m)
