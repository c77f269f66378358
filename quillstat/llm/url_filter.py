"""URL filter: host and path rules, and gradient-boosted trees on lexical features.

The rules decide what they fit, the longest first.  The rest is judged by trees
trained on labelled urls: length, depth, digit ratio, entropy, parameter counts
and the block rate of the host's suffix.  DataFrame functions and Spark ML only.

Scale: features are columns, computed where the url is read.  Suffix statistics
are pre-aggregated and joined (broadcast only if measured small).  The trees are
fitted on at most ``SAMPLE`` labelled urls, chosen by hash; all urls are judged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, host_of, path_of

#: Labelled urls the trees are fitted on, at most.
SAMPLE = 100_000
#: Pseudo-count that draws a rare suffix's block rate to the overall rate.
PRIOR = 20.0

FEATURES = (
    "f_length f_host_length f_path_length f_labels f_depth f_digits f_entropy f_params f_query_length f_hyphens "
    "f_segment f_suffix_rate f_first_segment_rate"
).split()


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, paths that start with ``path``; ``text`` names it."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def apply_rules(host: Column, path: Column, rules: list[Rule]) -> Column:
    """``struct<rule, verdict>`` of the longest rule that fits, NULL if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the last that fits is the longest
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    n = F.length(text)
    counts = F.transform(F.array_distinct(F.split(text, "")), lambda c: n - F.length(F.replace(text, c, F.lit(""))))
    bits = F.aggregate(counts, F.lit(0.0), lambda s, k: s + F.when(k > 0, k / n * F.log2(n / k)).otherwise(0.0))
    return F.when(n > 0, bits).otherwise(0.0)


def with_features(urls: DataFrame) -> DataFrame:
    """``urls(url, host, path, ...)`` with the lexical features and ``suffix, segment`` to take statistics of."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    n = F.length(url)
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return urls.withColumns(
        {
            "f_length": n.cast("double"),
            "f_host_length": F.length(host).cast("double"),
            "f_path_length": F.length(path).cast("double"),
            "f_labels": F.size(F.split(host, r"\.")).cast("double"),
            "f_depth": (F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))).cast("double"),
            "f_digits": F.when(n > 0, F.regexp_count(url, F.lit("[0-9]")) / n).otherwise(0.0),
            "f_entropy": _entropy(url),
            "f_params": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))).cast("double"),
            "f_query_length": F.length(query).cast("double"),
            "f_hyphens": (F.length(host) - F.length(F.replace(host, F.lit("-"), F.lit("")))).cast("double"),
            "f_segment": F.length(F.substring_index(path, "/", -1)).cast("double"),
            "suffix": F.substring_index(host, ".", -1),
            "segment": F.concat_ws("/", F.substring_index(host, ".", -1), F.get(F.split(path, "/"), F.lit(1))),
        }
    )


@dataclass(frozen=True)
class Model:
    """Fitted trees (None if nothing was labelled), suffix statistics and the overall block rate."""

    trees: PipelineModel | None
    rates: DataFrame | None
    overall: float


def _rates(labelled: DataFrame) -> DataFrame:
    """Labelled and blocked urls by suffix, and by suffix and first path segment."""
    return labelled.select("label", F.explode(F.array("suffix", "segment")).alias("part")).groupBy("part").agg(
        F.count("*").alias("n"), F.sum("label").alias("blocked")
    )


def _with_rates(urls: DataFrame, rates: DataFrame, overall: float, own: bool) -> DataFrame:
    """Smoothed block rates of each url's suffix and first segment; a training url does not count itself."""
    out = urls
    for part, feature in (("suffix", "f_suffix_rate"), ("segment", "f_first_segment_rate")):
        found = rates.withColumnsRenamed({"part": part + "_key", "n": "n__", "blocked": "b__"})
        mine, label = (F.lit(1), F.col("label")) if own else (F.lit(0), F.lit(0))
        out = (
            out.join(found, F.col(part) == F.col(part + "_key"), "left")
            .withColumn(
                feature,
                (F.coalesce("b__", F.lit(0)) - F.when(F.col("n__").isNull(), 0).otherwise(label) + PRIOR * overall)
                / (F.coalesce("n__", F.lit(0)) - F.when(F.col("n__").isNull(), 0).otherwise(mine) + PRIOR),
            )
            .drop(part + "_key", "n__", "b__")
        )
    return out


def train(labelled: DataFrame, sample: int = SAMPLE, trees: int = 10, depth: int = 4, seed: int = 7) -> Model:
    """Fit on ``labelled(url, label 0/1)``, 1 meaning block.

    Statistics count every labelled url; the trees see at most ``sample`` distinct ones, half of them of
    each label, chosen by the url's hash and weighted to the number of distinct urls of the label.  Repeated
    rows teach the trees once.  Without both labels there are no trees and every url gets the majority's
    verdict (allow, if there is none).
    """
    known = labelled.where("label IS NOT NULL").select("url", F.col("label").cast("int").alias("label"))
    known = known.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    total = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("blocked")).first()
    overall = total["blocked"] / total["n"] if total["n"] else 0.0
    if not 0 < overall < 1:
        return Model(None, None, overall)
    featured = with_features(known)
    rates = cut(_rates(featured))
    distinct = cut(known.select("url", "label").distinct())
    there = {r["label"]: r["count"] for r in distinct.groupBy("label").count().collect()}
    most = max(1, sample // 2)
    picked = [
        distinct.where(F.col("label") == label)
        .orderBy(F.xxhash64("url"), "url")
        .limit(most)
        .withColumn("weight", F.lit(max(1.0, count / most)))
        for label, count in sorted(there.items())
    ]
    chosen = with_features(
        cut(picked[0].union(picked[1])).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    )
    ready = cut(_with_rates(chosen, rates, overall, own=True).select(*FEATURES, "label", "weight"))
    fitted = Pipeline(
        stages=[
            VectorAssembler(inputCols=FEATURES, outputCol="features"),
            GBTClassifier(labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth, maxBins=64, stepSize=0.3, seed=seed),
        ]
    ).fit(ready)
    return Model(fitted, rates, overall)


def judge(urls: DataFrame, model: Model) -> DataFrame:
    """``urls(url, host, path, ...)`` with ``learned``: block or allow, by the trees."""
    if model.trees is None:
        return urls.withColumn("learned", F.lit("block" if model.overall > 0.5 else "allow"))
    keep = urls.columns
    scored = model.trees.transform(_with_rates(with_features(urls), model.rates, model.overall, own=False))
    return scored.select(*keep, F.when(F.col("prediction") > 0.5, "block").otherwise("allow").alias("learned"))


def filter_urls(
    urls: DataFrame, rules: list[Rule], url_col: str = "url", id_col: str = "page_id", labelled: DataFrame | None = None
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every url.

    Trained on ``labelled(url, label)``; without it, on the urls that the rules
    decide.  NULL urls and urls without ``://`` have empty host and path, fit no
    rule and are judged like any other; repeated rows keep one row each.
    """
    u = F.col(f"`{url_col}`")
    slim = urls.select(F.col(f"`{id_col}`").alias("page_id"), u.alias("url"), host_of(u).alias("host"), path_of(u).alias("path"))
    ruled = slim.withColumn("by_rule", apply_rules(F.col("host"), F.col("path"), rules))
    if labelled is None:
        labelled = ruled.where("by_rule IS NOT NULL").select(
            "url", (F.col("by_rule.verdict") == "block").cast("int").alias("label")
        )
    return judge(ruled, train(labelled)).select(
        "page_id",
        "host",
        "path",
        F.col("by_rule.rule").alias("rule"),
        F.coalesce("by_rule.verdict", "learned").alias("verdict"),
    )
