"""Mixing sources to target weights.

Tokens are summed per source; the targets give each source a repetition rate;
a document goes out ``floor(rate)`` times, plus once more if its hash-seeded
draw falls under the fraction that is left.  The draw depends on the id, the text
and the seed, and rows equal in both are told apart by a running number, so the
copies of a document that fills its source draw one by one and the target is met.
Reruns and lost executors change nothing but which of equal rows goes out.

Scale: one pre-aggregated pass for the sums, one for the keys found more than
once, then a map over documents.  Only the source table (a row per source) is
ordered and joined, and it is broadcast only where its measured size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import copy_numbers, count_words, cut, fresh

#: Weights by a source's place, repeating.
WEIGHTS = (5, 2, 1)
#: All targets together, as a share of all sizes.
SHARE = 1.5
#: No target is above so many times its source's size.
LIMIT = 2.0


def source_rates(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT
) -> DataFrame:
    """``sized(source, size)`` -> ``source, source_size long, target double, rate double``.

    Sources take their weights in code point order, NULL last.  Targets that
    exceed ``limit`` times their source stop there and the rest is shared again
    by weight: in order of limit / weight the stopped sources come first, so one
    pass over running sums settles it.  A source without words has rate 0.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights) + 1).cast("int"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy("full_at", F.asc_nulls_last("source"))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    ordered = (
        sums.withColumn("w", weight)
        .withColumn("most", F.lit(float(limit)) * F.col("source_size"))
        .withColumn("full_at", F.col("most") / F.col("w"))
        .withColumn("pot", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("left_pot", F.col("pot") - F.coalesce(F.sum("most").over(earlier), F.lit(0.0)))
        .withColumn("left_w", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(earlier), F.lit(0.0)))
        .withColumn("full", F.col("full_at") * F.col("left_w") <= F.col("left_pot"))
    )
    # the first source that is not full has what all of them share, by weight
    level = F.max(F.when(~F.col("full"), F.struct(-F.col("full_at"), F.col("left_pot") / F.col("left_w")))).over(everything)
    target = F.when(F.col("full"), F.col("most")).otherwise(level["col2"] * F.col("w"))
    return ordered.withColumn("target", target).select(
        "source",
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def copies(rate: Column, key: Column, number: Column, seed: str) -> Column:
    """How many times a document goes out: whole part of the rate, plus a draw for the rest."""
    digest = F.md5(F.concat_ws(":", key, number.cast("string"), F.lit(seed)).cast("binary"))
    draw = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")


def _key(doc_id: Column, text: Column) -> Column:
    """What a draw depends on besides the running number; NULL ids and texts are empty."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _same(key: Column, source: Column) -> Column:
    return F.xxhash64(key, source)


def planned(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", **law
) -> DataFrame:
    """The mix as a plan: ``id, size long, source_size long, target double, copies long`` for every row of ``docs``.

    Size is the number of words (NULL text: 0); NULL sources are one source; other columns are ignored, so none
    can clash.  Rows equal in id, text and source draw one by one; an empty table has no plan.
    """
    id_, text, source = (F.col(f"`{c}`") for c in (id_col, text_col, source_col))
    sized = cut(docs.select(id_.alias("id"), source.alias("source"), count_words(text).alias("size"), _key(id_, text).alias("key")))
    rates = source_rates(sized.select("source", "size"), **law).withColumnRenamed("source", "of")
    numbered = copy_numbers(sized, _same(F.col("key"), F.col("source")), "number")
    joined = numbered.join(rates, F.col("of").eqNullSafe(F.col("source")), "left")
    times = copies(F.col("rate"), F.col("key"), F.col("number"), seed)
    return joined.select("id", "size", "source_size", "target", times.alias("copies"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = "mix",
    **law,
) -> DataFrame:
    """``docs`` with every row as often as the mix takes it (0 times or more); the columns stay.

    Size is the number of words (NULL text: 0); rows equal in id, text and source draw one by one;
    NULL sources are one source; an empty table stays empty.
    """
    of, rate, n, key, number = fresh(docs, "of__", "rate__", "copies__", "draw__", "number__")
    id_, text, source = (F.col(f"`{c}`") for c in (id_col, text_col, source_col))
    sized = docs.select(source.alias("source"), count_words(text).alias("size"))
    rates = source_rates(sized, **law).select(F.col("source").alias(of), F.col("rate").alias(rate))
    numbered = copy_numbers(docs, _same(_key(id_, text), source), number).withColumn(key, _key(id_, text))
    joined = numbered.join(rates, F.col(of).eqNullSafe(source), "left")
    times = copies(F.col(rate), F.col(key), F.col(number), seed)
    keep = [F.col(f"`{c}`") for c in docs.columns]
    return joined.withColumn(n, F.explode(F.array_repeat(F.lit(0), times.cast("int")))).select(*keep)
