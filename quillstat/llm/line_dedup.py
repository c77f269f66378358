"""Line dedup by winnowing over line hashes, in DataFrame functions only.

A document is the sequence of its lines that hold a word, between one sentinel
at the start and one at the end (so a repeated first or last line is a run).
Of every ``window`` consecutive hashes the minimum is selected, the rightmost of
equals; two texts that share a run of ``window`` lines select the same line in
it, so selected lines are guaranteed fingerprints of shared runs.

1. Select the window minima and keep the fingerprints found at two positions
   or more (pre-aggregated, one hash per line; nothing else goes on).
2. Extend each surviving position both ways as far as the windows that selected
   it, and join positions whose extended windows are equal.  The join goes to
   the earliest such position, not to all, so a line that a third of all
   documents carry costs one row each and never makes pairs.
3. Later positions delete their window; windows that touch make one run, which
   is the full extension of the match in the later text.

A line of ``alone`` words or more is a window by itself too, so a long passage
goes wherever it repeats; shorter lines need an equal neighbour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE, count_words, cut, fresh

#: Stands for the start and the end of a text; never a window's minimum beside a line.
SENTINEL = (1 << 63) - 1
#: Words from which a repeated line is a run whatever stands beside it.
ALONE = 20


def _windows(docs: DataFrame, id_col: str, text_col: str, window: int, alone: int | None) -> DataFrame:
    """One row per window: ``id, th, s`` (where), ``key`` (its hashes), ``print`` and ``at`` (the minimum), ``first, last`` (lines)."""

    def is_long(line):
        if alone is None:
            return F.lit(False)
        return (F.length(line) >= 2 * alone - 1) & (count_words(line) >= alone)

    text = F.col(f"`{text_col}`")
    lines = F.transform(
        F.split(text, "\n"),
        lambda x, i: F.struct(F.trim(x, F.lit(WHITE)).alias("t"), i.cast("int").alias("i")),
    )
    items = F.transform(
        F.filter(lines, lambda x: F.length(x["t"]) > 0),
        lambda x: F.struct(F.xxhash64(x["t"]).alias("h"), x["i"].alias("i"), is_long(x["t"]).alias("long")),
    )
    end = F.array(F.struct(F.lit(SENTINEL).alias("h"), F.lit(-1).alias("i"), F.lit(False).alias("long")))
    windowed = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("items") - (window - 1))),
        lambda s: F.struct((s - 1).alias("s"), F.slice("items", s, window).alias("w")),
    )
    single = F.filter(
        F.transform("items", lambda x, i: F.struct(i.alias("s"), F.array(x).alias("w"))), lambda y: y["w"][0]["long"]
    )
    return (
        docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("th"), items.alias("items"))
        .where(F.size("items") > 0)
        .select("id", "th", F.concat(end, "items", end).alias("items"))
        .select("id", "th", F.explode(windowed if alone is None else F.concat(windowed, single)).alias("at"))
        .select("id", "th", "at.s", "at.w")
        .select(
            "id",
            "th",
            "s",
            F.transform("w", lambda x: x["h"]).alias("key"),
            F.transform(F.filter("w", lambda x: x["i"] >= 0), lambda x: x["i"]).alias("on"),
        )
        .where(F.size("on") > 0)
        .select(
            "id",
            "th",
            "s",
            "key",
            F.array_min("key").alias("print"),
            (F.col("s") + F.size("key") - F.array_position(F.reverse("key"), F.array_min("key"))).cast("int").alias("at"),
            F.array_min("on").alias("first"),
            F.array_max("on").alias("last"),
        )
    )


def repeated_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 2, alone: int | None = ALONE
) -> DataFrame:
    """Later repeated runs: ``id, th, runs array<struct<first int, last int>>`` (line numbers from 0).

    ``th`` is the XXH64 of the text; ``(id, th)`` names a document, in whose
    order earlier and later are meant (NULL ids first).  Rows equal in both are
    one document.  Documents without a later repeated run have no row.  With
    ``alone=None`` no line is a run by itself.
    """
    windows = _windows(docs, id_col, text_col, window, alone)
    place = F.struct("id", "th", "at")
    # both tables of repeats are cut: a join on a table read from files can split a hot fingerprint or window
    shared = cut(
        windows.groupBy("print").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo <> hi").select("print")
    )
    positions = cut(windows.join(shared, "print").drop("print", "at"))
    start = F.struct("id", "th", "s")
    earliest = cut(
        positions.groupBy("key")
        .agg(F.min(start).alias("origin"), F.max(start).alias("newest"))
        .where("origin <> newest")
        .drop("newest")
    )
    later = (
        positions.join(earliest, "key")
        .where(~F.struct("id", "th", "s").eqNullSafe(F.col("origin")))
        .select("id", "th", "first", "last")
        .distinct()
    )
    here = Window.partitionBy("id", "th").orderBy("first", "last")
    reach = F.max("last").over(here.rowsBetween(Window.unboundedPreceding, -1))
    return (
        later.withColumn("new", F.coalesce((F.col("first") > reach + 1).cast("int"), F.lit(1)))
        .withColumn("run", F.sum("new").over(here.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("id", "th", "run")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .groupBy("id", "th")
        .agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"))
    )


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 2,
    runs_col: str | None = None,
    alone: int | None = ALONE,
) -> DataFrame:
    """``docs`` with later repeated runs of lines taken out of the text.

    The lines kept stay as they are, joined by ``\\n``; blank lines go only
    within a run.  A text of which nothing is left is empty, a NULL text stays
    NULL, and no row is dropped.  All columns are kept; ``runs_col`` adds the
    deleted runs (NULL where there are none).
    """
    id_, th, runs, lines = fresh(docs, "id__", "th__", "runs__", "lines__")
    found = repeated_runs(docs, id_col, text_col, window, alone).select(
        F.col("id").alias(id_), F.col("th").alias(th), F.col("runs").alias(runs)
    )
    whole = docs.withColumn(th, F.xxhash64(F.col(f"`{text_col}`")))
    joined = whole.join(found.withColumnRenamed(th, th + "_"), F.col(id_).eqNullSafe(whole[f"`{id_col}`"]) & (F.col(th + "_") == whole[th]), "left")
    n = F.size(runs)
    parts = F.transform(
        F.sequence(F.lit(0), n),
        lambda k: F.struct(
            F.when(k == 0, 0).otherwise(F.col(runs)[k - 1]["last"] + 1).alias("a"),
            F.when(k == n, F.size(lines)).otherwise(F.get(F.col(runs), k)["first"]).alias("b"),
        ),
    )
    left = F.flatten(F.transform(parts, lambda p: F.slice(lines, p["a"] + 1, p["b"] - p["a"])))
    out = (
        joined.withColumn(lines, F.when(F.col(runs).isNotNull(), F.split(F.col(f"`{text_col}`"), "\n")))
        .withColumn(text_col, F.when(F.col(runs).isNull(), F.col(f"`{text_col}`")).otherwise(F.array_join(left, "\n")))
    )
    keep = [F.col(f"`{c}`") for c in docs.columns]
    return out.select(*keep, *([F.col(runs).alias(runs_col)] if runs_col else []))
