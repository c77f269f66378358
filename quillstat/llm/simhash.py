"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint is the bitwise majority of the XXH64 hashes of its
word shingles.  The 64 bits fall into two segments of 32.  Two fingerprints at
``max_distance`` or fewer differing bits agree in one segment up to
``max_distance // 2`` bits; so every fingerprint enumerates the Hamming ball of
that radius around each of its segments, looks the balls up in the table of
segments, and the full distance of what comes back is verified.

Scale.  Copies collapse first: all later work is on distinct fingerprints
(pre-aggregated), so a group of equal copies costs one row.  Of the two ends of
a link only the one whose lowest differing bit is set probes, which halves the
probes and loses nothing.  A segment value that more than ``HOT`` distinct
fingerprints share does not enter the join (it would make all pairs): its
members are dealt into chunks and each pair of chunks is searched in one
bounded task, which returns a spanning forest, not the pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh
from .components import connected_components

#: Distinct fingerprints on one segment value beyond which it is searched in chunks.
HOT = 64
#: Expected members of a chunk.
CHUNK = 2048

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_HALF = 0xFFFFFFFF


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of one text; no words: zero."""
    words = (text or "").encode("utf-8").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(p, 42) for p in parts], dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):  # bounded unpacking for very long texts
        ones += np.unpackbits(hashes[at : at + 65536].view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text_col: str, out: str, shingle: int = 3) -> DataFrame:
    """``docs`` with the fingerprint as a signed long column ``out``."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        values = np.fromiter((fingerprint(t, shingle) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(values.view(np.int64))

    return docs.withColumn(out, fp(F.col(f"`{text_col}`")))


def _forest(rows: pd.DataFrame, max_distance: int) -> pd.DataFrame:
    """Spanning forest of the links among one pair of chunks (breadth first)."""
    left = np.unique(rows["fp"].to_numpy(dtype=np.int64)).view(np.uint64)
    a, b = [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= max_distance
            if near.any():
                found, left = left[near], left[~near]
                a.append(np.full(len(found), x))
                b.append(found)
                queue.extend(found)
    pairs = [np.concatenate(x).view(np.int64) if x else np.zeros(0, np.int64) for x in (a, b)]
    return pd.DataFrame({"a": pairs[0], "b": pairs[1]})


def fingerprint_links(fps: DataFrame, max_distance: int = 3, hot: int = HOT, chunk: int = CHUNK) -> DataFrame:
    """Links ``(a, b)`` that connect distinct ``fps(fp long)`` at ``max_distance`` bits or fewer.

    The links returned have the same components as all links: below ``hot``
    members a segment value gives every link, beyond it a spanning forest.
    """
    radius = max_distance // 2
    masks = [0] + [
        sum(1 << bit for bit in bits) for n in range(1, radius + 1) for bits in combinations(range(32), n)
    ]
    # (mask, lowest bit): the end of a link that has the lowest differing bit set does the probing
    ball = F.array(*(F.struct(F.lit(m).cast("long").alias("m"), F.lit(m & -m).cast("long").alias("low")) for m in masks))

    def segments(value):
        return F.array(
            F.struct(F.lit(0).cast("long").alias("at"), F.shiftrightunsigned(value, 32).alias("v")),
            F.struct(F.lit(1 << 32).cast("long").alias("at"), value.bitwiseAND(F.lit(_HALF)).alias("v")),
        )

    parts = fps.select("fp", F.explode(segments(F.col("fp"))).alias("s")).select("fp", "s.at", "s.v")
    table = parts.select("fp", (F.col("at") + F.col("v")).alias("bucket"))
    probes = parts.select(
        "fp",
        F.explode(
            F.transform(
                F.filter(ball, lambda x: (x["m"] == 0) | (F.col("v").bitwiseAND(x["low"]) != 0)),
                lambda x: F.struct(
                    (F.col("at") + F.col("v").bitwiseXOR(x["m"])).alias("bucket"), (x["m"] == 0).alias("same")
                ),
            )
        ).alias("p"),
    ).select("fp", "p.bucket", "p.same")

    crowded = cut(table.groupBy("bucket").agg(F.count("*").alias("homes")).where(F.col("homes") > hot))
    some = not crowded.isEmpty()
    quiet = table.join(crowded, "bucket", "left_anti") if some else table
    found = (
        probes.withColumnRenamed("fp", "a")
        .join(quiet.withColumnRenamed("fp", "b"), "bucket")
        .where((F.col("a") != F.col("b")) & (~F.col("same") | (F.col("b") < F.col("a"))))
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)
        .select("a", "b")
    )
    if not some:
        return found
    guests = probes.join(crowded, "bucket")
    sizes = guests.groupBy("bucket").agg(F.count("*").alias("guests"))
    dealt = crowded.join(sizes, "bucket").select(
        "bucket",
        F.ceil(F.col("homes") / chunk).cast("long").alias("nh"),
        F.ceil(F.col("guests") / chunk).cast("long").alias("ng"),
    )
    turn = F.xxhash64("fp")
    blocks = (
        table.join(dealt, "bucket")
        .select("fp", "bucket", F.pmod(turn, "nh").alias("h"), F.explode(F.expr("sequence(0L, ng - 1)")).alias("g"))
        .union(
            probes.drop("same")
            .join(dealt, "bucket")
            .select("fp", "bucket", F.explode(F.expr("sequence(0L, nh - 1)")).alias("h"), F.pmod(turn, "ng").alias("g"))
        )
    )
    forest = blocks.groupBy("bucket", "h", "g").applyInPandas(
        lambda rows: _forest(rows, max_distance), "a long, b long"
    )
    return found.union(forest)


def classes(marked: DataFrame, id_col: str, fp_col: str, max_distance: int = 3) -> DataFrame:
    """One row per distinct fingerprint of ``marked``: ``fp, component_id, keeper_fp``.

    ``component_id`` is the smallest id of the fingerprint's component (NULL if
    all its ids are NULL); ``keeper_fp`` is the fingerprint that holds it.
    """
    reps = cut(
        marked.select(F.col(f"`{fp_col}`").alias("fp"), F.col(f"`{id_col}`").alias("id"))
        .groupBy("fp")
        .agg(F.min("id").alias("id"))
    )
    roots = connected_components(fingerprint_links(reps.select("fp"), max_distance))
    rooted = cut(
        reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "id", F.coalesce("root", "fp").alias("root")
        )
    )
    best = rooted.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp")).alias("k")
    )
    return rooted.join(best, "root").select(
        "fp", F.col("k.id").alias("component_id"), F.col("k.fp").alias("keeper_fp")
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 3
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits.  NULL and empty texts have the
    fingerprint zero and link like any other; repeated rows keep one row each;
    ids that are NULL are never a component's id unless all of it is NULL; an
    empty table gives an empty result.  Other columns are ignored.
    """
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    marked = cut(with_fingerprint(slim, "text", "fp", shingle).drop("text"))
    return marked.join(classes(marked, "id", "fp", max_distance), "fp").select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 3
) -> DataFrame:
    """``docs`` with one row of every component: the one that holds the smallest id.

    Rows that repeat that id with the same fingerprint count as one.
    """
    fp, known, given = fresh(docs, "fp__", "known__", "given__")
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    marked = cut(with_fingerprint(slim, "text", "fp", shingle).drop("text"))
    # plain equality on a NULL flag and a filled id: the join and the removal of repeats share one shuffle
    filled = lambda c: F.coalesce(c, F.lit(0))
    keep = (
        classes(marked, "id", "fp", max_distance)
        .where("fp = keeper_fp")
        .select(
            F.col("fp").alias(fp),
            F.col("component_id").isNull().alias(known),
            filled(F.col("component_id")).alias(given),
        )
    )
    keys = [fp, known, given]
    row_id = F.col(f"`{id_col}`")
    return (
        with_fingerprint(docs, text_col, fp, shingle)
        .withColumns({known: row_id.isNull(), given: filled(row_id)})
        .join(keep, keys, "left_semi")
        .dropDuplicates(keys)
        .drop(*keys)
    )
