"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Fixed value: a word is a run of code points other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: The characters of ASCII white space, for trimming.
WHITE = " \t\n\x0b\x0c\r"


#: Whole texts that go to a Python worker at a time.
TEXTS_PER_BATCH = 1000


def text_batches(df: DataFrame) -> None:
    """Keep Arrow batches of whole texts small: Spark bounds them by rows only, and a row may be long."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= TEXTS_PER_BATCH:
        conf.set(name, str(TEXTS_PER_BATCH))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files.

    The files outlive executors, so what follows never recomputes (or loses)
    what came before.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The same by way of Parquet, which compresses: for tables of large binary values."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into runs of rows with about ``most`` bytes of ``column`` at the most (one row at least)."""
    for batch in batches:
        sizes = batch.column(column)
        upto = np.cumsum(np.fromiter((0 if x is None else x for x in _byte_lengths(sizes)), dtype=np.int64, count=len(sizes)))
        at = 0
        while at < len(upto):
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, side="right")))
            yield batch.slice(at, end - at)
            at = end


def _byte_lengths(texts: pa.Array) -> list:
    return pa.compute.binary_length(texts).to_pylist()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def copy_numbers(rows: DataFrame, key: Column, out: str) -> DataFrame:
    """``rows`` with ``out long``: the running number, from 0, of a row among those of its ``key`` (not NULL).

    Keys found once need no numbers and no shuffle of whole rows.  The rows of the others are written once, and
    numbered by partition: a row's place in its key and partition after the key's rows in the partitions before, so
    a key with a third of all rows is dealt like any other.  Which of a key's rows gets which number is open.
    """
    k, place, part, before = fresh(rows, "key__", "place__", "part__", "before__")
    keyed = rows.withColumn(k, key)
    again = cut(keyed.groupBy(k).agg(F.count("*").alias("n")).where("n > 1").select(k))
    hot = cut(keyed.join(again, k).withColumn(place, F.monotonically_increasing_id()))
    hot = hot.withColumn(part, F.shiftright(place, 33))
    earlier = Window.partitionBy(k).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hot.groupBy(k, part)
        .agg(F.count("*").alias("n"))
        .select(k, part, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    )
    inside = F.row_number().over(Window.partitionBy(k, part).orderBy(place)) - 1
    kept = [F.col(f"`{c}`") for c in rows.columns if c != out]
    numbered = hot.withColumn(out, inside).join(offsets, [k, part]).select(*kept, (F.col(out) + F.col(before)).cast("long").alias(out))
    once = keyed.join(again, k, "left_anti").select(*kept, F.lit(0).cast("long").alias(out))
    return once.union(numbered)


def count_words(text: Column) -> Column:
    """Number of words; NULL text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def host_of(url: Column) -> Column:
    """Host of a url: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """Path of a url: what follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))
