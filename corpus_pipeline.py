"""A training corpus from raw documents, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps; ``run``
writes each result as Parquet to the shared checkpoint folder and reads it again
as the next stage's documents, so a lost executor never costs more than a stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstat.llm import bpe, line_dedup, mixing, quality, simhash
from quillstat.llm.common import fresh
from quillstat.llm.queries import VOCABULARY
from quillstat.session import ensure_checkpoint_dir, read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the production policy.  NULL and empty texts have too few words and go; repeated rows are
    judged one by one; an empty table stays empty."""
    (m,) = fresh(docs, "ledger__")
    return quality.ledger(docs, "text", m).where(quality.passes(F.col(m)["failed"])).drop(m)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of later repeated runs; ``n_chars`` follows the text (NULL for a NULL text).
    Rows equal in id and text are one document to it: they lose the same lines."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id; of rows that share it, one.  NULL and
    empty texts are equal texts."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of its source take it.  NULL sources are one source; repeated rows
    draw one by one."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, verified by decoding: ``round_trip`` says whether the text came back.  A NULL text has
    no tokens and comes back as the empty one; every row keeps a row."""
    vocabulary = bpe.load(spark, VOCABULARY)
    coded = bpe.encode(docs.select("doc_id", "source", "text"), "text", vocabulary, "ids")
    return bpe.decode(coded, "ids", vocabulary, "decoded").select(
        "doc_id",
        "source",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"),
        "ids",
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("near duplicates", near_duplicates),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: SQL can express neither the fingerprints nor the encoding; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4()}"
    docs = read_table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
    return docs
