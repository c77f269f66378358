"""Exact top-k inner products by a uniform threshold in three phases.

Each vector is split into ``PARTS`` runs of components; a part's inner product
is a local score, and the score is the sum of the local ones.

1. Gather: each part's ``k`` best local scores per query name the candidates;
   their scores, resolved exactly, give each query a safe cutoff, its k-th best.
2. Collect: a row whose local scores are all below cutoff / PARTS scores below
   the cutoff, so rows with a local score of at least that are sufficient.
3. Resolve: the remaining local scores of the collected rows are added, and the
   rows that reach the cutoff are ranked.

Scale: rows and queries are numbered and packed into blocks by number, so their
blocks do not depend on how the input is dealt over partitions.  Every block of
queries meets every block of rows where the two are brought together; matrix
products leave at most the local lists, or the rows that reach the cutoff, and
only those are shuffled.  Cutoffs travel with their block of queries, not
through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Runs of components with a local score each.
PARTS = 4
#: Vectors in a block, at most.
ROWS, QUERIES = 4096, 512
#: Pairs of a query and a row that are resolved together.
RESOLVED = 1 << 16
#: Doubles add integers exactly below this.
EXACT = 1 << 53

_BLOCK = "block long, ids binary, width int, data binary"


def quantized(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """``id long, v array<long>``: components times ``scale``, rounded down.

    NULL ids, and vectors that are NULL or hold NULL or non-finite components, have no row.  Rows equal in id
    and vector are one row; rows that share an id only are rows of their own.
    """
    v, i = F.col(f"`{vec_col}`"), F.col(f"`{id_col}`").cast("long")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (
        vectors.where(i.isNotNull() & v.isNotNull() & fine)
        .select(i.alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v"))
        .distinct()
    )


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of ``size`` vectors (the last has the rest) as int64 matrices; short vectors are filled with zeros.

    Rows get running numbers: their place in their partition after the rows of the partitions before it.  The
    table of partitions has one row for each.
    """

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        width = max(map(len, group["v"]))
        data = np.zeros((len(group), width), dtype=np.int64)
        for i, v in enumerate(group["v"]):
            data[i, : len(v)] = v
        ids = group["id"].to_numpy(dtype=np.int64)
        return pd.DataFrame({"block": group["block"][:1], "ids": [ids.tobytes()], "width": [width], "data": [data.tobytes()]})

    placed = cut(rows.select("id", "v", F.monotonically_increasing_id().alias("place")))
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("part"))
        .agg(F.count("*").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    blocked = placed.withColumn("part", part).join(offsets, "part")
    blocked = blocked.select("id", "v", F.floor((F.col("before") + within) / size).alias("block"))
    return _few(cut(blocked.groupBy("block").applyInPandas(pack, _BLOCK)))


def _few(blocks: DataFrame) -> DataFrame:
    """Blocks are few and large: no more partitions than blocks, or than there are cores."""
    return blocks.coalesce(max(1, min(blocks.count(), blocks.sparkSession.sparkContext.defaultParallelism)))


def _matrix(ids: bytes, width: int, data: bytes, wide: int) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, dtype=np.int64)
    rows = np.frombuffer(data, dtype=np.int64).reshape(len(names), width)
    return names, np.pad(rows, ((0, 0), (0, wide - width)))


def _blocks(pair) -> tuple[np.ndarray, ...]:
    """Ids and vectors of a pair of blocks, in doubles where these are exact."""
    wide = max(pair.qwidth, pair.width)
    qids, q = _matrix(pair.qids, pair.qwidth, pair.qdata, wide)
    ids, x = _matrix(pair.ids, pair.width, pair.data, wide)
    most = max(1, wide) * int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0))
    if most < EXACT:
        q, x = q.astype(np.float64), x.astype(np.float64)
    return qids, q, ids, x


def _runs(width: int) -> list[slice]:
    ends = [width * p // PARTS for p in range(PARTS + 1)]
    return [slice(a, b) for a, b in zip(ends, ends[1:])]


def _own(qids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which row is the query itself: it has its id and its vector."""
    own = qids[:, None] == ids[None, :]
    at, to = np.nonzero(own)
    own[at, to] = (q[at] == x[to]).all(axis=1)
    return own


_FOUND = "query long, query_id long, vec_id long, score long"


def _found(block: int, at: np.ndarray, qids: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> pd.DataFrame:
    """The k best rows of each query: the rest of a block can't be among them."""
    order = np.lexsort((ids, -score, at))
    rows = pd.DataFrame({"query": (block << 32) + at, "query_id": qids[at], "vec_id": ids, "score": score})
    return rows.iloc[order].groupby("query", sort=False).head(k)


def _gather(k: int):
    def local_lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pair in (pair for batch in batches for pair in batch.itertuples(index=False)):
            qids, q, ids, x = _blocks(pair)
            own = _own(qids, q, ids, x)
            chosen = np.zeros(own.shape, dtype=bool)
            for run in _runs(q.shape[1]):
                local = q[:, run] @ x[:, run].T
                local[own] = -np.inf if local.dtype == np.float64 else np.iinfo(np.int64).min + 1
                n = min(k, len(ids))
                best = np.argpartition(-local, n - 1, axis=1)[:, :n]
                np.put_along_axis(chosen, best, True, axis=1)
            at, to = np.nonzero(chosen & ~own)
            score = np.einsum("ij,ij->i", q[at], x[to]).astype(np.int64)
            yield _found(pair.qblock, at, qids, ids[to], score, k)

    return local_lists


def _collect(k: int):
    def sufficient(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pair in (pair for batch in batches for pair in batch.itertuples(index=False)):
            qids, q, ids, x = _blocks(pair)
            cutoff = np.full(len(qids), -(1 << 62), dtype=np.int64)
            known = pair.cutoffs if pair.cutoffs is not None else ()
            for c in known:
                cutoff[c["at"]] = c["score"]
            # local >= cutoff / PARTS, in integers
            enough = np.zeros((len(qids), len(ids)), dtype=bool)
            least = -((-cutoff) // PARTS)
            for run in _runs(q.shape[1]):
                enough |= (q[:, run] @ x[:, run].T) >= least[:, None]
            at, to = np.nonzero(enough & ~_own(qids, q, ids, x))
            del enough
            for first in range(0, len(at), RESOLVED):
                some, rows = at[first : first + RESOLVED], to[first : first + RESOLVED]
                score = np.einsum("ij,ij->i", q[some], x[rows]).astype(np.int64)
                reach = score >= cutoff[some]
                yield _found(pair.qblock, some[reach], qids, ids[rows[reach]], score[reach], k)

    return sufficient


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id long, rank int, vec_id long, score long`` for ``rows`` and ``queries`` of ``(id, v)``.

    A query meets every row but the one with its id and its vector; rows that share its id only are candidates,
    and queries that share an id have a result each.  Fewer rows give fewer results; ties go to the smaller
    ``vec_id``.  Scores must fit 64 bits.  No rows or no queries: no result.
    """
    blocks = _packed(rows, ROWS)
    asked = _packed(queries, QUERIES).withColumnsRenamed(
        {"block": "qblock", "ids": "qids", "width": "qwidth", "data": "qdata"}
    )
    # stated queries against all rows, block by block: each pair of blocks is one row here
    gathered = asked.crossJoin(blocks.drop("block")).mapInPandas(_gather(k), _FOUND)
    floor = _ranked(gathered, k).groupBy("query").agg(F.min("score").alias("score"), F.count("*").alias("n"))
    # a query with fewer than k candidates has no cutoff: all its rows are wanted
    cutoffs = (
        floor.where(F.col("n") == k)
        .groupBy(F.shiftright("query", 32).alias("qblock"))
        .agg(F.collect_list(F.struct(F.col("query").bitwiseAND(F.lit((1 << 32) - 1)).alias("at"), "score")).alias("cutoffs"))
    )
    armed = _few(cut(asked.join(cutoffs, "qblock", "left")))
    collected = armed.crossJoin(blocks.drop("block")).mapInPandas(_collect(k), _FOUND)
    return _ranked(collected, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
