"""Sharding by fixed virtual slots.

Records hash into a fixed number of slots; a small versioned map, stored in a
shared folder, says which shard holds which slot.  A record never changes its
slot.  The first version is fitted to the bytes each slot holds, largest slot
first to the emptiest shard; later versions edit the one before, and only the
edited slots move.  Records that repeat get running numbers, which take part in
the hash, so copies spread over the slots instead of filling one.

Scale: one pre-aggregated pass gives bytes and rows per slot; the map has one row
per slot (``SLOTS``, whatever the input), so it is handled on the driver and
joined by broadcast.  Positions inside a shard are the slot's offset plus the
place inside the slot, so the largest sort is one slot.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir
from .common import copy_numbers, cut, fresh

#: Virtual slots; fixed for the life of a data set.
SLOTS = 4096
MAP = "version int, vslot int, shard int"


def slot_of(key: Column, *more: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of a record."""
    return F.pmod(F.xxhash64(key, *more), F.lit(slots)).cast("int")


def slotted(records: DataFrame, identity: list[str], slots: int = SLOTS) -> DataFrame:
    """``records`` with ``vslot``, from the columns ``identity`` and a record's number among those equal in them.

    NULLs are values like any other.  Columns named ``vslot`` or ``copy`` are replaced.
    """
    same = F.xxhash64(*(F.col(f"`{c}`") for c in identity))
    numbered = copy_numbers(records.drop("vslot", "copy"), same, "copy")
    return cut(numbered.withColumn("vslot", slot_of(same, F.col("copy"), slots=slots)))


def slot_sizes(records: DataFrame) -> dict[int, tuple[int, int]]:
    """``records(vslot, size)`` -> bytes and rows of each slot that has any (at most one per slot)."""
    sums = records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    return {r["vslot"]: (r["bytes"], r["rows"]) for r in sums.collect()}


def fit_map(sizes: dict[int, int], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """Slot -> shard, for every slot: the largest slot goes to the shard that has least."""
    import heapq

    heap = [(0, s) for s in range(shards)]
    out = {}
    for slot in sorted(range(slots), key=lambda x: (-sizes.get(x, 0), x)):
        held, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (held + sizes.get(slot, 0), shard))
    return out


def rebalance(current: dict[int, int], sizes: dict[int, int], shards: int, tolerance: float = 0.01) -> dict[int, int]:
    """Edit a map for new sizes or another number of shards, moving few slots.

    Slots of shards that are gone move to the emptiest shard; then, while the
    fullest shard is above the mean by more than ``tolerance``, its largest slot
    that lowers the spread goes to the emptiest.
    """
    new = dict(current)
    held = dict.fromkeys(range(shards), 0)
    homeless = [s for s, shard in current.items() if shard >= shards]
    for slot, shard in current.items():
        if shard < shards:
            held[shard] += sizes.get(slot, 0)
    for slot in sorted(homeless, key=lambda x: (-sizes.get(x, 0), x)):
        new[slot] = min(held, key=lambda s: (held[s], s))
        held[new[slot]] += sizes.get(slot, 0)
    mean = sum(held.values()) / shards
    while True:
        full, empty = max(held, key=lambda s: (held[s], -s)), min(held, key=lambda s: (held[s], s))
        gap = held[full] - held[empty]
        movable = [s for s, shard in new.items() if shard == full and 0 < sizes.get(s, 0) < gap]
        if held[full] <= mean * (1 + tolerance) or not movable:
            return new
        # the slot nearest to half the gap evens the two out best
        slot = min(movable, key=lambda s: (abs(2 * sizes[s] - gap), s))
        new[slot] = empty
        held[full] -= sizes[slot]
        held[empty] += sizes[slot]


def save_map(spark: SparkSession, path: str, version: int, slot_map: dict[int, int]) -> None:
    """Append a version of the map; an existing version is never changed."""
    if version in map_versions(spark, path):
        raise ValueError(f"version {version} exists")
    rows = [(version, slot, shard) for slot, shard in sorted(slot_map.items())]
    spark.createDataFrame(rows, MAP).coalesce(1).write.mode("append").parquet(path)


def map_versions(spark: SparkSession, path: str) -> list[int]:
    try:
        return sorted(r[0] for r in spark.read.schema(MAP).parquet(path).select("version").distinct().collect())
    except AnalysisException:  # nothing saved yet
        return []


def load_map(spark: SparkSession, path: str, version: int | None = None) -> dict[int, int]:
    """A version of the map, the newest if none is named."""
    version = max(map_versions(spark, path)) if version is None else version
    rows = spark.read.schema(MAP).parquet(path).where(F.col("version") == version).collect()
    return {r["vslot"]: r["shard"] for r in rows}


def new_folder(spark: SparkSession) -> str:
    """A folder for a map's versions in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/slot-map-{uuid.uuid4()}"


def current_map(spark: SparkSession, path: str, sizes: dict[int, tuple[int, int]], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """The newest version of the map in ``path`` for slots of these bytes and rows.

    Without a version one is fitted; a version that is out of balance, or of another number of shards, is
    edited and the edit saved as the next.  What is returned is what was read back.
    """
    held = {slot: size for slot, (size, _) in sizes.items()}
    versions = map_versions(spark, path)
    if not versions:
        save_map(spark, path, 1, fit_map(held, shards, slots))
    else:
        old = load_map(spark, path, versions[-1])
        new = rebalance(old, held, shards)
        if new != old:
            save_map(spark, path, versions[-1] + 1, new)
    return load_map(spark, path)


def map_table(spark: SparkSession, slot_map: Iterable[tuple[int, int, int]]) -> DataFrame:
    """``(vslot, shard, before)`` rows as a table; one row per slot."""
    return spark.createDataFrame(list(slot_map), "vslot int, shard int, before long")


def assign(records: DataFrame, order: list[str], slot_map: dict[int, int]) -> DataFrame:
    """Records with ``vslot`` as ``slotted`` gives them, with ``shard int`` and ``place long``, gapless from 0 in each shard.

    ``order`` names the columns that order rows inside a slot; rows equal in all of them are alike, so either order
    is the same result.  Input columns named ``shard`` or ``place`` are replaced, any others stay; an empty table
    has no places.
    """
    kept = [c for c in records.columns if c.lower() not in ("shard", "place")]
    inside, before, slot, shard = fresh(records, "inside__", "before__", "slot__", "shard__")
    filled: dict[int, int] = {}
    rows = []
    for s, (_, n) in sorted(slot_sizes(records).items()):
        rows.append((s, slot_map[s], filled.get(slot_map[s], 0)))
        filled[slot_map[s]] = rows[-1][2] + n
    table = map_table(records.sparkSession, rows).toDF(slot, shard, before)
    place = F.row_number().over(Window.partitionBy("vslot").orderBy(*(F.col(f"`{c}`") for c in order))) - 1
    return (
        records.withColumn(inside, place)
        .join(F.broadcast(table), F.col("vslot") == F.col(slot))  # one row per slot
        .select(*(F.col(f"`{c}`") for c in kept), F.col(shard).alias("shard"), (F.col(before) + F.col(inside)).cast("long").alias("place"))
    )
