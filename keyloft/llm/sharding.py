"""Sharding by fixed virtual slots.

Records hash into a fixed number of slots, bytes are summed per slot, and a small versioned map
sends slots to shards. Rebalancing and growing edit the map; records never change their slot. The
law of the result is `bytes`: shards get nearly equal bytes.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, load

SLOTS = 4096  # fixed for the life of a data set; the map, and what the driver sees, has so many rows


def slot_of(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of a record; rows with null or equal ids still spread by their texts."""
    return F.pmod(F.xxhash64(doc_id, F.crc32(text)), F.lit(slots)).cast("int")


def slot_loads(slotted: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of each slot, from columns virtual_slot and size; `slots` rows at most reach the driver."""
    size, rows = [0] * slots, [0] * slots
    for s, b, n in slotted.groupBy("virtual_slot").agg(F.sum("size"), F.count("*")).collect():
        size[s], rows[s] = b, n
    return size, rows


def assign(size: list[int], shards: int) -> list[int]:
    """A first map: the largest slots go first, each to the lightest shard; ties by number."""
    heap, out = [(0, s) for s in range(shards)], [0] * len(size)
    for slot in sorted(range(len(size)), key=lambda i: (-size[i], i)):
        load_, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load_ + size[slot], shard))
    return out


def rebalance(shard_of: list[int], size: list[int], shards: int, slack: float = 0.01) -> list[int]:
    """The next version of a map: moves slots off the heaviest shard until all are within `slack` of the mean.

    More shards than before start empty. Each move takes the largest slot that narrows the gap, so
    few slots move; it ends when no move helps.
    """
    out, total = list(shard_of), [0] * shards
    held: list[list[int]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(out):
        total[shard] += size[slot]
        held[shard].append(slot)
    mean = sum(total) / shards
    while True:
        high, low = max(range(shards), key=total.__getitem__), min(range(shards), key=total.__getitem__)
        if total[high] <= mean * (1 + slack) and total[low] >= mean * (1 - slack):
            return out
        gap = total[high] - total[low]
        fits = [s for s in held[high] if 0 < size[s] and 2 * size[s] <= gap] or [s for s in held[high] if 0 < size[s] < gap]
        if not fits:
            return out
        slot = max(fits, key=lambda s: (size[s], -s))
        held[high].remove(slot)
        held[low].append(slot)
        out[slot], total[high], total[low] = low, total[high] - size[slot], total[low] + size[slot]


def write_map(spark: SparkSession, shard_of: list[int], version: int, path: str) -> None:
    """Store a version of the map under `path`; earlier versions stay."""
    rows = [(version, slot, shard) for slot, shard in enumerate(shard_of)]
    spark.createDataFrame(rows, "version int, virtual_slot int, shard int").coalesce(1).write.parquet(f"{path}/v={version}")


def read_map(spark: SparkSession, version: int, path: str) -> list[int]:
    rows = spark.read.parquet(f"{path}/v={version}").select("virtual_slot", "shard").collect()
    return [shard for _, shard in sorted(rows)]


def even(slots: int, shards: int) -> list[int]:
    """The map of a data set without rows yet: slots dealt in turn."""
    return [v % shards for v in range(slots)]


def place(slotted: DataFrame, shard_of: list[int], rows: list[int], order: list[str]) -> DataFrame:
    """slotted plus shard and slot: the place of a record in its shard, gapless from 0.

    Each virtual slot's records follow one another by `order`, slots by number, so only a window
    within a virtual slot is needed; the starts come from the slots' row counts. Rows that are equal
    in all columns are counted before, so that many of them don't meet in one task.
    """
    spark, starts, at = slotted.sparkSession, [], {}
    for v, shard in enumerate(shard_of):
        starts.append((v, shard, at.get(shard, 0)))
        at[shard] = at.get(shard, 0) + rows[v]
    table = spark.createDataFrame(starts, "virtual_slot int, shard int, _start long")
    equal = slotted.groupBy(*slotted.columns).agg(F.count(F.lit(1)).alias("_copies"))
    before = Window.partitionBy("virtual_slot").orderBy(*order, *(c for c in slotted.columns if c not in order)).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("_copies").over(before), F.lit(0))
    placed = equal.withColumn("_inside", inside).join(F.broadcast(table), "virtual_slot")
    placed = placed.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
    return placed.withColumn("slot", (F.col("_start") + F.col("_inside") + F.col("_copy")).cast("long")).drop("_start", "_inside", "_copies", "_copy")


def write_shards(docs: DataFrame, shard_of: list[int], path: str) -> None:
    """Write docs as one folder per shard."""
    table = docs.sparkSession.createDataFrame(list(enumerate(shard_of)), "_v int, shard int")
    slotted = docs.withColumn("_v", slot_of(F.col("doc_id"), F.col("text"), len(shard_of)))
    slotted.join(F.broadcast(table), "_v").drop("_v").write.partitionBy("shard").parquet(path)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot of each row; a null text has size 1 and the crc32 of no bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), slot_of(F.col("doc_id"), text).alias("virtual_slot")
    )


def shard(docs: DataFrame, scratch: Scratch, shards: int = 8) -> DataFrame:
    """docs (doc_id, text) as doc_id, size, text_crc32, virtual_slot, shard and slot, by the law `bytes`.

    Version 1 of the map deals slots in turn, before any bytes are known; the first rebalancing
    edits it by the bytes that the slots have got, and the rows are placed by version 2. Equal rows
    share a virtual slot and get places of their own. An empty table gives an empty one.
    """
    spark, path = docs.sparkSession, scratch.path("map")
    slotted = scratch.write(sized(docs), "slotted")
    size, rows = slot_loads(slotted)
    write_map(spark, even(SLOTS, shards), 1, path)
    write_map(spark, rebalance(read_map(spark, 1, path), size, shards, slack=0.0), 2, path)
    return place(slotted, read_map(spark, 2, path), rows, ["doc_id", "text_crc32", "size"])


def op5_shard(spark, sf_dir: str, shards: int = 8) -> DataFrame:
    placed = shard(load(spark, sf_dir, "documents"), Scratch(spark, "op5"), shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
