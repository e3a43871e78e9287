"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Records hash into a fixed number of virtual slots. Bytes and rows are summed per slot, and a small map
(one row per slot, whatever the corpus) says which shard owns a slot. The map is a table of versions:
rebalancing and growing write a new version that moves as few slots as they need and leaves the others.

Defined cases: a null text has no bytes; a null id hashes like a value; repeated rows share a slot and get
different places; an empty table gives an empty map load and no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwise.llm.shared import new_folder, partitions

SLOTS = 8192
OVERHEAD = 8  # bytes that a record takes besides its text

MAP_SCHEMA = "version int, virtual_slot int, shard int, bytes long, rows long"


@dataclass(frozen=True)
class SlotLoad:
    slot: int
    bytes: int
    rows: int


@dataclass(frozen=True)
class SlotMap:
    """Which shard owns each slot, with the loads that it was made for."""

    version: int
    shards: int
    owner: tuple[int, ...]
    loads: tuple[SlotLoad, ...]

    def shard_bytes(self) -> list[int]:
        total = [0] * self.shards
        for load in self.loads:
            total[self.owner[load.slot]] += load.bytes
        return total


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot) of each row; the text itself goes no further."""
    content = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        "doc_id",
        (F.octet_length(content).cast("long") + F.lit(OVERHEAD)).alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id"), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_loads(rows: DataFrame, slots: int = SLOTS) -> list[SlotLoad]:
    """Bytes and rows of every slot; the driver gets one row per slot, at most `slots`."""
    found = {
        r["virtual_slot"]: SlotLoad(r["virtual_slot"], r["bytes"], r["n"])
        for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    }
    return [found.get(s, SlotLoad(s, 0, 0)) for s in range(slots)]


def first_map(loads: list[SlotLoad], shards: int) -> SlotMap:
    """Largest slot first, each to the shard with the fewest bytes (then rows, then slots)."""
    heap = [(0, 0, 0, shard) for shard in range(shards)]
    owner = [0] * len(loads)
    for load in sorted(loads, key=lambda x: (-x.bytes, -x.rows, x.slot)):
        size, rows, held, shard = heapq.heappop(heap)
        owner[load.slot] = shard
        heapq.heappush(heap, (size + load.bytes, rows + load.rows, held + 1, shard))
    return SlotMap(1, shards, tuple(owner), tuple(loads))


def rebalance(current: SlotMap, loads: list[SlotLoad], tolerance: float = 0.02) -> SlotMap:
    """Next version for new loads: slots leave the fullest shard for the emptiest until all are within
    the tolerance of the mean, or no single move narrows the gap. Other slots stay where they are."""
    owner = list(current.owner)
    total = SlotMap(current.version, current.shards, current.owner, tuple(loads)).shard_bytes()
    held: list[list[SlotLoad]] = [[] for _ in range(current.shards)]
    for load in loads:
        held[owner[load.slot]].append(load)
    mean = sum(total) / current.shards
    while True:
        high = max(range(current.shards), key=lambda s: (total[s], -s))
        low = min(range(current.shards), key=lambda s: (total[s], s))
        gap = total[high] - total[low]
        movable = [x for x in held[high] if 0 < x.bytes < gap]
        if total[high] <= mean * (1 + tolerance) and total[low] >= mean * (1 - tolerance) or not movable:
            break
        best = min(movable, key=lambda x: (abs(gap / 2 - x.bytes), x.slot))
        held[high].remove(best)
        held[low].append(best)
        total[high] -= best.bytes
        total[low] += best.bytes
        owner[best.slot] = low
    return SlotMap(current.version + 1, current.shards, tuple(owner), tuple(loads))


def grow(current: SlotMap) -> SlotMap:
    """Next version with one more shard: slots move only into the new one, until it has its part."""
    new, owner, total = current.shards, list(current.owner), [*current.shard_bytes(), 0]
    part = sum(total) / (new + 1)
    for load in sorted(current.loads, key=lambda x: (-x.bytes, x.slot)):
        at = owner[load.slot]
        if 0 < load.bytes <= min(part - total[new], total[at] - part + load.bytes / 2):
            owner[load.slot] = new
            total[at] -= load.bytes
            total[new] += load.bytes
    return SlotMap(current.version + 1, new + 1, tuple(owner), current.loads)


def save_map(spark: SparkSession, folder: str, slot_map: SlotMap) -> None:
    """Adds the version to the map table; a version that exists is not overwritten."""
    rows = [(slot_map.version, x.slot, slot_map.owner[x.slot], x.bytes, x.rows) for x in slot_map.loads]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("errorifexists").parquet(
        f"{folder}/map_version={slot_map.version}"
    )


def load_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{folder}/map_version={version}")


def place(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Adds the shard and the place in it. The map has one row per slot, so it is broadcast; a row's place
    is the rows of the shard's earlier slots plus its own number in the slot, so that no task ever holds
    a shard."""
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    bases = slot_map.select(
        "version", "virtual_slot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base")
    )
    number = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return (
        rows.withColumn("number", number)
        .join(F.broadcast(bases), "virtual_slot")
        .withColumn("slot", F.col("base") + F.col("number") - F.lit(1))
        .drop("base", "number")
    )


def shard(docs: DataFrame, shards: int, folder: str | None = None, slots: int = SLOTS) -> DataFrame:
    """Sizes the slots, writes version 1 of the map into `folder` and places every row by it."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "slot_map")
    rows = records(docs, slots).repartition(partitions(spark), "virtual_slot").checkpoint()
    save_map(spark, folder, first_map(slot_loads(rows, slots), shards))
    return place(rows, load_map(spark, folder, 1))


def moved(before: SlotMap, after: SlotMap) -> Iterable[int]:
    """Slots that changed their shard."""
    return [s for s, (a, b) in enumerate(zip(before.owner, after.owner, strict=True)) if a != b]
