"""Sharding by fixed virtual slots: records hash into thousands of slots, slots are mapped to shards by their bytes.

The slot of a record never changes; only the slot-to-shard map does, and every edit makes a new version. The map has
one row per slot (``N_SLOTS``, a constant), so planning it on the driver is bounded. A null text counts as empty, a
null doc_id is a value like any other, repeated rows get places of their own, an empty table gives no rows.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

N_SLOTS = 4096
#: Fixed value: bytes that every record has besides its text.
RECORD_BYTES = 16


def with_slots(records: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and the virtual slot of every record."""
    text = F.coalesce("text", F.lit(""))
    return records.select(
        "doc_id",
        (F.octet_length(text) + F.lit(RECORD_BYTES)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id", text), F.lit(n_slots)).cast("int").alias("vslot"),
    )


def slot_sizes(slotted: DataFrame) -> dict[int, tuple[int, int]]:
    """vslot -> (bytes, rows): at most one entry per slot."""
    sums = slotted.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    return {r["vslot"]: (r["bytes"], r["n"]) for r in sums.collect()}


def plan(sizes: dict[int, tuple[int, int]], shards: int, n_slots: int = N_SLOTS) -> list[int]:
    """Shard of each slot: the largest slot first, always to the shard with the fewest bytes."""
    loads = [(0, shard) for shard in range(shards)]
    owner = [0] * n_slots
    for slot in sorted(range(n_slots), key=lambda s: (-sizes.get(s, (0, 0))[0], s)):
        load, shard = heapq.heappop(loads)
        owner[slot] = shard
        heapq.heappush(loads, (load + sizes.get(slot, (0, 0))[0], shard))
    return owner


def rebalance(owner: list[int], sizes: dict[int, tuple[int, int]], shards: int) -> list[int]:
    """Edit a map for new sizes or more shards: slots go to the emptiest shard from the fullest that has one small enough."""
    edited, load = list(owner), [0] * shards
    slots: list[list[int]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(edited):
        load[shard] += sizes.get(slot, (0, 0))[0]
        slots[shard].append(slot)
    while True:
        low = min(range(shards), key=lambda s: (load[s], s))
        for full in sorted(range(shards), key=lambda s: (-load[s], s)):
            gap = load[full] - load[low]
            fitting = [s for s in slots[full] if 0 < sizes.get(s, (0, 0))[0] < gap]
            if fitting:
                break
        else:
            return edited
        # the slot nearest to half the gap; every move lowers the sum of squared loads, so this ends
        moved = min(fitting, key=lambda s: (abs(2 * sizes[s][0] - gap), s))
        edited[moved] = low
        slots[full].remove(moved)
        slots[low].append(moved)
        load[full] -= sizes[moved][0]
        load[low] += sizes[moved][0]


def map_table(spark: SparkSession, version: int, owner: list[int], sizes: dict[int, tuple[int, int]]) -> DataFrame:
    """The map as a table: version, vslot, shard, bytes, n, and the place where the slot starts within its shard."""
    first, filled = [], {}
    for slot, shard in enumerate(owner):
        first.append(filled.get(shard, 0))
        filled[shard] = first[-1] + sizes.get(slot, (0, 0))[1]
    pick = lambda values: F.split(F.lit(",".join(map(str, values))), ",")[F.col("id").cast("int")].cast("long")
    every = range(len(owner))
    return spark.range(len(owner)).select(
        F.lit(version).alias("version"),
        F.col("id").cast("int").alias("vslot"),
        pick(owner).cast("int").alias("shard"),
        pick(sizes.get(s, (0, 0))[0] for s in every).alias("bytes"),
        pick(sizes.get(s, (0, 0))[1] for s in every).alias("n"),
        pick(first).alias("first_place"),
    )


def assign(slotted: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Add shard and slot, the gapless place within the shard.

    Rows are numbered within their virtual slot and shifted by the rows of the shard's earlier slots, so no task
    sorts a whole shard.
    """
    place = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size"))
    owners = F.broadcast(slot_map.select("vslot", "shard", "first_place"))
    numbered = slotted.withColumn("_place", place).join(owners, "vslot")
    return numbered.withColumn("slot", F.col("first_place") + F.col("_place") - 1).drop("_place", "first_place")
