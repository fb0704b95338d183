"""Sharding through fixed virtual slots.

Records hash into a fixed number of slots, bytes are summed per slot, and a versioned map says
which shard holds which slot. Only the map, one row per slot, passes the driver. Rebalancing
edits the map: it moves as few slots as level the shards and writes the next version; records
never change their slot.

Defined results: a null text has no bytes; null ids hash like a value of their own; equal
records share a slot; an empty table gives an empty result and a map that deals slots in
turn; other columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import settled, text_of, unused
from cohortloom.session import shared_folder

SLOTS = 4096
SHARDS = 40
#: Bytes that a record takes beside its text.
RECORD_BYTES = 16
MAP_SCHEMA = "slot int, shard int, bytes long"


def sized(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, v_slot) per record."""
    data = F.encode(text_of(text_col), "UTF-8")
    return (
        docs.select(F.col(id_col), (F.length(data) + RECORD_BYTES).cast("long").alias("size"),
                    F.crc32(data).alias("text_crc32"))
        .withColumn("v_slot", F.pmod(F.xxhash64(id_col, "text_crc32"), F.lit(slots)).cast("int"))
    )


def slot_bytes(records: DataFrame) -> DataFrame:
    """Bytes and records per slot; at most one row per slot."""
    return records.groupBy("v_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("records"))


def first_map(load: dict[int, int], slots: int = SLOTS, shards: int = SHARDS) -> dict[int, int]:
    """slot -> shard: slots by falling bytes, each to the shard with the fewest bytes."""
    heap = [(0, shard) for shard in range(shards)]
    held: dict[int, int] = {}
    for slot in sorted(range(slots), key=lambda s: (-load.get(s, 0), s)):
        if not load.get(slot, 0):
            held[slot] = slot % shards
            continue
        used, shard = heapq.heappop(heap)
        held[slot] = shard
        heapq.heappush(heap, (used + load[slot], shard))
    return held


def edited_map(held: dict[int, int], load: dict[int, int], shards: int) -> dict[int, int]:
    """The map after rebalancing to ``shards`` shards.

    Slots of closed shards go to the shards with the fewest bytes; then the fullest shard gives
    the emptiest the largest slot that narrows their difference, until no slot does.
    """
    held = dict(held)
    used = [0] * shards
    for slot, shard in held.items():
        if shard < shards:
            used[shard] += load.get(slot, 0)
    for slot in sorted((s for s, shard in held.items() if shard >= shards), key=lambda s: (-load.get(s, 0), s)):
        shard = min(range(shards), key=lambda x: (used[x], x))
        held[slot] = shard
        used[shard] += load.get(slot, 0)
    own: dict[int, list[int]] = {shard: [] for shard in range(shards)}
    for slot, shard in held.items():
        own[shard].append(slot)
    while True:
        full = max(range(shards), key=lambda x: (used[x], -x))
        free = min(range(shards), key=lambda x: (used[x], x))
        gap = used[full] - used[free]
        fits = [s for s in own[full] if 0 < load.get(s, 0) < gap]
        if not fits:
            return held
        # The slot nearest to half of the difference levels the two best.
        slot = min(fits, key=lambda s: (abs(gap - 2 * load[s]), s))
        own[full].remove(slot)
        own[free].append(slot)
        held[slot] = free
        used[full] -= load[slot]
        used[free] += load[slot]


def publish_map(spark: SparkSession, folder: str, version: int, held: dict[int, int], load: dict[int, int]) -> None:
    """Write one version of the map; a version that exists is never overwritten."""
    rows = [(slot, shard, load.get(slot, 0)) for slot, shard in sorted(held.items())]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("error").parquet(f"{folder}/version={version}")


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{folder}/version={version}")


def rebalance(spark: SparkSession, folder: str, version: int, load: dict[int, int], shards: int) -> DataFrame:
    """Write version + 1 of the map for the present bytes and number of shards, and read it."""
    held = {r["slot"]: r["shard"] for r in read_map(spark, folder, version).collect()}
    publish_map(spark, folder, version + 1, edited_map(held, load, shards), load)
    return read_map(spark, folder, version + 1)


def shard_records(
    docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, folder: str | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, size, text_crc32, v_slot, shard, place) per record; place is gapless within a shard.

    A record's place is the number of records in its shard's lower slots plus its rank in its
    own slot, so that records are ranked within a slot, never within a whole shard.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark)
    records = settled(sized(docs, slots, id_col, text_col))
    stats = slot_bytes(records).collect()  # one row per slot at most
    load = {r["v_slot"]: r["bytes"] for r in stats}
    count = {r["v_slot"]: r["records"] for r in stats}
    publish_map(spark, folder, 1, first_map(load, slots, shards), load)
    current = rebalance(spark, folder, 1, load, shards)
    before, placed = [0] * shards, []
    for row in sorted(current.collect(), key=lambda r: r["slot"]):
        placed.append((row["slot"], row["shard"], before[row["shard"]]))
        before[row["shard"]] += count.get(row["slot"], 0)
    where = spark.createDataFrame(placed, "v_slot int, shard int, base long")
    rank = F.row_number().over(Window.partitionBy("v_slot").orderBy(F.col(id_col).asc_nulls_last(), "text_crc32", "size"))
    return (
        records.withColumn("rank", rank).join(F.broadcast(where), "v_slot")
        .select(id_col, "size", "text_crc32", "v_slot", "shard", (F.col("base") + F.col("rank") - 1).alias("place"))
    )


def write_shards(docs: DataFrame, shard_map: DataFrame, folder: str, slots: int = SLOTS,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write whole records, one folder per shard and one or more files per group of slots."""
    slot = F.pmod(F.xxhash64(F.col(id_col), F.crc32(F.encode(text_of(text_col), "UTF-8"))), F.lit(slots)).cast("int")
    slot_col, shard_col = unused(docs, "_slot"), unused(docs, "_shard")
    held = shard_map.select(F.col("slot").alias(slot_col), F.col("shard").alias(shard_col))
    docs.withColumn(slot_col, slot).join(F.broadcast(held), slot_col).drop(slot_col).write.partitionBy(shard_col).parquet(folder)
