"""Sharding by fixed virtual slots.

Every record is hashed into one of `SLOTS` slots and stays there for good. Which shard holds a slot is said by a small
versioned map, and shards are balanced by editing that map: bytes are added up per slot, and single slots move from the
heaviest shard to the lightest until no move of one brings two shards closer. No record is hashed anew; a new version
names the slots it moved. Only the table of slots, of fixed size, comes to the driver.

The law that holds is `bytes`: two shards differ by no more than the smallest slot that could still move, so with many
records a slot by a small share of a per mille. A record larger than a whole shard's part keeps its shard to itself. A
slot is chosen by id and text, copies of the same row by their number as well, so that neither a repeated id nor a group
of copies fills a slot. Records are numbered in each shard in the order of slot, then of hash: a count per slot gives each
slot its first number, and rows are counted on inside a slot.

A null text has no bytes and the checksum of nothing; null ids are kept. Rows equal in id and text are told apart by
number only. An empty table gives an empty result (and a map over empty slots). Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfpulse.llm.common import folder_exists, materialize, new_folder, table
from shelfpulse.session import mark, numbered

SLOTS = 8192
SHARDS = 40
OVERHEAD = 16
COPIES = 10_000  # copies of a row that one step numbers


def records(documents: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, hash and virtual_slot of every row.

    Equal rows are counted before they are shuffled and numbered in two steps, so no group of them meets in one task."""
    data = F.coalesce("text", F.lit("")).cast("binary")
    own = documents.select(
        "doc_id", (F.octet_length(data) + OVERHEAD).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
        F.xxhash64(F.col("doc_id"), data).alias("own"))
    counted = own.groupBy("doc_id", "size", "text_crc32", "own").agg(F.count("*").alias("copies"))
    last = (F.col("copies") - 1).cast("long")
    parts = counted.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / COPIES))))
    parts = parts.withColumn("last", F.least(last, F.col("part") * COPIES + (COPIES - 1)))
    many = parts.where("copies > 1").repartition("own", "part")
    single = parts.where("copies = 1")
    numbered_ = many.unionByName(single).withColumn("copy", F.explode(F.sequence(F.col("part") * COPIES, F.col("last"))))
    hashed = F.when(F.col("copy") == 0, F.col("own")).otherwise(F.xxhash64("own", "copy"))
    return numbered_.select("doc_id", "size", "text_crc32", hashed.alias("hash")).withColumn(
        "virtual_slot", F.pmod("hash", F.lit(slots)).cast("int"))


def slot_sizes(rows: DataFrame) -> DataFrame:
    """Bytes and number of the records of each slot that has any."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("records"))


@dataclass(frozen=True)
class SlotMap:
    """One version of the map: the shard of each slot."""

    version: int
    shards: int
    shard_of: np.ndarray

    @staticmethod
    def first(shards: int = SHARDS, slots: int = SLOTS) -> SlotMap:
        return SlotMap(1, shards, np.arange(slots) % shards)

    def edited(self, moves: Sequence[tuple[int, int]], shards: int | None = None) -> SlotMap:
        """The next version: each (slot, shard) of `moves` carried out."""
        held = self.shard_of.copy()
        for slot, shard in moves:
            held[slot] = shard
        return SlotMap(self.version + 1, shards or self.shards, held)

    def loads(self, sizes: np.ndarray) -> np.ndarray:
        """The bytes of each shard."""
        out = np.zeros(self.shards, np.int64)
        np.add.at(out, self.shard_of, sizes)
        return out

    def rebalanced(self, sizes: np.ndarray) -> SlotMap:
        """The next version, with slots moved until no move from a heavier to the lightest shard evens them out further.

        Each move takes the slot that comes nearest to half the difference, smaller slot numbers first; every one lowers
        the sum of squared loads."""
        held, loads = self.shard_of.copy(), self.loads(sizes)
        while True:
            low = int(loads.argmin())
            for high in np.argsort(-loads, kind="stable").tolist():
                gap = int(loads[high] - loads[low])
                slots = np.flatnonzero((held == high) & (sizes > 0) & (sizes < gap))
                if gap <= 0 or len(slots):
                    break
            if gap <= 0 or not len(slots):
                moved = np.flatnonzero(held != self.shard_of)
                return self.edited([(int(slot), int(held[slot])) for slot in moved])
            slot = int(slots[np.abs(2 * sizes[slots] - gap).argmin()])
            held[slot] = low
            loads[high] -= sizes[slot]
            loads[low] += sizes[slot]

    def grown(self, sizes: np.ndarray) -> SlotMap:
        """The next version with one more shard, which alone takes slots: the largest that fit its part, from the shard
        that is heaviest at the time."""
        held, loads = self.shard_of.copy(), np.append(self.loads(sizes), 0)
        part, moves = int(sizes.sum()) // (self.shards + 1), []
        while True:
            high = int(loads[:-1].argmax())
            room = min(part - int(loads[-1]), int(loads[high] - loads[-1]) - 1)
            slots = np.flatnonzero((held == high) & (sizes > 0) & (sizes <= room))
            if not len(slots):
                return self.edited(moves, self.shards + 1)
            slot = int(slots[sizes[slots].argmax()])
            held[slot] = self.shards
            loads[high] -= sizes[slot]
            loads[-1] += sizes[slot]
            moves.append((slot, self.shards))

    def without(self, shard: int, sizes: np.ndarray) -> SlotMap:
        """The next version with `shard` emptied: each of its slots goes to the lightest of the others, large ones first."""
        loads = self.loads(sizes).astype(float)
        loads[shard] = np.inf
        moves = []
        for slot in sorted(np.flatnonzero(self.shard_of == shard).tolist(), key=lambda s: -int(sizes[s])):
            to = int(loads.argmin())
            loads[to] += sizes[slot]
            moves.append((slot, to))
        return self.edited(moves)


def sizes_of(rows: DataFrame, slots: int = SLOTS) -> np.ndarray:
    """Bytes of every slot; at most `slots` rows come to the driver."""
    out = np.zeros(slots, np.int64)
    for row in slot_sizes(rows).collect():
        out[row["virtual_slot"]] = row["bytes"]
    return out


def store_map(spark: SparkSession, path: str, slot_map: SlotMap) -> None:
    """Write a version; it counts once its marker is there. A version is never overwritten."""
    folder = f"{path}/version={slot_map.version}"
    if folder_exists(spark, f"{folder}/_whole"):
        raise ValueError(f"version {slot_map.version} is already stored in {path}")
    rows = [(slot, int(shard), slot_map.shards) for slot, shard in enumerate(slot_map.shard_of)]
    spark.createDataFrame(rows, "virtual_slot int, shard int, shards int").coalesce(1).write.mode("overwrite").parquet(f"{folder}/slots")
    mark(spark, f"{folder}/_whole")


def read_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """The stored version asked for, else the newest whole one."""
    whole = [n for n in numbered(spark, path, "version") if folder_exists(spark, f"{path}/version={n}/_whole")]
    at = whole[-1] if version is None else version
    rows = sorted(spark.read.parquet(f"{path}/version={at}/slots").collect())
    return SlotMap(at, rows[0]["shards"], np.array([row["shard"] for row in rows]))


def placed(rows: DataFrame, spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """`rows` (of `records`) with shard by the stored map and slot, the row's number in its shard, without gaps.

    The map has one row a slot, a fixed number, so it is broadcast; rows of one slot are sorted in one task."""
    held = read_map(spark, path, version)
    here = spark.createDataFrame([(slot, int(shard)) for slot, shard in enumerate(held.shard_of)], "virtual_slot int, shard int")
    counts = slot_sizes(rows).join(F.broadcast(here), "virtual_slot")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("virtual_slot", "shard", F.coalesce(F.sum("records").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("virtual_slot").orderBy("hash", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("row", F.row_number().over(inside))
    return ranked.join(F.broadcast(starts), "virtual_slot").withColumn(
        "slot", (F.col("start") + F.col("row") - 1).cast("long")).drop("start", "row", "hash")


def sharded(documents: DataFrame, path: str, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Hash, add up, store the first map in `path`, balance it by a second version and place all rows by that."""
    spark = documents.sparkSession
    rows = materialize(records(documents, slots), "slotted")
    first = SlotMap.first(shards, slots)
    store_map(spark, path, first)
    store_map(spark, path, first.rebalanced(sizes_of(rows, slots)))
    return placed(rows, spark, path)


def op12_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and place of every document by virtual slots balanced by bytes."""
    out = sharded(table(spark, sf_dir, "documents"), new_folder(spark, "slot-map"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
