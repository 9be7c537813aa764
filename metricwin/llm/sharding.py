"""Shards of near equal bytes over fixed virtual slots.

Records hash into thousands of slots that never change. What decides a record's shard is a small
versioned map from slots to shards, made from the bytes aggregated in each slot; rebalancing edits
that map and writes the next version, and only the slots it moves change shard. A slot that alone
holds a large share (one key in very many rows) is split into parts by a salt that follows from the
record, its text and its number among equal records, so that a saved map finds it again.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricwin.llm.common import table

PARTS = 64
#: A slot with more than this part of a shard's even share of bytes is split.
HOT = 16
MAP_SCHEMA = "slot int, part int, parts int, bytes long, rows long, shard int, version int"


@dataclass(frozen=True)
class Entry:
    """One slot, or one of ``parts`` parts of a hot one."""

    slot: int
    part: int
    parts: int
    bytes: int
    rows: int
    shard: int = -1


@dataclass(frozen=True)
class SlotMap:
    """A version of the map. At most ``slots + HOT * shards * PARTS`` entries, whatever the data."""

    shards: int
    version: int
    entries: tuple[Entry, ...]

    def loads(self) -> list[int]:
        loads = [0] * self.shards
        for e in self.entries:
            loads[e.shard] += e.bytes
        return loads

    def save(self, spark: SparkSession, path: str) -> None:
        """Write this version beside the others; an existing version is never overwritten."""
        rows = [
            (e.slot, e.part, e.parts, e.bytes, e.rows, e.shard, self.version) for e in self.entries
        ]
        frame = spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1)
        frame.write.parquet(f"{path}/map-{self.version:06d}-of-{self.shards}")

    @staticmethod
    def load(spark: SparkSession, path: str, version: int, shards: int) -> SlotMap:
        frame = spark.read.schema(MAP_SCHEMA).parquet(f"{path}/map-{version:06d}-of-{shards}")
        rows = frame.orderBy("slot", "part").collect()
        entries = (
            Entry(r["slot"], r["part"], r["parts"], r["bytes"], r["rows"], r["shard"]) for r in rows
        )
        return SlotMap(shards, version, tuple(entries))


def first_map(entries: Iterable[Entry], shards: int) -> SlotMap:
    """Largest slots first, each to the shard with the fewest bytes; ties to the lower number.
    Empty slots are dealt round."""
    heap = [(0, s) for s in range(shards)]
    placed = []
    for e in sorted(entries, key=lambda e: (-e.bytes, e.slot, e.part)):
        if not e.bytes:
            placed.append(replace(e, shard=(e.slot + e.part) % shards))
            continue
        load, shard = heapq.heappop(heap)
        placed.append(replace(e, shard=shard))
        heapq.heappush(heap, (load + e.bytes, shard))
    return SlotMap(shards, 1, tuple(sorted(placed, key=lambda e: (e.slot, e.part))))


def rebalance(old: SlotMap, shards: int, tolerance: float = 0.02) -> SlotMap:
    """The next version: for a new number of shards, or for entries with new bytes.

    Entries move only out of shards that are gone or hold over ``1 + tolerance`` even shares, to
    the shard with the fewest bytes, and only if that shard then holds less than the one left.
    """
    even = sum(e.bytes for e in old.entries) / shards
    loads = [0] * shards
    of_shard: dict[int, list[Entry]] = {s: [] for s in range(shards)}
    homeless: list[Entry] = []
    for e in old.entries:
        if 0 <= e.shard < shards:
            loads[e.shard] += e.bytes
            of_shard[e.shard].append(e)
        else:
            homeless.append(e)
    moved: dict[tuple[int, int], int] = {}
    heap = [(load, s) for s, load in enumerate(loads)]
    heapq.heapify(heap)

    def give(e: Entry) -> None:
        load, s = heapq.heappop(heap)
        moved[e.slot, e.part] = s
        heapq.heappush(heap, (load + e.bytes, s))

    for e in sorted(homeless, key=lambda e: (-e.bytes, e.slot, e.part)):
        give(e)
    for s in range(shards):
        for e in sorted(of_shard[s], key=lambda e: (-e.bytes, e.slot, e.part)):
            if loads[s] <= even * (1 + tolerance):
                break
            load, to = heap[0]
            if to != s and e.bytes and load + e.bytes <= min(loads[s], even * (1 + tolerance)):
                give(e)
                loads[s] -= e.bytes
                # The shard's own entry in the heap is too high now; make it right.
                heap = [(x - e.bytes if k == s else x, k) for x, k in heap]
                heapq.heapify(heap)
    entries = tuple(replace(e, shard=moved.get((e.slot, e.part), e.shard)) for e in old.entries)
    return SlotMap(shards, old.version + 1, entries)


def records(docs: DataFrame, slots: int) -> DataFrame:
    """Write doc_id, size, text_crc32 and slot of every row, and the partition it was read in."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    # Rows without an id are told apart by their text.
    named = F.when(F.col("doc_id").isNull(), F.xxhash64("text_crc32", "size")).otherwise(
        F.xxhash64("doc_id")
    )
    slot = F.pmod(named, F.lit(slots)).cast("int")
    rows = rows.withColumns({"slot": slot, "read": F.spark_partition_id()})
    return table(rows, "shard-records")


def salted(rows: DataFrame, hot: list[int]) -> DataFrame:
    """``rows`` with a ``salt`` for those of hot slots, of which a map has few; 0 for the others.

    Equal records are numbered, in each partition they were read in and over the partitions by a
    prefix sum, so that one record repeated any number of times is spread as well. Which of them gets
    which number does not matter, so the salts are the same however the records are read.
    """
    if not hot:
        return rows.withColumn("salt", F.lit(0))
    same = ("doc_id", "text_crc32", "size")
    inside = rows.where(F.col("slot").isin(hot))
    counts = inside.groupBy(*same, "read").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(*same).orderBy("read").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    counts = counts.select(*[F.col(c).alias(f"of_{c}") for c in (*same, "read")], before)
    nth = F.row_number().over(Window.partitionBy(*same, "read").orderBy("slot"))
    alike = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in (*same, "read")]
    )
    numbered = inside.withColumn("nth", nth).join(counts, alike)
    salt = F.pmod(F.xxhash64(*same, F.col("before") + F.col("nth")), F.lit(PARTS)).cast("int")
    outside = rows.where(~F.col("slot").isin(hot)).withColumn("salt", F.lit(0))
    return outside.unionByName(numbered.withColumn("salt", salt).select(*outside.columns))


def weigh(rows: DataFrame, shards: int, slots: int) -> list[Entry]:
    """Bytes and rows of every slot, hot slots in parts. Both sums are bounded by the slots."""
    by_slot = rows.groupBy("slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    plain = [(r["slot"], r["bytes"], r["rows"]) for r in by_slot.collect()]
    most = sum(b for _, b, _ in plain) / (HOT * shards)
    hot = {s for s, b, n in plain if b > most and n > 1}
    entries = [Entry(s, 0, 1, b, n) for s, b, n in plain if s not in hot]
    if hot:
        parts = salted(rows, sorted(hot)).where(F.col("slot").isin(sorted(hot)))
        parts = parts.groupBy("slot", "salt").agg(
            F.sum("size").alias("bytes"), F.count("*").alias("rows")
        )
        found = {(r["slot"], r["salt"]): (r["bytes"], r["rows"]) for r in parts.collect()}
        entries += [
            Entry(s, p, PARTS, *found.get((s, p), (0, 0))) for s in sorted(hot) for p in range(PARTS)
        ]
    # Slots without records have a shard as well, for those to come.
    seen = {s for s, _, _ in plain}
    return entries + [Entry(s, 0, 1, 0, 0) for s in range(slots) if plain and s not in seen]


def place(rows: DataFrame, slot_map: SlotMap) -> DataFrame:
    """Give every record its shard and its place there, 0 upwards without gaps.

    The rows need not be those the map was made from: their own counts give the places. Places
    follow the slots, then doc_id; each slot is numbered by itself, so no task ever sorts a shard.
    """
    hot = sorted({e.slot for e in slot_map.entries if e.parts > 1})
    rows = salted(rows, hot).withColumnRenamed("salt", "part")
    if hot:
        rows = table(rows, "shard-salted")
    # A row per slot and part of a hot slot, whatever the input's size.
    counts = {(r["slot"], r["part"]): r["count"] for r in rows.groupBy("slot", "part").count().collect()}
    base, firsts = [0] * slot_map.shards, []
    for e in slot_map.entries:
        if (e.slot, e.part) in counts:
            firsts.append((e.slot, e.part, e.shard, base[e.shard]))
            base[e.shard] += counts[e.slot, e.part]
    schema = "slot int, part int, shard int, base long"
    bases = rows.sparkSession.createDataFrame(firsts, schema)
    by_id = Window.partitionBy("slot", "part").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("nth", F.row_number().over(by_id) - 1)
        .join(bases, ["slot", "part"])
        .withColumn("place", F.col("base") + F.col("nth"))
    )


def shard(
    docs: DataFrame, shards: int = 8, slots: int = 4096, map_path: str | None = None
) -> tuple[DataFrame, SlotMap]:
    """Put every row of ``doc_id, text`` into a shard so that shards have near equal bytes.

    A row's size is its text's UTF-8 bytes plus 1. Returns the rows (doc_id, size, text_crc32,
    slot, shard, place) and the map, which is also written as version 1 if ``map_path`` is given.
    Null texts count as empty; a null doc_id is hashed by its text; repeated rows are all placed;
    other columns are ignored; no rows give no rows and an empty map.
    """
    rows = records(docs, slots)
    slot_map = first_map(weigh(rows, shards, slots), shards)
    if map_path is not None:
        slot_map.save(docs.sparkSession, map_path)
    placed = place(rows, slot_map)
    return placed.select("doc_id", "size", "text_crc32", "slot", "shard", "place"), slot_map
