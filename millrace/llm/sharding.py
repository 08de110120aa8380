"""Sharding by fixed virtual slots.

A record's hash names one of a few thousand slots for good; which shard holds a slot is
a small, versioned map.  The map is made from the bytes of each slot and edited, slot by
slot, when shards are added or loads drift, so a rebalancing moves slots and never rehashes.
Rows are read once; everything after works on narrow rows or on one row per slot.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.shared import literal_array, written

SLOTS = 4096


@dataclass(frozen=True)
class SlotMap:
    """Shard of every slot; ``version`` counts the edits."""

    shard_of: tuple[int, ...]
    shards: int
    version: int = 1

    def column(self, slot: Column) -> Column:
        return F.element_at(literal_array(self.shard_of, "int"), (slot + 1).cast("int"))


def slot_of(id_col: Column, text: Column, slots: int = SLOTS) -> Column:
    """Slot of a record by its id; a record without an id goes by its text."""
    return F.pmod(F.when(id_col.isNull(), F.xxhash64(text)).otherwise(F.xxhash64(id_col)), F.lit(slots))


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text and one for its end; a null text has only that."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def slot_loads(slotted: DataFrame) -> list[tuple[int, int]]:
    """Bytes and rows of every slot: one row a slot, so its size is fixed by the number of slots."""
    found = slotted.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    return [(r.virtual_slot, r.bytes, r.rows) for r in found.collect()]


def balanced(loads: list[tuple[int, int, int]], shards: int, slots: int = SLOTS) -> SlotMap:
    """First map: slots by falling bytes, each to the shard that is lightest so far."""
    size = {slot: n for slot, n, _ in loads}
    heap = [(0, 0, shard) for shard in range(shards)]
    shard_of = [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-size.get(s, 0), s)):
        held, count, shard = heapq.heappop(heap)
        shard_of[slot] = shard
        heapq.heappush(heap, (held + size.get(slot, 0), count + 1, shard))
    return SlotMap(tuple(shard_of), shards)


def rebalanced(old: SlotMap, loads: list[tuple[int, int, int]], shards: int, slack: float = 0.02) -> SlotMap:
    """The next version for ``shards`` shards: slots leave the heaviest shard for the lightest one
    until no shard is more than ``slack`` over the mean, or no move helps.

    Slots of removed shards move first; all other slots stay where they are.
    """
    size = {slot: n for slot, n, _ in loads}
    shard_of = list(old.shard_of)
    held = [0] * shards
    own: list[list[int]] = [[] for _ in range(shards)]
    orphans = []
    for slot, shard in enumerate(shard_of):
        if shard < shards:
            held[shard] += size.get(slot, 0)
            own[shard].append(slot)
        else:
            orphans.append(slot)

    def move(slot: int, to: int) -> None:
        shard_of[slot] = to
        held[to] += size.get(slot, 0)
        own[to].append(slot)

    for slot in sorted(orphans, key=lambda s: -size.get(s, 0)):
        move(slot, min(range(shards), key=lambda s: (held[s], s)))
    limit = sum(held) / shards * (1 + slack)
    for _ in range(len(shard_of)):
        heavy, light = max(range(shards), key=lambda s: held[s]), min(range(shards), key=lambda s: (held[s], s))
        gap = held[heavy] - held[light]
        movable = [s for s in own[heavy] if 0 < size.get(s, 0) < gap]
        if held[heavy] <= limit or not movable:
            break
        slot = min(movable, key=lambda s: (abs(gap / 2 - size[s]), s))
        own[heavy].remove(slot)
        held[heavy] -= size[slot]
        move(slot, light)
    return SlotMap(tuple(shard_of), shards, old.version + 1)


def store(spark: SparkSession, slot_map: SlotMap, path: str) -> None:
    """Append one version to the map table ``(slot, shard, shards, version)`` at ``path``."""
    rows = spark.range(len(slot_map.shard_of)).select(
        F.col("id").alias("slot"), slot_map.column(F.col("id")).alias("shard"), F.lit(slot_map.shards).alias("shards"))
    rows.write.mode("append").parquet(f"{path.rstrip('/')}/version={slot_map.version}")


def load(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """A version of the map, the newest by default."""
    rows = spark.read.parquet(path)
    if version is None:
        version = rows.agg(F.max("version")).first()[0]
    found = rows.where(F.col("version") == version).orderBy("slot").collect()
    return SlotMap(tuple(r.shard for r in found), found[0].shards, version)


def stored_growth(
    docs: DataFrame, shards: int, grown: int, path: str, id_col: str = "doc_id", text_col: str = "text",
) -> tuple[SlotMap, SlotMap]:
    """First map for ``shards`` shards and its rebalancing to ``grown``, from the same slot loads.

    Both are stored as versions of the table at ``path``; the second edits the first as read from there, and both
    are returned as read back.
    """
    loads = slot_loads(slotted(docs, id_col, text_col))
    store(docs.sparkSession, balanced(loads, shards), path)
    first = load(docs.sparkSession, path, 1)
    store(docs.sparkSession, rebalanced(first, loads, grown), path)
    return first, load(docs.sparkSession, path)


def slotted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """``(id_col, size, text_crc32, virtual_slot)`` of every row; a null text counts as empty."""
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return docs.select(
        ident.alias(id_col), text_size(text).alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        slot_of(ident, text, slots).alias("virtual_slot"))


def place(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", *, slots: int = SLOTS,
    slot_map: SlotMap | None = None,
) -> DataFrame:
    """Every row with its ``virtual_slot``, ``shard``, ``map_version`` and ``position`` in the shard, gapless from 0.

    Without ``slot_map`` a new one is made, so that the shards' bytes are near equal.  Rows of a shard are in the
    order of slot, then id; a slot's rows are numbered on their own and moved by the rows of the slots
    before it, so no task holds a shard.  Rows that repeat an id share its slot.  An empty table gives an empty one.
    """
    narrow = written(slotted(docs, id_col, text_col, slots), "slotted")
    loads = slot_loads(narrow)
    if slot_map is None:
        slot_map = balanced(loads, shards, slots)
    rows_of = {slot: rows for slot, _, rows in loads}
    before, offsets = [0] * slot_map.shards, []
    for slot, shard in enumerate(slot_map.shard_of):
        offsets.append(before[shard])
        before[shard] += rows_of.get(slot, 0)
    within = Window.partitionBy("virtual_slot").orderBy(id_col, "text_crc32", "size")
    slot = F.col("virtual_slot")
    return narrow.select(
        "*", slot_map.column(slot).alias("shard"), F.lit(slot_map.version).alias("map_version"),
        (F.element_at(literal_array(offsets, "bigint"), (slot + 1).cast("int")) + F.row_number().over(within) - 1).alias("position"))


def with_shard(docs: DataFrame, slot_map: SlotMap, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``shard``; a narrow step."""
    slot = slot_of(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), len(slot_map.shard_of))
    return docs.withColumn("shard", slot_map.column(slot))
