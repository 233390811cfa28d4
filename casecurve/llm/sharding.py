"""Sharding by fixed virtual slots and a versioned map from slots to shards.

A record's slot is a hash of its id and never changes. Bytes are aggregated per slot; the map of a few
thousand slots is the only thing that rebalancing edits, and each edit is a new version. Texts are read
for their size and checksum alone and are not shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casecurve.llm.common import keyed, saved_table

N_SLOTS = 4096


@dataclass(frozen=True)
class SlotMap:
    """Version ``version`` of the map: ``shard[slot]`` for every slot, ``moved`` slots since the last version."""

    version: int
    n_shards: int
    shard: tuple[int, ...]
    moved: int = 0


def first_map(n_shards: int, n_slots: int = N_SLOTS) -> SlotMap:
    """Version 1: slots dealt out in turn, knowing nothing of their sizes."""
    return SlotMap(1, n_shards, tuple(slot % n_shards for slot in range(n_slots)))


def rebalanced(current: SlotMap, load: dict[int, int], n_shards: int | None = None) -> SlotMap:
    """The next version: slots moved from the fullest to the emptiest shard until no move evens them out.

    Each step moves the slot nearest half the gap between the two, so few slots move and each move
    lessens the gap. ``n_shards`` above the current number adds empty shards first.
    """
    n_shards = n_shards or current.n_shards
    if n_shards < current.n_shards:
        raise ValueError("shards can be added, not taken away")
    owner = list(current.shard)
    slots: list[list[int]] = [[] for _ in range(n_shards)]
    for slot, shard in enumerate(owner):
        slots[shard].append(slot)
    total = [sum(load.get(slot, 0) for slot in own) for own in slots]
    while True:
        full, empty = max(range(n_shards), key=lambda s: (total[s], -s)), min(range(n_shards), key=lambda s: (total[s], s))
        gap = total[full] - total[empty]
        fitting = [slot for slot in slots[full] if 0 < load.get(slot, 0) < gap]
        if not fitting:
            break
        slot = min(fitting, key=lambda s: (abs(2 * load[s] - gap), s))
        slots[full].remove(slot)
        slots[empty].append(slot)
        owner[slot] = empty
        total[full] -= load[slot]
        total[empty] += load[slot]
    moved = sum(a != b for a, b in zip(owner, current.shard, strict=True))
    return replace(current, version=current.version + 1, n_shards=n_shards, shard=tuple(owner), moved=moved)


def store_map(spark: SparkSession, slot_map: SlotMap, path: str) -> None:
    """Appends one version: ``version, n_shards, slot, shard``."""
    rows = [(slot_map.version, slot_map.n_shards, slot, shard) for slot, shard in enumerate(slot_map.shard)]
    spark.createDataFrame(rows, "version int, n_shards int, slot int, shard int").coalesce(1).write.mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """A stored version, the newest by default."""
    stored = spark.read.parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    rows = stored.filter(F.col("version") == version).orderBy("slot").collect()
    if not rows:
        raise ValueError(f"no version {version} in {path}")
    return SlotMap(version, rows[0].n_shards, tuple(r.shard for r in rows))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """``id, size, text_crc32, virtual_slot`` of every record, saved: one narrow row per document."""
    rows = keyed(docs, id_col, text_col)
    # Records without an id are spread by their text, or they would all be in one slot.
    key = F.xxhash64("id", F.when(F.col("id").isNull(), F.col("text")))
    return saved_table(
        rows.select(
            "id",
            (F.octet_length("text") + 1).cast("long").alias("size"),
            F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
            F.pmod(key, F.lit(n_slots)).cast("int").alias("virtual_slot"),
        ),
        "records",
    )


def slot_sizes(records: DataFrame) -> dict[int, tuple[int, int]]:
    """Slot to (bytes, rows): as many entries as there are slots, whatever the number of records."""
    sums = records.groupBy("virtual_slot").agg(F.sum("size"), F.count(F.lit(1)))
    return {slot: (size, rows) for slot, size, rows in sums.collect()}


def shard_documents(
    docs: DataFrame,
    n_shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    slot_map: SlotMap | None = None,
    n_slots: int = N_SLOTS,
    map_path: str | None = None,
) -> DataFrame:
    """``id_col, size, text_crc32, virtual_slot, map_version, shard, slot``: where every record goes.

    ``size`` is the text's UTF-8 bytes plus 1 and ``slot`` the record's place in its shard, without
    gaps: by virtual slot, then id, then checksum. Without ``slot_map`` the first map is made and edited
    once so that the shards' bytes are near equal; with ``map_path`` both versions are stored there and
    records are placed by the map read back. A path that holds such versions of another map is an error.

    A null text counts as empty; records without an id are placed by their text; records of one id
    share a slot, equal ones take places beside each other. Of a text, however long, only size and checksum
    are kept. An empty table gives no rows.
    """
    spark = docs.sparkSession
    records = measured(docs, id_col, text_col, len(slot_map.shard) if slot_map else n_slots)
    sizes = slot_sizes(records)
    if slot_map is None:
        first = first_map(n_shards, n_slots)
        slot_map = rebalanced(first, {slot: size for slot, (size, _) in sizes.items()})
        if map_path:
            store_map(spark, first, map_path)
            store_map(spark, slot_map, map_path)
            stored = load_map(spark, map_path, slot_map.version)
            if stored.shard != slot_map.shard:
                raise ValueError(f"{map_path} holds another map of version {slot_map.version}")
            slot_map = stored
    filled, placed = [0] * slot_map.n_shards, []
    for slot, shard in enumerate(slot_map.shard):
        placed.append((slot, shard, filled[shard]))
        filled[shard] += sizes.get(slot, (0, 0))[1]
    # One row per slot: of fixed size, so it may be broadcast.
    places = F.broadcast(spark.createDataFrame(placed, "virtual_slot int, shard int, before long"))
    within = Window.partitionBy("virtual_slot").orderBy("id", "text_crc32", "size")
    return (
        records.join(places, "virtual_slot")
        .withColumn("slot", F.col("before") + F.row_number().over(within) - 1)
        .select(
            F.col("id").alias(id_col),
            "size",
            "text_crc32",
            "virtual_slot",
            F.lit(slot_map.version).alias("map_version"),
            "shard",
            "slot",
        )
    )


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", n_shards: int = 8) -> SlotMap:
    """Writes the records under ``path/shard=N``, large slots kept apart in files of their own; returns the map."""
    rows = keyed(docs, id_col, text_col)
    sizes = slot_sizes(measured(docs, id_col, text_col))
    slot_map = rebalanced(first_map(n_shards), {slot: size for slot, (size, _) in sizes.items()})
    key = F.xxhash64("id", F.when(F.col("id").isNull(), F.col("text")))
    places = docs.sparkSession.createDataFrame(list(enumerate(slot_map.shard)), "virtual_slot int, shard int")
    placed = rows.withColumn("virtual_slot", F.pmod(key, F.lit(N_SLOTS)).cast("int")).join(F.broadcast(places), "virtual_slot")
    placed.repartition("virtual_slot").write.partitionBy("shard").parquet(path)
    return slot_map
