"""Fixed virtual slots: records hash into slots, a versioned table maps slots to shards.

The map is a small table (``N_SLOTS`` rows a version, whatever the data) in the shared folder.
Rebalancing reads the bytes per slot and writes the next version with the slots that move; records
are looked up by slot, so a rebalance never rewrites what stays.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from readloom.llm.common import Scratch

N_SLOTS = 4096


def virtual_slot(doc_id: Column, n_slots: int = N_SLOTS) -> Column:
    """Null ids share the slot of the hash seed."""
    return F.pmod(F.xxhash64(doc_id), F.lit(n_slots)).cast("int")


def sized(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """The narrow columns a shard plan needs; texts are read once and not shuffled."""
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        virtual_slot(F.col("doc_id"), n_slots).alias("vslot"),
    )


def slot_bytes(records: DataFrame) -> DataFrame:
    return records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))


def first_map(n_shards: int, n_slots: int = N_SLOTS) -> dict[int, int]:
    """Version 0: slots dealt out in turn, before any size is known."""
    return {slot: slot % n_shards for slot in range(n_slots)}


def edited_map(old: dict[int, int], load: dict[int, int], n_shards: int) -> dict[int, int]:
    """The next version: shards above the mean give slots away, then all are levelled.

    Over-full shards hand out their smallest slots until they are at the mean or below; what was handed
    out goes, largest first, to the emptiest shard each time. Slots of a shard that does not exist any
    more are handed out as well. Swaps between the fullest and the emptiest shard end the work when no
    swap brings them closer. Ties go by shard number, then slot number, so any run gives the same map.
    """
    shards: dict[int, set[int]] = {k: set() for k in range(n_shards)}
    free = []
    for slot, shard in sorted(old.items()):
        if shard in shards:
            shards[shard].add(slot)
        else:
            free.append(slot)
    total = {k: sum(load.get(s, 0) for s in own) for k, own in shards.items()}
    mean = sum(load.values()) / n_shards
    for k, own in shards.items():
        for slot in sorted(own, key=lambda s: (load.get(s, 0), s)):
            if total[k] <= mean:
                break
            if load.get(slot, 0):
                own.discard(slot)
                total[k] -= load[slot]
                free.append(slot)
    heap = [(total[k], k) for k in shards]
    heapq.heapify(heap)
    for slot in sorted(free, key=lambda s: (-load.get(s, 0), s)):
        bytes_, k = heapq.heappop(heap)
        shards[k].add(slot)
        total[k] = bytes_ + load.get(slot, 0)
        heapq.heappush(heap, (total[k], k))
    for _ in range(64 * n_shards):
        low = min(shards, key=lambda k: (total[k], k))
        high = max(shards, key=lambda k: (total[k], -k))
        move = _best_swap(shards[high], shards[low], load, total[high] - total[low])
        if move is None:
            break
        out, back = move
        shards[high] -= {out}
        shards[low] |= {out}
        if back is not None:
            shards[low] -= {back}
            shards[high] |= {back}
        moved = load.get(out, 0) - (load.get(back, 0) if back is not None else 0)
        total[high] -= moved
        total[low] += moved
    return {slot: k for k, own in shards.items() for slot in own}


def _best_swap(high: set[int], low: set[int], load: dict[int, int], gap: int):
    """The slot to move, and the one to take back, that leave the smallest gap; None if none helps."""
    target, best = gap / 2, None
    back = [(0, None), *sorted((load.get(s, 0), s) for s in low if load.get(s, 0))]
    sizes = [b for b, _ in back]
    j = 0
    for size, slot in sorted((load.get(s, 0), s) for s in high if load.get(s, 0)):
        while j + 1 < len(sizes) and size - sizes[j + 1] >= target:
            j += 1
        for k in (j, j + 1):
            if k < len(sizes) and 0 < size - sizes[k] < gap:
                miss = abs(size - sizes[k] - target)
                if best is None or miss < best[0]:
                    best = (miss, slot, back[k][1])
    return best and best[1:]


def stored_map(spark: SparkSession, versions: list[dict[int, int]], scratch: Scratch) -> DataFrame:
    """All versions of the map as a table: version, vslot, shard."""
    rows = [(v, s, k) for v, m in enumerate(versions) for s, k in sorted(m.items())]
    return scratch.write(spark.createDataFrame(rows, "version int, vslot int, shard int").coalesce(1))


def shard_plan(docs: DataFrame, n_shards: int = 8, n_slots: int = N_SLOTS) -> DataFrame:
    """One row per record: its size, its shard under the law ``bytes`` and its place in the shard.

    Null text is empty. Repeated rows are records of their own; rows with one doc_id stay together.
    Places run from 0 without a gap per shard: by virtual slot, inside it by doc_id, size and checksum.
    An empty table gives an empty plan. The driver sees at most ``n_slots`` sums.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "sharding")
    records = scratch.write(sized(docs, n_slots))
    stats = {r["vslot"]: r for r in slot_bytes(records).collect()}
    load = {s: r["bytes"] for s, r in stats.items()}
    versions = [first_map(n_shards, n_slots)]
    versions.append(edited_map(versions[0], load, n_shards))
    current = stored_map(spark, versions, scratch).where(F.col("version") == len(versions) - 1)
    counts = spark.createDataFrame(
        [(s, r["n"]) for s, r in stats.items()], "vslot int, n long")
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    base = current.join(F.broadcast(counts), "vslot").withColumn(
        "base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = Window.partitionBy("vslot").orderBy("doc_id", "size", "text_crc32")
    return (
        records.withColumn("place", F.row_number().over(inside) - 1)
        .join(F.broadcast(base.select("vslot", "shard", "base")), "vslot")
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("base") + F.col("place")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            F.col("vslot").alias("virtual_slot"),
        )
    )
