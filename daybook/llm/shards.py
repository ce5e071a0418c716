"""Sharding: fixed virtual slots and a versioned slot-to-shard map, in
DataFrame functions.

Records are hashed into ``SLOTS`` slots. Bytes are summed by slot, and a small
map deals the slots to shards, largest first, each to the shard with the
fewest bytes, so that shard sizes are nearly equal. The map is a table with
a version; rebalancing edits it (see :func:`rebalance`) and moves only the
slots it has to, while every record keeps its slot.

A slot that holds far more than its share of bytes or of rows (a hot key or group of
copies) is split into parts, the more the larger it is, over which its records are dealt
one by one; parts are dealt to shards like slots. All slots have at most
``SLOTS`` / 2 parts more than there are slots.

Maps are kept in a folder, one version beside the other. A run with the folder of an
earlier one reads its newest map, edits it for the present sizes and number of shards,
and writes the next version.

Defined results: NULL texts hold no bytes (size 1, crc32 0); NULL ids are
hashed like any value; repeated rows are placed row by row; rows that tie in
id, crc32 and size are equal in all that decides their place; an empty table
gives no rows; a text of any length is one record. Other columns may have any
names.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.llm.common import stored
from daybook.session import staging_path
from daybook.sources.versions import current_version, publish_version, version_path

SLOTS = 4096
SHARDS = 16
#: A slot is split when it holds this many times the mean of a slot, in bytes or
#: rows ...
HOT = 8
#: ... into parts of about this many times the mean.
PART = 4

Unit = tuple[int, int]  # slot, part
MAP_ROWS = "array<struct<virtual_slot:int,part:int,shard:int,first:bigint>>"


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, turn (a number that differs
    among the records of a slot) of every row."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    crc = F.coalesce(F.crc32("text"), F.lit(0).cast("long"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"),
                       crc.alias("text_crc32")).select(
        "*", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots).cast("long")).cast("int")
        .alias("virtual_slot"), F.monotonically_increasing_id().alias("turn"))


def assign(loads: Mapping[Unit, int], shards: int) -> dict[Unit, int]:
    """Largest first, each to the shard with the fewest bytes."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for unit in sorted(loads, key=lambda u: (-loads[u], u)):
        load, s = heapq.heappop(heap)
        out[unit] = s
        heapq.heappush(heap, (load + loads[unit], s))
    return out


def rebalance(current: Mapping[Unit, int], loads: Mapping[Unit, int], shards: int) -> dict[Unit, int]:
    """An edited map: parts leave only shards that hold more than the new
    mean, or that are gone, and new ones join; all others stay."""
    mean = sum(loads.values()) / shards
    out, held = {}, dict.fromkeys(range(shards), 0)
    loose = []
    for unit in sorted(loads, key=lambda u: (-loads[u], u)):
        s = current.get(unit)
        if s is None or s >= shards or held[s] + loads[unit] > mean:
            loose.append(unit)
        else:
            out[unit] = s
            held[s] += loads[unit]
    heap = [(b, s) for s, b in held.items()]
    heapq.heapify(heap)
    for unit in loose:
        b, s = heapq.heappop(heap)
        out[unit] = s
        heapq.heappush(heap, (b + loads[unit], s))
    return out


def read_map(spark: SparkSession, folder: str) -> tuple[int, dict[Unit, int]]:
    """(version, shard of every unit) of the newest map in the folder; version 0
    and no unit if there's none. At most 1.5 * ``SLOTS`` rows."""
    newest = current_version(spark, folder)
    if newest is None:
        return 0, {}
    rows = spark.read.parquet(version_path(folder, newest)).collect()
    return newest, {(r["virtual_slot"], r["part"]): r["shard"] for r in rows}


def store_map(spark: SparkSession, folder: str, shard_of: Mapping[Unit, int],
              rows: Mapping[Unit, int]) -> DataFrame:
    """Write the next version of the map (a row for each slot's part, with the
    number of the shard's rows before it) and read it back."""
    first: dict[int, int] = {}
    table = []
    for unit in sorted(shard_of):
        s = shard_of[unit]
        table.append({"virtual_slot": unit[0], "part": unit[1], "shard": s, "first": first.get(s, 0)})
        first[s] = first.get(s, 0) + rows[unit]
    parsed = F.from_json(F.lit(json.dumps(table)), MAP_ROWS)
    frame = spark.range(1).select(F.explode(parsed).alias("m")).select("m.*")

    def write(df: DataFrame, path: str) -> int:
        df.write.parquet(path)
        return len(table)
    _, version = publish_version(frame, folder, write)
    return spark.read.parquet(version_path(folder, version))


def parts_of_slots(by_slot: Sequence[tuple[int, int, int]], slots: int) -> dict[int, int]:
    """Number of parts of the slots (slot, bytes, rows) that are to be split. As all
    loads together are ``slots`` means of bytes and as many of rows, there are no
    more than slots / 4 parts by each, rounded up for at most slots / 8 slots."""
    total_bytes = sum(b for _, b, _ in by_slot)
    total_rows = sum(n for _, _, n in by_slot)
    out = {}
    for slot, b, n in by_slot:
        load = max(b * slots / total_bytes, n * slots / total_rows)
        if load > HOT:
            out[slot] = min(-(-int(load) // PART), n)
    return out


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS,
          folder: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (the record's place in its
    shard), grown_shard, virtual_slot, part of every row. ``folder``: where the maps are;
    a new one if not given."""
    spark = docs.sparkSession
    folder = folder or staging_path(spark, "slot-maps")
    rows = stored(records(docs, slots))
    by_slot = [(r["virtual_slot"], r["bytes"], r["n"]) for r in rows.groupBy("virtual_slot").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()]  # at most ``slots`` rows
    parts = parts_of_slots(by_slot, slots)
    hot = F.from_json(F.lit(json.dumps([{"virtual_slot": s, "parts": n} for s, n in sorted(parts.items())])),
                      "array<struct<virtual_slot:int,parts:int>>")
    # at most slots / 4 rows (twice slots / HOT): a proven bound for the broadcast
    split = spark.range(1).select(F.explode(hot).alias("h")).select("h.*")
    part = F.pmod(F.xxhash64("turn"), F.col("parts").cast("long")).cast("int")
    rows = (rows.join(F.broadcast(split), "virtual_slot", "left")
            .withColumn("part", F.coalesce(part, F.lit(0))).drop("parts"))
    units = rows.groupBy("virtual_slot", "part").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    loads = {(u["virtual_slot"], u["part"]): u["bytes"] for u in units}
    counts = {(u["virtual_slot"], u["part"]): u["n"] for u in units}
    version, former = read_map(spark, folder)
    shard_of = rebalance(former, loads, shards) if version else assign(loads, shards)
    slot_map = store_map(spark, folder, shard_of, counts)
    nth = F.row_number().over(Window.partitionBy("virtual_slot", "part")
                              .orderBy("doc_id", "text_crc32", "size", "turn"))
    # at most 1.5 * slots rows: a proven bound for the broadcast
    placed = rows.withColumn("_nth", nth).join(F.broadcast(slot_map), ["virtual_slot", "part"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         (F.col("first") + F.col("_nth") - 1).alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "part")
