"""Sharding by fixed virtual slots.

Every record hashes into one of some thousand slots; bytes are summed per
slot, and a versioned table maps slots to shards. Placing, growing and
rebalancing edit that table alone: records never hash anew. The table has
``slots`` rows, plus one per part of a split slot (``SPLITS`` per shard at
most), which bounds what the driver edits and what is broadcast.

Law ``bytes``: the shards' sizes are near equal.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import materialize

SLOTS = 8192
SPLITS = 512
MAP_SCHEMA = "version int, vslot long, part long, parts long, shard int, bytes long"


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(row_id, doc_id, size, text_crc32, vslot) of each row of ``docs``, written once so that row numbers stay.

    ``size`` is the UTF-8 length plus 1 (null text: 1). The slot is a hash of
    the doc_id; null ids share one, which is split if it grows large.
    """
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    out = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
                      (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
                      F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(slots)).alias("vslot"))
    return materialize(out, "sized")


def build_map(rows: DataFrame, shards: int, version: int = 1) -> list[tuple]:
    """Place slots on shards, largest first, each on the emptiest shard (ties: lower number).

    A slot of more than 1 / SPLITS of a shard is split by row number first, so
    that one hot key cannot fill a shard; the sizes placed are those measured
    after the split. Sums are made map-side, one row per slot or part.
    """
    got = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    most = max(1, sum(r["bytes"] for r in got) // (shards * SPLITS))
    split = [(r["vslot"], min(r["n"], -(-r["bytes"] // most))) for r in got if r["bytes"] > most and r["n"] > 1]
    units = {(r["vslot"], 0): (r["bytes"], 1) for r in got}
    if split:
        parts = F.broadcast(rows.sparkSession.createDataFrame(split, "vslot long, parts long"))
        again = rows.join(parts, "vslot").groupBy("vslot", "parts", part_of("parts").alias("part"))
        for r in again.agg(F.sum("size").alias("bytes")).collect():
            units[r["vslot"], r["part"]] = (r["bytes"], r["parts"])
        for slot, parts in split:
            for p in range(parts):      # a part without rows yet has a shard too
                if units.get((slot, p), (0, 1))[1] == 1:
                    units[slot, p] = (0, parts)
    return _place([(b, slot, p, parts) for (slot, p), (b, parts) in units.items()], shards, version)


def part_of(parts: str):
    """Column: the part of its slot that a row lies in."""
    return F.pmod(F.xxhash64("row_id"), F.col(parts))


def _place(units: list[tuple], shards: int, version: int) -> list[tuple]:
    load = [(0, s) for s in range(shards)]
    out = []
    for size, slot, part, parts in sorted(units, key=lambda u: (-u[0], u[1], u[2])):
        at, s = heapq.heappop(load)
        out.append((version, slot, part, parts, s, size))
        heapq.heappush(load, (at + size, s))
    return out


def rebalance(old: list[tuple], shards: int) -> list[tuple]:
    """The next version of a map for ``shards`` shards: slots move from the fullest to the emptiest shard only while that
    lowers the fuller one's size. Where shards are added, only they receive slots; slots of dropped shards all move."""
    version = max((r[0] for r in old), default=0) + 1
    held: dict[int, list] = {s: [] for s in range(shards)}
    loose = []
    for _, slot, part, parts, s, size in old:
        (held[s] if s < shards else loose).append((size, slot, part, parts))
    load = {s: sum(u[0] for u in us) for s, us in held.items()}
    for u in sorted(loose, reverse=True):
        s = min(load, key=lambda k: (load[k], k))
        held[s].append(u)
        load[s] += u[0]
    for us in held.values():
        us.sort()
    takers = [s for s in held if not held[s]] or list(held)
    while True:
        hi, lo = max(load, key=lambda k: (load[k], -k)), min(takers, key=lambda k: (load[k], k))
        gap = load[hi] - load[lo]
        fits = [u for u in held[hi] if 0 < u[0] < gap]
        if not fits:
            break
        u = min(fits, key=lambda u: (abs(u[0] - gap / 2), u))
        if abs(gap - 2 * u[0]) >= gap:
            break
        held[hi].remove(u)
        held[lo].append(u)
        load[hi] -= u[0]
        load[lo] += u[0]
    return [(version, slot, part, parts, s, size) for s, us in held.items() for size, slot, part, parts in sorted(us, key=lambda u: u[1:])]


def map_path(spark: SparkSession) -> str:
    """A new path for a map table in the shared folder."""
    return scratch_path(spark, "slot-map")


def save_map(spark: SparkSession, slot_map: list[tuple], path: str) -> None:
    """Add a version to the map table; earlier versions stay."""
    spark.createDataFrame(slot_map, MAP_SCHEMA).coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the map table, by default the latest."""
    every = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = every.agg(F.max("version")).first()[0]
    return every.where(F.col("version") == F.lit(version))


def assign(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``sized`` rows with ``shard`` and ``slot``, the row's place in its shard, gapless from 0.

    Places are numbered within a part of a slot and offset by the parts
    before it in the shard, so no task sees a whole shard. An empty table
    gives no rows.
    """
    bounded = F.broadcast(slot_map.select("vslot", "part", "parts", "shard"))
    split = F.broadcast(slot_map.where("part = 0").select("vslot", "parts"))
    r = rows.join(split, "vslot").withColumn("part", part_of("parts")).drop("parts")
    r = r.join(bounded.drop("parts"), ["vslot", "part"])
    first = Window.partitionBy("shard").orderBy("vslot", "part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slot part: the window over a shard's parts is bounded like the map.
    offs = r.groupBy("shard", "vslot", "part").agg(F.count(F.lit(1)).alias("n"))
    offs = offs.select("vslot", "part", F.coalesce(F.sum("n").over(first), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("vslot", "part").orderBy("doc_id", "row_id"))
    return (r.withColumn("place", place).join(F.broadcast(offs), ["vslot", "part"])
             .withColumn("slot", F.col("before") + F.col("place") - 1).drop("before", "place"))
