"""Sharding by fixed virtual slots.

Records are hashed into thousands of slots, a number that never changes.  A
versioned map assigns slots to shards.  Version 1 deals slots evenly; a
rebalance reads the bytes of each slot and edits the map, moving whole slots
from the heaviest shard to the lightest until no move brings them nearer.
Records never move but with their slot.  The map and the bytes have one row a
slot, so their size is fixed by ``n_slots`` and not by the data.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import delete_files, materialize, shared_dir, small_batches, without
from .prefix import running_sums

N_SLOTS = 8192
MAP_SCHEMA = T.StructType([T.StructField("version", T.IntegerType()),
                           T.StructField("vslot", T.IntegerType()),
                           T.StructField("shard", T.IntegerType())])


def with_vslot(df: DataFrame, *keys: str, n_slots: int = N_SLOTS) -> DataFrame:
    """Append the virtual slot of each record (0 to n_slots - 1).

    Null keys are skipped by the hash, so records whose keys are all null
    share a slot; equal keys always do.  A column named vslot is replaced.
    """
    base = without(df, ["vslot"])
    return base.withColumn("vslot", F.pmod(F.xxhash64(*keys), F.lit(n_slots)).cast("int"))


def slot_bytes(df: DataFrame, size_col: str) -> DataFrame:
    """(vslot, bytes, records): one row for each slot in use; at most n_slots rows."""
    return df.groupBy("vslot").agg(F.sum(size_col).alias("bytes"), F.count("*").alias("records"))


def initial_map(n_slots: int, n_shards: int) -> list[int]:
    """Version 1: slot s in shard s mod n_shards."""
    return [s % n_shards for s in range(n_slots)]


def rebalance(shard_of: list[int], weight: dict[int, int], n_shards: int) -> list[int]:
    """An edited map whose shards are nearly equal in ``weight`` (bytes by slot).

    Each edit moves the heaviest shard's slot that best halves its distance
    to the lightest one.  Ends when no slot of the heaviest shard is lighter
    than that distance.  Also grows the map: new shards start empty.  Ties go
    to the lower shard and slot.
    """
    out = list(shard_of)
    load = [0] * n_shards
    own: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    for slot, shard in enumerate(out):
        if w := weight.get(slot, 0):
            load[shard] += w
            bisect.insort(own[shard], (w, slot))
    while True:
        heavy = max(range(n_shards), key=lambda s: (load[s], -s))
        light = min(range(n_shards), key=lambda s: (load[s], s))
        gap = load[heavy] - load[light]
        at = bisect.bisect_left(own[heavy], (gap / 2, -1))
        near = [own[heavy][i] for i in (at - 1, at) if 0 <= i < len(own[heavy])]
        moves = [x for x in near if x[0] < gap]
        if not moves:
            return out
        w, slot = min(moves, key=lambda x: (abs(gap - 2 * x[0]), x[1]))
        own[heavy].remove((w, slot))
        bisect.insort(own[light], (w, slot))
        load[heavy] -= w
        load[light] += w
        out[slot] = light


def write_map(spark: SparkSession, path: str, version: int, shard_of: list[int]) -> None:
    """Append one version of the map to the stored map at ``path``."""
    rows = [(version, s, shard) for s, shard in enumerate(shard_of)]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(vslot, shard) of one version of the stored map, the latest by default."""
    stored = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == version).select("vslot", "shard")


def assign(df: DataFrame, shard_map: DataFrame, *order: str) -> DataFrame:
    """Append shard, and slot: the record's place in its shard, gapless from 0.

    The records are numbered in one order of (virtual slot, ``order``) by
    running sums over sorted ranges, so neither a shard nor a slot that one
    repeated record fills is a task.  Where each virtual slot begins in that
    order and in its shard is known from n_slots rows.
    """
    base = without(df, ["shard", "slot"])
    small_batches(df.sparkSession)
    ones = base.withColumns({"_one": F.lit(1), "_copy": F.monotonically_increasing_id()})
    rows = running_sums(ones, ["vslot", *order, "_copy"], {"_place": "_one"}, "shards-rows")
    of_slot = rows.groupBy("vslot").agg(F.min("_place").alias("_first"), F.count("*").alias("_n")).join(shard_map, "vslot")
    before = W.partitionBy("shard").orderBy("vslot").rowsBetween(W.unboundedPreceding, -1)
    begins = of_slot.select("vslot", "shard", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_begin"))
    return (rows.join(F.broadcast(begins), "vslot")  # n_slots rows at most
            .withColumn("slot", (F.col("_begin") + F.col("_place")).cast("long"))
            .drop("_begin", "_place", "_one", "_copy"))


def shard_by_bytes(df: DataFrame, keys: list[str], size_col: str, n_shards: int,
                   n_slots: int = N_SLOTS, map_path: str | None = None) -> tuple[DataFrame, str]:
    """``df`` with vslot, shard and slot, sizes of the shards near equal, and the stored map's path.

    Writes version 1 (dealt evenly) and version 2 (rebalanced by bytes) of
    the map.  Null sizes weigh nothing; an empty table gives no rows and a
    version 2 equal to version 1.  No record is split, so one slot that
    outweighs a shard's share stays above it.
    """
    spark = df.sparkSession
    rows = materialize(with_vslot(df, *keys, n_slots=n_slots), "shards-rows")
    weight = {r["vslot"]: int(r["bytes"] or 0) for r in slot_bytes(rows, size_col).collect()}
    path = map_path or shared_dir(spark, "slot-map")
    first = initial_map(n_slots, n_shards)
    write_map(spark, path, 1, first)
    write_map(spark, path, 2, rebalance(first, weight, n_shards))
    out = assign(rows, read_map(spark, path, 2), *keys, size_col)
    delete_files(rows)  # numbered rows have been written
    return out, path
