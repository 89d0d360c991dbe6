"""Operator 13: sharding by fixed virtual slots and a versioned slot map.

A record is hashed, by its id and text, into one of ``SLOTS`` virtual slots.
The slots never change; only the map from slots to shards does.  One aggregate
gives bytes and rows of each slot.  The first version of the map deals slots
in turn; rebalancing edits a version: shards above the mean give up slots,
those are dealt to the lightest shards, largest first, and moves and swaps
between the heaviest and the lightest shard even out the rest.  Each version
is stored beside the earlier ones and never overwritten.  With one more shard
the edit moves slots into the new shard only (:func:`grow`).

The law is ``bytes``: shards are nearly equal in bytes (a text's UTF-8 bytes
and one more), by about the size of the smallest records.

Hot slots: a slot that holds more than a 64th of a shard's share (copies of
one record, a very popular id) is split into more virtual slots by row number,
so that it can lie in several shards and no task has to rank it alone.  What
reaches the driver is one row for each slot, at most ``SLOTS`` and 128 for
each shard.  A row's place in its shard is the first place of its slot, from
the slot table, and its rank in the slot.

Defined results: a null text has no bytes (size 1) and the checksum of none; a
null id is hashed as such; repeated rows are records of their own and each has
its place; ties are broken by the row's number in the written light rows; an
empty table gives no rows and stores an empty map; other columns, whatever
their names, are not touched.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import col, text_or_empty, written
from tidemark.session import scratch_path

#: Virtual slots, and into how many parts at least a shard's share is cut.
SLOTS, PARTS = 16_384, 64
#: Moves and swaps that evening out tries at most; what stays is reported, not wrong.
STEPS = 5_000


def slot_of(id_col: str, text_col: str, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(col(id_col), text_or_empty(text_col)), F.lit(slots)).cast("long")


def _sub(number: Column, pieces: Column, slots: int) -> Column:
    """Virtual slots of a split slot: ``slot``, ``slot + slots``, ..."""
    return F.pmod(F.xxhash64(number), pieces) * F.lit(slots)


# --- the map -----------------------------------------------------------------

def edit(shard_of: dict[int, int], weight: dict[int, int], shards: int, into: set[int] | None = None) -> dict[int, int]:
    """A new version of ``shard_of`` for the slots of ``weight``: near equal
    sums, few moves.  Slots without a shard, or with one that is gone, are
    dealt anew; ``into`` names the shards that may receive slots (default
    all)."""
    takers = sorted(range(shards) if into is None else into)
    own: dict[int, set[int]] = {s: set() for s in range(shards)}
    load = [0] * shards
    loose = []
    for slot in weight:
        shard = shard_of.get(slot, -1)
        if 0 <= shard < shards:
            own[shard].add(slot)
            load[shard] += weight[slot]
        else:
            loose.append(slot)
    mean = sum(weight.values()) / shards
    for shard in range(shards):
        for slot in sorted(own[shard], key=lambda x: (-weight[x], x)):
            if load[shard] - weight[slot] >= mean:
                own[shard].remove(slot)
                load[shard] -= weight[slot]
                loose.append(slot)
    heap = [(load[s], s) for s in takers]
    heapq.heapify(heap)
    for slot in sorted(loose, key=lambda x: (-weight[x], x)):
        _, shard = heapq.heappop(heap)
        own[shard].add(slot)
        load[shard] += weight[slot]
        heapq.heappush(heap, (load[shard], shard))
    if into is None:
        _even(own, load, weight)
    return {slot: shard for shard, slots in own.items() for slot in slots}


def _even(own: dict[int, set[int]], load: list[int], weight: dict[int, int]) -> None:
    """Move a slot, or swap two, between the heaviest and the lightest shard,
    as long as that brings them nearer to each other."""
    for _ in range(STEPS):
        high = max(range(len(load)), key=load.__getitem__)
        low = min(range(len(load)), key=load.__getitem__)
        gap = load[high] - load[low]
        if gap <= 1:
            return
        give = np.array(sorted(own[high], key=lambda x: (weight[x], x)), np.int64)
        take = np.array([-1, *sorted(own[low], key=lambda x: (weight[x], x))], np.int64)  # -1: nothing comes back
        give_w = np.array([weight[x] for x in give], np.int64)
        take_w = np.array([0, *[weight[x] for x in take[1:]]], np.int64)
        # For each slot given, the one taken whose difference is nearest to half the gap.
        want = give_w - gap / 2
        at = np.clip(np.searchsorted(take_w, want), 0, len(take_w) - 1)
        before = np.maximum(at - 1, 0)
        best = np.where(np.abs(take_w[before] - want) <= np.abs(take_w[at] - want), before, at)
        change = give_w - take_w[best]
        off = np.where((change > 0) & (change < gap), np.abs(change - gap / 2), np.inf)
        if not len(off) or not np.isfinite(off.min()):
            return
        k = int(off.argmin())
        given, taken = int(give[k]), int(take[best[k]])
        own[high].remove(given)
        own[low].add(given)
        if taken >= 0:
            own[low].remove(taken)
            own[high].add(taken)
        load[high] -= int(change[k])
        load[low] += int(change[k])


def grow(shard_of: dict[int, int], weight: dict[int, int], shards: int) -> dict[int, int]:
    """The next version with ``shards`` shards, one more than before: slots
    move into the new shard only, and no other record changes its shard."""
    return edit(shard_of, weight, shards, into={shards - 1})


class SlotMap:
    """Versions of a slot map, one folder each, under a shared root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        store = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not store.exists(path):
            return []
        names = [x.getPath().getName() for x in store.listStatus(path)]
        whole = [x for x in names if x.startswith("version=") and store.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{x}/_SUCCESS"))]
        return sorted(int(x.split("=")[1]) for x in whole)

    def store(self, shard_of: dict[int, int], weight: dict[int, int]) -> int:
        """Writes the next version and returns its number."""
        version = max(self.versions(), default=0) + 1
        rows = [(int(s), int(shard_of[s]), int(weight[s])) for s in sorted(shard_of)]
        frame = self.spark.createDataFrame(rows, "slot long, shard int, bytes long")
        frame.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/version={version}")  # over a try that broke off
        return version

    def rows(self, version: int | None = None) -> DataFrame:
        """(slot, shard, bytes) of a version, by default the latest."""
        version = max(self.versions()) if version is None else version
        return self.spark.read.schema("slot long, shard int, bytes long").parquet(f"{self.root}/version={version}")

    def load(self, version: int | None = None) -> dict[int, int]:
        """At most ``SLOTS`` and the parts of split slots."""
        return {r["slot"]: r["shard"] for r in self.rows(version).collect()}


# --- records -----------------------------------------------------------------

def light_rows(docs: DataFrame, id_col: str, text_col: str, slots: int = SLOTS) -> DataFrame:
    """(__llm_id, size, text_crc32, number, slot), written once: a row's
    number stays with it."""
    return written(
        docs.select(
            col(id_col).alias("__llm_id"),
            (F.octet_length(text_or_empty(text_col)) + 1).cast("long").alias("size"),
            F.crc32(text_or_empty(text_col).cast("binary")).alias("text_crc32"),
            slot_of(id_col, text_col, slots).alias("slot"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "records",
    )


def split_hot(light: DataFrame, shards: int, slots: int = SLOTS, known: dict[int, int] | None = None) -> DataFrame:
    """``light`` with the slots that are too large split by row number.  A
    slot stays split into as many parts as the map ``known`` has of it."""
    found = light.groupBy("slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).toPandas()
    bound = PARTS * shards
    most = [max(1, -(-int(found[x].sum()) // bound)) for x in ("bytes", "rows")]
    found["pieces"] = np.maximum(*[-(-found[x] // m) for x, m in zip(("bytes", "rows"), most)])
    found["pieces"] = found[["pieces", "rows"]].min(axis=1)  # one record is never split
    before = defaultdict(int)
    for slot in known or {}:
        before[slot % slots] = max(before[slot % slots], slot // slots + 1)
    found["pieces"] = [max(n, before[s]) for s, n in zip(found["slot"], found["pieces"])]
    hot = found[found["pieces"] > 1][["slot", "pieces"]].astype("int64")
    table = light.sparkSession.createDataFrame(hot, "slot long, pieces long")
    pieces = F.coalesce("pieces", F.lit(1).cast("long"))
    # At most one row for each slot.
    joined = light.join(F.broadcast(table), "slot", "left")
    return joined.withColumn("slot", F.col("slot") + _sub(F.col("number"), pieces, slots)).drop("pieces")


def shard(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    slots: int = SLOTS,
    map_root: str | None = None,
) -> DataFrame:
    """One row per record: id, size, text_crc32, law, shard, slot (its place in
    the shard, from 0), grown_shard (null: the law is not ``key``),
    virtual_slot, map_version.  The map lies under ``map_root``: a version
    there is edited, else a first one is made and then edited."""
    spark = docs.sparkSession
    store = SlotMap(spark, map_root or scratch_path(spark, "slot-map"))
    known = store.load() if store.versions() else {}
    dealt = split_hot(light_rows(docs, id_col, text_col, slots), shards, slots, known)
    stats = dealt.groupBy("slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).orderBy("slot").toPandas()
    weight = dict(zip(stats["slot"].tolist(), stats["bytes"].tolist()))
    if not store.versions():
        known = {s: s % shards for s in weight}
        store.store(known, weight)
    shard_of = edit(known, weight, shards)
    version = store.store(shard_of, weight)
    rows = dict(zip(stats["slot"].tolist(), stats["rows"].tolist()))
    filled: dict[int, int] = defaultdict(int)
    firsts = []
    for slot in sorted(shard_of):
        firsts.append((slot, shard_of[slot], filled[shard_of[slot]]))
        filled[shard_of[slot]] += rows[slot]
    places = spark.createDataFrame(pd.DataFrame(firsts, columns=["slot", "shard", "first"]), "slot long, shard int, first long")
    nth = F.row_number().over(Window.partitionBy("slot").orderBy("number")) - 1
    return (
        dealt.withColumn("nth", nth).join(F.broadcast(places), "slot")  # as many rows as the slot map
        .select(
            F.col("__llm_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("first") + F.col("nth")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
            F.col("slot").alias("virtual_slot"), F.lit(version).alias("map_version"),
        )
    )


def write_shards(docs: DataFrame, path: str, shard_map: SlotMap, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> None:
    """Writes ``docs``, all columns, one folder for each shard of the latest
    map (``__shard=0``, ...).  A slot that the map doesn't know goes where the
    first map would have put it."""
    known = shard_map.rows()
    shards = known.agg(F.max("shard")).first()[0]
    shards = 1 if shards is None else shards + 1
    pieces = known.groupBy((F.col("slot") % slots).alias("__base")).agg(F.collect_list(F.struct("slot", "shard")).alias("__parts"))
    rows = docs.withColumns({"__base": slot_of(id_col, text_col, slots), "__number": F.monotonically_increasing_id()})
    parts = F.array_sort("__parts")
    one = F.element_at(parts, (F.pmod(F.xxhash64("__number"), F.size("__parts")) + 1).cast("int"))
    found = rows.join(F.broadcast(pieces), "__base", "left").withColumn(
        "__shard", F.coalesce(one.getField("shard"), (F.col("__base") % shards).cast("int"))
    )
    found.drop("__base", "__number", "__parts").hint("rebalance", "__shard").write.partitionBy("__shard").mode("overwrite").parquet(path)
