"""Shards by fixed virtual slots and a versioned slot map.

A record's slot is a hash of its id among ``SLOTS`` fixed ones. Bytes and rows are summed
per slot; a map says which shard holds a slot. Rebalancing edits the map and stores the
edit as a new version, so that only the rows of moved slots move and any older layout
can be read again. The map is bounded by the number of slots, not by the data.

Within its shard a row has a gapless place. Places come from the counts of slots and
their parts, and from the order within a part, so no task sees a whole shard.

Defined cases: a record without an id goes by its text; a null text counts one byte and
has a null checksum; equal rows get the same slot and different places; an empty table
has an empty layout. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitval.llm.common import read, text_bytes
from pitval.session import materialize, scratch_path
from pitval.sources.store import folder_names

SHARDS = 16
SLOTS = 4096
#: Parts of a slot in which places are counted.
PARTS = 16
#: Rebalancing ends when the fullest and the emptiest shard differ by less than this share of the mean.
CLOSE = 0.001


def first_map(slots: int = SLOTS, shards: int = SHARDS) -> np.ndarray:
    """Version 0: slots dealt in turn."""
    return np.arange(slots) % shards


def rebalanced(shard_of: np.ndarray, sizes: np.ndarray, shards: int) -> np.ndarray:
    """The map edited until the shards' sums of ``sizes`` are close.

    Each step moves a slot from the fullest to the emptiest shard, or swaps two of theirs,
    whichever brings the two closest; it ends when neither helps.
    """
    shard_of = shard_of.copy()
    load = np.bincount(shard_of, weights=sizes, minlength=shards).astype(np.int64)
    while True:
        high, low = int(load.argmax()), int(load.argmin())
        gap = int(load[high] - load[low])
        if gap <= CLOSE * load.mean():
            break
        ours, theirs = np.flatnonzero(shard_of == high), np.flatnonzero(shard_of == low)
        ours = ours[sizes[ours] > 0]
        if not len(ours):
            break
        # A move is a swap with nothing.
        other = np.concatenate(([0], sizes[theirs]))
        order = np.argsort(other, kind="stable")
        wanted = sizes[ours] - gap / 2
        at = np.clip(np.searchsorted(other[order], wanted), 0, len(other) - 1)
        best = None
        for near in (at, np.maximum(at - 1, 0)):
            moved = sizes[ours] - other[order[near]]
            left = np.abs(gap - 2 * moved)
            k = int(left.argmin())
            if left[k] < gap and (best is None or left[k] < best[0]):
                best = (int(left[k]), k, int(order[near[k]]))
        if best is None:
            break
        _, k, j = best
        moved = int(sizes[ours[k]] - other[j])
        shard_of[ours[k]] = low
        if j:
            shard_of[theirs[j - 1]] = high
        load[high] -= moved
        load[low] += moved
    return shard_of


class SlotMaps:
    """Versions of a slot map in one folder; a version is written once and never changed.

    A rebalance edits the newest version and writes the next one.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def save(self, version: int, shard_of: np.ndarray) -> None:
        table = pa.table({"slot": pa.array(np.arange(len(shard_of)), pa.int32()), "shard": pa.array(shard_of, pa.int32())})
        self.spark.createDataFrame(table).coalesce(1).write.mode("error").parquet(f"{self.path}/version={version}")

    def versions(self) -> list[int]:
        names = folder_names(self.spark, self.path)
        return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))

    def edited(self, sizes: np.ndarray, shards: int) -> np.ndarray:
        """The newest map, edited for these sizes; stored as the next version if it had to change."""
        if not self.versions():
            self.save(0, first_map(len(sizes), shards))
        newest = self.versions()[-1]
        before = self.load(newest)
        if len(before) != len(sizes):
            raise ValueError(f"the stored map has {len(before)} slots, not {len(sizes)}")
        after = rebalanced(before, sizes, shards)
        if (after != before).any():
            self.save(newest + 1, after)
        return after

    def load(self, version: int) -> np.ndarray:
        table = self.spark.read.parquet(f"{self.path}/version={version}").toArrow().sort_by("slot")
        return table.column("shard").to_numpy()


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual slot and part of every row."""
    text = F.col("text").cast("string")
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(text)).otherwise(F.xxhash64("doc_id"))
    return docs.select(
        "doc_id",
        (text_bytes(text) + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(key, F.lit(slots)).cast("int").alias("virtual_slot"),
    ).withColumn("part", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(PARTS)).cast("int"))


def place(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, maps: SlotMaps | None = None) -> DataFrame:
    """Every row with its shard by the rebalanced map, and its place there (``slot``).

    ``maps`` holds the map from call to call: the newest version is edited, so that rows move only
    where sizes or the number of shards have changed.
    """
    spark = docs.sparkSession
    rows = materialize(records(docs, slots), "shard-records")
    # At most slots x PARTS rows.
    parts = rows.groupBy("virtual_slot", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).toArrow().sort_by([("virtual_slot", "ascending"), ("part", "ascending")])
    own = parts.column("virtual_slot").to_numpy()
    sizes = np.zeros(slots, np.int64)
    np.add.at(sizes, own, parts.column("bytes").to_numpy())
    maps = maps or SlotMaps(spark, scratch_path(spark, "slot-map"))
    shard_of = maps.edited(sizes, shards)
    shard, counts = shard_of[own], parts.column("rows").to_numpy()
    order = np.argsort(shard, kind="stable")
    before = np.cumsum(counts[order]) - counts[order]
    heads = np.searchsorted(shard[order], shard[order])
    offset = np.empty(len(own), np.int64)
    offset[order] = before - before[heads] if len(own) else before
    layout = spark.createDataFrame(
        pa.table({"virtual_slot": pa.array(own, pa.int32()), "part": pa.array(parts.column("part").to_numpy(), pa.int32()), "shard": pa.array(shard, pa.int32()), "offset": pa.array(offset, pa.int64())})
    )
    number = F.row_number().over(Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "size", "text_crc32"))
    return (
        rows.withColumn("number", number)
        .join(F.broadcast(layout), ["virtual_slot", "part"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("offset") + F.col("number") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
        )
    )


def op2(spark, folder):
    return place(read(spark, folder, "documents"))
