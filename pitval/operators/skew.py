"""Joins and row placement that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitval.session import materialize

KEY_BUCKETS = 1 << 16


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).cast("int")


def crowded_buckets(df: DataFrame, keys: Sequence[str], share: float = 1e-3) -> DataFrame:
    """Hash buckets of the key that hold at least ``share`` of the rows, with the number of
    salts that brings each back to that share: (_crowded, _salts).

    Rows are counted into a fixed number of buckets, mostly on the map side, so the cost
    does not depend on the number of keys. No hot key is missed; a rare key in the bucket
    of a hot one is merely salted too. There are at most ``1 / share`` crowded buckets,
    which bounds any broadcast of the result.
    """
    counts = df.groupBy(_bucket(keys).alias("_crowded")).agg(F.count(F.lit(1)).alias("_n"))
    fair = counts.select(F.sum("_n")).scalar() * share
    return counts.filter(F.col("_n") >= fair).select(
        "_crowded", F.ceil(F.col("_n") / fair).cast("int").alias("_salts")
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    share: float = 1e-3,
    crowded: DataFrame | None = None,
) -> DataFrame:
    """Equi-join of a possibly skewed left side to a right side with few rows per key.

    Left rows of crowded buckets are spread over salts and the matching right rows are
    repeated per salt. The salt is a hash of the whole left row, so a re-run task places
    its rows as the first run did. ``crowded`` may give the result of ``crowded_buckets``
    if it is known from a cheaper frame than ``left``.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"salted_join supports left and inner joins, not {how}")
    small = F.broadcast(crowded_buckets(left, on, share) if crowded is None else crowded)

    def marked(df: DataFrame, salt: Column) -> DataFrame:
        bucketed = df.withColumn("_bucket", _bucket(on))
        return (
            bucketed.join(small, F.col("_bucket") == F.col("_crowded"), "left")
            .withColumn("_salt", salt)
            .drop("_bucket", "_crowded", "_salts")
        )

    salts = F.coalesce("_salts", F.lit(1))
    one = F.pmod(F.xxhash64(*left.columns), salts).cast("int")
    every = F.explode(F.sequence(F.lit(0), salts - 1))
    return marked(left, one).join(marked(right, every), [*on, "_salt"], how).drop("_salt")


def place_in_order(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """Range-partition and sort by ``order``; adds ``_slot``.

    ``_slot`` carries the partition number in its upper bits and the row's position in
    the partition in its lower 33 bits. The placed rows are written out once, because
    positions are only meaningful while the placement does not change. ``order`` must be
    unique per row so that equal values can be split between partitions.
    """
    placed = (
        df.repartitionByRange(shuffle_width(df), *order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    return materialize(placed, label)


def _part(slot: str = "_slot") -> Column:
    return F.shiftright(F.col(slot), 33)


def _offsets(sizes: DataFrame) -> DataFrame:
    """Running totals over partitions: one row per shuffle partition, never per data row."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        F.sum("_size").over(Window.partitionBy()).alias("_total"),
    )


def with_position(df: DataFrame, order: Sequence[str], out: str = "position") -> DataFrame:
    """Zero-based place of every row in the global order, without a one-task window."""
    placed = place_in_order(df, order, "position")
    sizes = placed.groupBy(_part().alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    within = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", _part())
        .join(F.broadcast(_offsets(sizes)), "_part")
        .withColumn(out, F.col("_offset") + within)
        .drop("_part", "_slot", "_offset", "_total")
    )


def with_running_total(
    df: DataFrame, order: Sequence[str], weight: str, before: str, total: str
) -> DataFrame:
    """Sum of ``weight`` over all earlier rows of the global order, and over all rows."""
    placed = place_in_order(df, order, "running").withColumn("_part", _part())
    sizes = placed.groupBy("_part").agg(F.sum(weight).alias("_size"))
    within = (
        Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        placed.withColumn("_within", F.coalesce(F.sum(weight).over(within), F.lit(0)))
        .join(F.broadcast(_offsets(sizes)), "_part")
        .select(
            *df.columns,
            (F.col("_offset") + F.col("_within")).alias(before),
            F.col("_total").alias(total),
        )
    )
