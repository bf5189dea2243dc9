"""Exact order statistics of many rows without sorting them.

Values are counted in ranges of equal width between the least and the greatest of a group;
the range that holds a wanted rank is cut into ranges again, between its own least and
greatest value, until these are one. A pass moves counts of at most ``RANGES`` ranges for each
open one, whatever the number of rows, and only the rows of ranges still open go on. Rows with
few distinct values are done after one pass, most others after two or three.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitval.session import materialize

RANGES = 4096


def _range_of(value: Column, low: Column, high: Column) -> Column:
    """0..RANGES - 1, never falling as the value grows; the least and the greatest value part."""
    # Halves first: the difference of two large numbers of unlike sign would overflow.
    share = F.try_divide(value / 2 - low / 2, high / 2 - low / 2)
    inner = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * (RANGES - 1)), F.lit(RANGES - 1))
    return F.when(value == low, F.lit(0)).when(value == high, F.lit(RANGES - 1)).otherwise(inner).cast("int")


def values_at_ranks(df: DataFrame, value: str, ranks: Column, by: Sequence[str] = ()) -> DataFrame:
    """(``by``, rank, value): the value at each rank, counted from 1 in ascending order.

    ``ranks`` is an array of longs that may use the group's number of values, ``n``. Null and NaN
    values are left out; a group without any has no row. Infinite values are refused.
    """
    keys = list(by)
    name = lambda c: F.col(f"`{c}`")
    rows = df.select(
        F.struct(*[name(c) for c in keys], F.lit(0).alias("_one")).alias("group"), name(value).cast("double").alias("v")
    ).where("v is not null and not isnan(v)")
    rows = rows.withColumn("v", F.when(F.abs("v") == float("inf"), F.raise_error(F.lit("an infinite value has no range"))).otherwise(F.col("v")))
    whole = rows.groupBy("group").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n"))
    # A path names a range: the ranges that hold it, from the widest one.
    open_ = materialize(whole.select("group", F.array().cast("array<int>").alias("path"), "low", "high", F.explode(ranks).alias("rank"), F.lit(0).cast("long").alias("before")), "ranks")
    rows = rows.withColumn("path", F.array().cast("array<int>"))
    found = []
    while True:
        done = open_.where("low = high")
        found.append(done.select("group", "rank", F.col("low").alias("v")))
        open_ = open_.where("low < high")
        spans = open_.select("group", "path", "low", "high").distinct()
        if spans.isEmpty():
            break
        rows = rows.join(spans, ["group", "path"]).select(
            "group", F.concat("path", F.array(_range_of(F.col("v"), F.col("low"), F.col("high")))).alias("path"), "v"
        )
        counts = rows.groupBy("group", "path").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n"))
        parent = F.slice("path", 1, F.size("path") - 1)
        order = Window.partitionBy("group", "parent").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
        counted = counts.withColumn("parent", parent).withColumn("under", F.coalesce(F.sum("n").over(order), F.lit(0)))
        asked = open_.select("group", F.col("path").alias("parent"), "rank", "before")
        within = F.col("rank") - F.col("before") - F.col("under")
        met = counted.join(asked, ["group", "parent"]).where((within > 0) & (within <= F.col("n")))
        open_ = materialize(
            met.select("group", "path", "low", "high", "rank", (F.col("before") + F.col("under")).alias("before")), "ranks"
        )
    made = found[0]
    for part in found[1:]:
        made = made.unionByName(part)
    return made.select(*[F.col(f"group.`{c}`").alias(c) for c in keys], "rank", F.col("v").alias(value))


def exact_median(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "median") -> DataFrame:
    """The middle value of each group, or the mean of the two middle ones."""
    half = F.col("n") / 2
    ranks = F.array_distinct(F.array(F.ceil(half), (F.floor(half) + 1)))
    return values_at_ranks(df, value, ranks, by).groupBy(*by).agg(F.avg(f"`{value}`").alias(out))
