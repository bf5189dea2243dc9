"""Point-in-time reads: snapshots, latest rows and strict as-of joins."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitval.operators.dedupe import first_per_key
from pitval.operators.skew import place_in_order

FAR_FUTURE = dt.date(9999, 12, 31)


def cutoff_date(cutoff: dt.date | str | None) -> Column:
    """The cutoff as a date column; none given means the far future, i.e. latest."""
    if isinstance(cutoff, str):
        cutoff = dt.date.fromisoformat(cutoff)
    return F.lit(cutoff or FAR_FUTURE).cast("date")


def snapshot_date(df: DataFrame, cutoff: dt.date | str | None, date: str = "as_of_date") -> Column:
    """The latest date not after the cutoff, as a scalar subquery over the date column.

    The subquery reads one column, and where ``date`` partitions the table the equality
    filter built from it prunes partitions.
    """
    return df.filter(F.col(date) <= cutoff_date(cutoff)).select(F.max(date)).scalar()


def snapshot_as_of(
    df: DataFrame, cutoff: dt.date | str | None = None, date: str = "as_of_date"
) -> DataFrame:
    """Rows of the one snapshot visible at the cutoff.

    The snapshot is chosen once for the whole table: an entity absent from it is absent
    from the answer even if an older snapshot had it.
    """
    return df.filter(
        (F.col(date) <= cutoff_date(cutoff)) & (F.col(date) == snapshot_date(df, cutoff, date))
    )


def latest_per_key_as_of(
    df: DataFrame,
    keys: Sequence[str],
    cutoff: dt.date | str | None = None,
    date: str = "as_of_date",
    ties: Sequence[Column] = (),
) -> DataFrame:
    """The newest row of every key not after the cutoff, whatever snapshot it came from."""
    visible = df.filter(F.col(date) <= cutoff_date(cutoff))
    return first_per_key(visible, keys, [F.col(date).desc(), *ties])


def asof_prior(
    left: DataFrame,
    history: DataFrame,
    key: str,
    left_period: str,
    history_period: str,
    value: str,
    out: str,
) -> DataFrame:
    """Backward as-of join, exact matches excluded; every left row is kept.

    ``history`` holds one row per (key, period). Left rows are first collapsed to their
    distinct (key, period) probes. Probes and history are range-partitioned by key and
    period, so one key may span many tasks; what a key knows at the end of a partition is
    carried to the next ones through a table of one row per partition. The answers are then
    joined back on (key, period), a join whose right side is unique and whose hot left
    partitions adaptive execution can split.
    """
    probes = left.select(
        F.col(key).alias("_k"), F.col(left_period).alias("_p"), F.lit(0).alias("_h")
    ).distinct()
    known = history.select(
        F.col(key).alias("_k"),
        F.col(history_period).alias("_p"),
        F.lit(1).alias("_h"),
        F.struct(F.col(value).alias("v")).alias("_v"),
    )
    both = probes.unionByName(known, allowMissingColumns=True)
    placed = place_in_order(both, ["_k", "_p", "_h"], "asof").withColumn("_part", F.shiftright("_slot", 33))
    # The last key of each partition, and the last value known of it there.
    known_at = F.when(F.col("_v").isNotNull(), F.col("_slot"))
    ends = placed.groupBy("_part", "_k").agg(F.max("_slot").alias("_end"), F.max_by("_v", known_at).alias("_v"))
    tails = ends.groupBy("_part").agg(F.max_by(F.struct("_k", "_v"), F.col("_end")).alias("t"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    told = F.when(F.col("t._v").isNotNull(), F.col("t"))
    carried = tails.select("_part", F.last(told, ignorenulls=True).over(earlier).alias("_carried"))
    before = Window.partitionBy("_part", "_k").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    from_before = F.when(F.col("_carried._k") == F.col("_k"), F.col("_carried._v"))
    answers = (
        placed.withColumn("_a", F.last("_v", ignorenulls=True).over(before))
        .filter("_h = 0")
        .join(F.broadcast(carried), "_part")
        .select("_k", "_p", F.coalesce("_a", from_before)["v"].alias(out))
    )
    return left.join(
        answers, (left[key] == answers["_k"]) & (left[left_period] == answers["_p"]), "left"
    ).drop("_k", "_p")


def attach_prior_by_period(
    left: DataFrame,
    history: DataFrame,
    key: str,
    left_period: str,
    history_period: str,
    value: str,
    out: str,
    only_when: Column | None = None,
) -> DataFrame:
    """``asof_prior`` for coarse periods (seasons, years), with one join and no window.

    The history of a key is at most one entry per period, so it fits a short sorted
    array; a left row picks the last entry before its own period. The right side has one
    row per key, which keeps a hot key on the left splittable. ``only_when`` limits the
    lookup to some rows; the others get null.
    """
    per_key = history.groupBy(F.col(key).alias("_k")).agg(
        F.array_sort(
            F.collect_list(F.struct(F.col(history_period).alias("p"), F.col(value).alias("v")))
        ).alias("_hist")
    )
    earlier = F.filter("_hist", lambda h: h["p"] < F.col(left_period))
    found = F.try_element_at(earlier, F.lit(-1))["v"]
    if only_when is not None:
        found = F.when(only_when, found)
    return (
        left.join(per_key, left[key] == per_key["_k"], "left")
        .withColumn(out, found)
        .drop("_k", "_hist")
    )
