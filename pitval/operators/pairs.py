"""Closest-value pairs of compatible entities, exactly, without comparing all pairs.

Two rows form a pair when their groups differ (an unknown group differs from everything)
and, if a fit is required, their eligible sets overlap. Pairs are ranked by

    gap, then lower row last-first by (value, id), then upper row first-first by (value, id)

which is a total order. Sort the rows of one eligible code by (value, id) and take a pair
``(i, j)`` with ``m`` rows between them. Each row ``k`` between differs in group from
``i`` or from ``j``, so ``(i, k)`` or ``(k, j)`` is also a pair, and it ranks strictly
before ``(i, j)``. Hence a pair among the best ``n`` has fewer than ``n`` rows between its
ends: every row needs only its next ``n`` neighbours, however many values are equal. The
same argument holds when exactly one side must belong to a given group.

Two passes keep the work small. Pairs of direct neighbours give an upper bound on the
``n``-th gap, and a row farther than that from both neighbours is dropped, since no pair
within the bound contains or spans it. The rest look at their next ``n``. Rows are placed by their position in the global order and
cut into blocks of equal size, each repeating the first ``n`` rows of the next, so neither
a common code nor a common value makes a large task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pitval.functions.numeric import finite
from pitval.functions.text import eligible_set
from pitval.operators.skew import shuffle_width, with_position
from pitval.session import materialize

PAIR_FIELDS = ["entity_id", "group_code", "name", "primary_pos", "surplus_value"]
PAIR_COLUMNS = [f"{c}_a" for c in PAIR_FIELDS] + [f"{c}_b" for c in PAIR_FIELDS] + ["surplus_gap"]
BLOCK_ROWS = 4_096


def _differs(left: Column, right: Column) -> Column:
    return F.coalesce(left != right, F.lit(True))


def _one_side_in(group: str, left: Column, right: Column) -> Column:
    inside = F.lit(group)
    return F.coalesce(left == inside, F.lit(False)) != F.coalesce(right == inside, F.lit(False))


def _gap() -> Column:
    return F.col("_upper.surplus_value") - F.col("_lower.surplus_value")


def _is_pair(group: str | None) -> Column:
    """Whether the rows ``_lower`` and ``_upper`` form a pair, listed under their first
    shared code only so that it counts once."""
    lower, upper = F.col("_lower"), F.col("_upper")
    first_shared = F.array_min(F.array_intersect(lower["codes"], upper["codes"]))
    wanted = (
        (lower["code"] == upper["code"])
        & _differs(lower["group_code"], upper["group_code"])
        & (first_shared == lower["code"])
    )
    if group is not None:
        wanted = wanted & _one_side_in(group, lower["group_code"], upper["group_code"])
    return wanted


def _step(shift: Callable[[str], Column], window: WindowSpec) -> Column:
    """Value distance to the neighbour in the same code list; null at the ends of a list."""
    same = shift("code").over(window) == F.col("code")
    return F.when(same, F.abs(shift("surplus_value").over(window) - F.col("surplus_value")))


def closest_pairs(
    valuations: DataFrame,
    top_n: int = 20,
    require_fit: bool = True,
    group: str | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``top_n`` pairs with the smallest value gap.

    ``valuations`` has one row per entity with entity_id, group_code, name, primary_pos,
    other_pos and surplus_value; rows without a value form no pair. With ``group`` given
    only its pairs are returned and its member is side a; otherwise side a has the lower id.
    """
    if top_n < 1:
        raise ValueError("top_n must be at least 1")
    value = finite(F.col("surplus_value").cast("double"))
    # Written once: the search and the two detail lookups below all read it.
    base = materialize(
        valuations.select(
            *[c for c in PAIR_FIELDS if c != "surplus_value"],
            value.alias("surplus_value"),
            (
                eligible_set(F.col("primary_pos"), F.col("other_pos"))
                if require_fit
                else F.array(F.lit("*"))
            ).alias("codes"),
        ).filter("surplus_value is not null"),
        "valued",
    )
    listed = base.select(
        "entity_id", "group_code", "surplus_value", "codes", F.explode("codes").alias("code")
    )
    ordered = with_position(listed, ["code", "surplus_value", "entity_id"])

    size = max(block_rows, 4 * top_n)
    block = F.floor(F.col("position") / size)
    repeats = (F.col("position") % size < top_n) & (block > 0)
    homes = F.when(repeats, F.array(block, block - 1)).otherwise(F.array(block))
    # Few bytes, much work per row: give the partition count instead of deriving it from size.
    placed = (
        ordered.withColumn("_block", block)
        .withColumn("_home", F.explode(homes))
        .repartition(shuffle_width(ordered), "_home")
    )
    in_block = Window.partitionBy("_home").orderBy("position")
    row = F.struct("code", "surplus_value", "entity_id", "group_code", "codes")
    own = F.col("_block") == F.col("_home")

    # Neighbouring rows already give pairs; the n-th smallest of their gaps bounds the answer.
    neighbours = placed.select(
        row.alias("_lower"), F.lead(row).over(in_block).alias("_upper"), "_block", "_home"
    ).filter(own)
    limit = (
        neighbours.filter(_is_pair(group))
        .select(_gap().alias("gap"))
        .orderBy("gap")
        .limit(top_n)
        .agg(F.when(F.count(F.lit(1)) == top_n, F.max("gap")))
        .scalar()
    )
    near = placed.withColumns(
        {"_next": _step(F.lead, in_block), "_prev": _step(F.lag, in_block)}
    ).filter(
        F.coalesce(F.col("_next") <= limit, F.lit(True))
        | F.coalesce(F.col("_prev") <= limit, F.lit(True))
    )
    best = (
        near.select(
            row.alias("_lower"),
            F.collect_list(row).over(in_block.rowsBetween(1, top_n)).alias("_ahead"),
            "_block",
            "_home",
        )
        .filter(own)
        .select("_lower", F.explode("_ahead").alias("_upper"))
        .filter(_is_pair(group))
        .select(
            F.col("_lower.entity_id").alias("lower_id"),
            F.col("_upper.entity_id").alias("upper_id"),
            F.col("_lower.surplus_value").alias("lower_value"),
            F.col("_upper.surplus_value").alias("upper_value"),
            F.col("_lower.group_code").alias("lower_group"),
            _gap().alias("surplus_gap"),
        )
        .orderBy(
            F.col("surplus_gap").asc(),
            F.col("lower_value").desc(),
            F.col("lower_id").desc(),
            F.col("upper_value").asc(),
            F.col("upper_id").asc(),
        )
        .limit(top_n)
    )
    if group is None:
        lower_first = F.col("lower_id") < F.col("upper_id")
    else:
        lower_first = F.coalesce(F.col("lower_group") == F.lit(group), F.lit(False))
    oriented = best.select(
        F.when(lower_first, F.col("lower_id")).otherwise(F.col("upper_id")).alias("entity_id_a"),
        F.when(lower_first, F.col("upper_id")).otherwise(F.col("lower_id")).alias("entity_id_b"),
        "surplus_gap",
    )
    return _with_details(oriented, base)


def _with_details(pairs: DataFrame, valuations: DataFrame) -> DataFrame:
    """Descriptive columns for both sides. ``pairs`` holds at most ``top_n`` rows, so it is
    the side to broadcast."""

    def side(suffix: str) -> DataFrame:
        return valuations.select(*[F.col(c).alias(f"{c}_{suffix}") for c in PAIR_FIELDS])

    half = side("a").join(F.broadcast(pairs), "entity_id_a")
    both = side("b").join(F.broadcast(half), "entity_id_b").select(*PAIR_COLUMNS)
    value_a, value_b = F.col("surplus_value_a"), F.col("surplus_value_b")
    a_is_lower = F.struct(value_a, "entity_id_a") < F.struct(value_b, "entity_id_b")
    return both.orderBy(
        F.col("surplus_gap").asc(),
        F.least(value_a, value_b).desc(),
        F.when(a_is_lower, F.col("entity_id_a")).otherwise(F.col("entity_id_b")).desc(),
        F.greatest(value_a, value_b).asc(),
        F.when(a_is_lower, F.col("entity_id_b")).otherwise(F.col("entity_id_a")).asc(),
    )
