"""Costs over the horizon and the surplus value built on them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_
from types import MappingProxyType

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitval import constants as C
from pitval.functions.value import surplus, value_path


def cost_precedence(automatic: DataFrame, manual: DataFrame) -> DataFrame:
    """One cost per (entity, period): a manual entry beats an automatic one, and among
    manual entries the one latest in the file.

    Both inputs have entity_id, period and cost; ``manual`` also has a sequence number
    ``seq`` when a key can repeat. A manual entry with an empty cost still wins.
    """
    if "seq" not in manual.columns:
        manual = manual.withColumn("seq", F.lit(0))
    columns = ["entity_id", "period", "cost", "source_rank", "seq"]
    both = (
        automatic.withColumns({"source_rank": F.lit(0), "seq": F.lit(0)})
        .select(*columns)
        .unionByName(manual.withColumn("source_rank", F.lit(1)).select(*columns))
    )
    newest = F.max_by(
        F.struct("cost", "source_rank"), F.struct("source_rank", F.col("seq").cast("long"), "cost")
    )
    return (
        both.groupBy("entity_id", "period")
        .agg(newest.alias("_best"))
        .select(
            "entity_id",
            "period",
            F.col("_best.cost").alias("cost"),
            (F.col("_best.source_rank") == 1).alias("is_manual"),
        )
    )


def horizon_costs(costs: DataFrame, base_period: int, horizon: int = C.HORIZON_YEARS) -> DataFrame:
    """One row per entity with a column ``cost_0 .. cost_{h-1}`` per year of the horizon."""
    years = [
        F.max(F.when(F.col("period") == base_period + y, F.col("cost"))).alias(f"cost_{y}")
        for y in range(horizon)
    ]
    in_horizon = F.col("period").between(base_period, base_period + horizon - 1)
    return costs.filter(in_horizon).groupBy("entity_id").agg(*years)


def with_surplus(
    rows: DataFrame,
    costs: DataFrame,
    base_period: int,
    values: Mapping[str, str] = MappingProxyType({"surplus_value": "outcome_year1"}),
    age: str = "age",
    flag: str | None = "cost_estimated",
    horizon: int = C.HORIZON_YEARS,
    minimum_cost: float = C.MINIMUM_COST,
    value_per_unit: float = C.VALUE_PER_UNIT,
    discount_rate: float = C.DISCOUNT_RATE,
) -> DataFrame:
    """Carry values over the horizon and subtract cost; rows without an age are left out.

    ``values`` maps each surplus column to the value column it starts from. Costs are
    pivoted to one row per entity first, so the whole horizon needs a single join and no
    aggregation above it. A missing or empty cost falls to the minimum and sets ``flag``.
    """
    joined = rows.filter(F.col(age).isNotNull()).join(
        horizon_costs(costs, base_period, horizon), "entity_id", "left"
    )
    found = [F.col(f"cost_{y}") for y in range(horizon)]
    filled = [F.coalesce(c, F.lit(float(minimum_cost))) for c in found]
    added = {}
    for out, value in values.items():
        path = value_path(F.col(value), F.col(age).cast("int"), horizon)
        added[out] = surplus(path, filled, value_per_unit, discount_rate)
    if flag:
        added[flag] = reduce(or_, [c.isNull() for c in found])
    return joined.withColumns(added).drop(*[f"cost_{y}" for y in range(horizon)])
