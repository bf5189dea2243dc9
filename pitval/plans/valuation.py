"""Surplus value over the horizon for every predicted entity."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitval import constants as C
from pitval.operators import features as ft
from pitval.operators.costs import cost_precedence, with_surplus
from pitval.sources.store import Store


def valuation_inputs(predictions: DataFrame, resolutions: DataFrame, feed: DataFrame) -> DataFrame:
    """One row per (entity, predicted outcome) with the highest age among its feed rows.

    Ages are reduced to one per entity below the join, so an entity with several feed
    rows does not fan out.
    """
    ages = (
        resolutions.filter("entity_id is not null")
        .select("feed_id", "entity_id")
        .join(feed.select("feed_id", "age"), "feed_id")
        .groupBy("entity_id")
        .agg(F.max("age").alias("age"))
    )
    return (
        predictions.select("entity_id", F.col("projected_outcome").alias("outcome_year1"))
        .distinct()
        .join(ages, "entity_id")
    )


def value_entities(
    inputs: DataFrame, outcomes: DataFrame, manual_costs: DataFrame, base_period: int
) -> DataFrame:
    """Valuation rows: entity_id, age, outcome_year1, surplus_value, cost_estimated."""
    automatic = ft.cost_by_entity(outcomes, base_period).withColumn("period", F.lit(base_period))
    costs = cost_precedence(automatic, manual_costs)
    return with_surplus(inputs, costs, base_period).select(
        "entity_id", F.col("age").cast("int").alias("age"), "outcome_year1", "surplus_value",
        "cost_estimated",
    )


def valuation_all(
    store: Store, manual_costs: DataFrame, period: int, system: str, as_of: dt.date
) -> DataFrame:
    """Value the stored predictions and store the result as the snapshot of ``as_of``."""
    predictions = store.read("predictions").filter(
        (F.col("period") == period) & (F.col("system") == system)
    )
    inputs = valuation_inputs(
        predictions, store.snapshot("resolutions", as_of).drop("as_of_date"), store.snapshot("feed", as_of)
    )
    outcomes = store.snapshot("outcomes", as_of)
    store.replace_for_date(
        "valuations", value_entities(inputs, outcomes, manual_costs, period), as_of
    )
    return store.read("valuations").filter(F.col("as_of_date") == F.lit(as_of).cast("date"))


def top_valued(valuations: DataFrame, n: int = C.TOP_VALUED) -> DataFrame:
    return valuations.orderBy(F.col("surplus_value").desc_nulls_last(), "entity_id").limit(n)
