"""Training rows that do not fan out and do not leak the future.

Facts carry ``as_of_date``; pin one snapshot first (``snapshot_as_of``), otherwise two
loads of the same period would both be summed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitval import constants as C
from pitval.operators.asof import attach_prior_by_period

KEYS = ["entity_id", "period", "role"]


def outcome_by_period(outcomes: DataFrame) -> DataFrame:
    """Outcome summed over the stints of (entity, period, role), nulls left out."""
    return (
        outcomes.filter("outcome is not null")
        .groupBy(*KEYS)
        .agg(F.sum("outcome").alias("outcome"))
    )


def fielding_history(outcomes: DataFrame, role: str = C.ROLE_BAT) -> DataFrame:
    """Fielding runs summed by (entity, period) for the one role that records them."""
    return (
        outcomes.filter((F.col("role") == role) & F.col("def_runs").isNotNull())
        .groupBy("entity_id", "period")
        .agg(F.sum("def_runs").alias("def_runs"))
    )


def cost_by_entity(outcomes: DataFrame, period: int) -> DataFrame:
    """The cost of each entity in one period; the largest of its repeated entries."""
    return (
        outcomes.filter((F.col("period") == period) & F.col("cost").isNotNull())
        .groupBy("entity_id")
        .agg(F.max("cost").alias("cost"))
    )


def training_rows(
    features: DataFrame, outcomes: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """Features of a period joined to the outcome of the same period.

    Outcomes are summed below the join, so an entity with several stints still yields one
    row per feature row.
    """
    kept = features.select(*KEYS, *columns) if columns else features
    return kept.join(outcome_by_period(outcomes), KEYS)


def lag1_rows(
    features: DataFrame, outcomes: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """Features of period N with the outcomes of N and of N + 1.

    An entity with no N + 1 drops out, and a gap period never matches. An outcome counts
    for its own period and for the one before, so one aggregation of one scan gives both.
    """
    value = F.col("outcome")
    roles = F.array(
        F.struct(F.col("period").alias("period"), value.alias("own"), F.lit(None).cast("double").alias("next")),
        F.struct((F.col("period") - 1).alias("period"), F.lit(None).cast("double").alias("own"), value.alias("next")),
    )
    totals = (
        outcomes.filter("outcome is not null")
        .select("entity_id", "role", F.explode(roles).alias("x"))
        .groupBy("entity_id", F.col("x.period").alias("period"), "role")
        .agg(F.sum("x.own").alias("outcome_this_period"), F.sum("x.next").alias("outcome"))
        .filter("outcome_this_period is not null and outcome is not null")
    )
    kept = features.select(*KEYS, *columns) if columns else features
    return kept.join(totals, KEYS).withColumn("target_period", F.col("period") + 1)


def with_prior_fielding(
    rows: DataFrame, history: DataFrame, anchor: str = "period", role: str = C.ROLE_BAT
) -> DataFrame:
    """The latest fielding runs strictly before ``anchor``, for rows of one role only."""
    return attach_prior_by_period(
        rows, history, "entity_id", anchor, "period", "def_runs", C.PRIOR_FIELDING,
        only_when=F.col("role") == role,
    )


def temporal_split(df: DataFrame, column: str, holdout: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """Train on every period outside ``holdout``, test on the periods in it."""
    held = F.col(column).isin(list(holdout))
    return df.filter(~held), df.filter(held)


def split_at_target(df: DataFrame, target: int, column: str = "target_period") -> tuple[DataFrame, DataFrame]:
    """Train strictly before the target period, test on it."""
    return df.filter(F.col(column) < target), df.filter(F.col(column) == target)


def prior_outcome_or_zero(rows: DataFrame, totals: DataFrame, out: str = "prediction") -> DataFrame:
    """The entity's outcome in the period just before, 0 where there is none."""
    lookup = totals.select(
        "entity_id", (F.col("period") + 1).alias("period"), F.col("outcome").alias("_prior")
    )
    return (
        rows.join(lookup, ["entity_id", "period"], "left")
        .withColumn(out, F.coalesce("_prior", F.lit(0.0)))
        .drop("_prior")
    )
