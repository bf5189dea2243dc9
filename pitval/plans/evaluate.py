"""How good are the models and the pairs, judged on outcomes that were held out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitval import constants as C
from pitval.functions.numeric import add_rate_stats
from pitval.functions.value import realized_value
from pitval.operators import features as ft
from pitval.operators import metrics as mt
from pitval.operators.costs import with_surplus
from pitval.operators.dedupe import first_per_key
from pitval.operators.models import (
    BlendModel, Fit, Model, fit_boosted_trees, fit_elastic_net, fit_forest, fit_models, fit_ridge, fit_ridge_sets, moments_by,
)
from pitval.operators.pairs import closest_pairs
from pitval.plans.forecast import ROLE_MODELS
from pitval.session import materialize
from pitval.sources.feeds import union_all


def scored(df: DataFrame, model: str, prediction: str = "prediction") -> DataFrame:
    return df.select(
        F.lit(model).alias("model"),
        F.col("outcome").cast("double").alias("actual"),
        F.col(prediction).cast("double").alias("predicted"),
    )


def score_models(predictions: Sequence[DataFrame]) -> DataFrame:
    """Metrics per model: the predictions are stacked and aggregated together."""
    return mt.regression_metrics(union_all(predictions), "actual", "predicted", ["model"])


def naive_mean(train: DataFrame, test: DataFrame) -> DataFrame:
    """Every test row predicted as the average outcome of the training rows."""
    return test.withColumn("prediction", train.select(F.avg("outcome")).scalar())


def naive_last_period(role_rows: DataFrame, test: DataFrame) -> DataFrame:
    """Every test row predicted as the entity's outcome one period earlier, else 0."""
    totals = role_rows.groupBy("entity_id", "period").agg(F.sum("outcome").alias("outcome"))
    return ft.prior_outcome_or_zero(test, totals)


def evaluate_role(
    prepared: DataFrame,
    role: str,
    columns: Sequence[str],
    holdout: Sequence[int] = C.HOLDOUT_PERIODS,
    period: str = "period",
    fit: Fit | None = fit_ridge,
) -> DataFrame:
    """Mean, repeat-last and (unless ``fit`` is None) model scores on held-out periods.

    On same-period rows the repeat-last baseline looks the earlier period up; lag-1 rows
    carry it as ``outcome_this_period``.
    """
    rows = prepared.filter(F.col("role") == role)
    train, test = ft.temporal_split(rows, period, holdout)
    if "outcome_this_period" in rows.columns:
        last = scored(test, f"{role}: naive_last", "outcome_this_period")
    else:
        last = scored(naive_last_period(rows, test), f"{role}: naive_last")
    parts = [scored(naive_mean(train, test), f"{role}: naive_mean"), last]
    if fit is not None:
        parts.append(scored(fit(train, columns, "outcome").predict(test), f"{role}: model"))
    return score_models(parts)


def score_side_by_side(test: DataFrame, models: Mapping[str, Model]) -> DataFrame:
    """Metrics per model on the same rows: one pass makes all predictions, and a row goes on
    once per model with its actual and its predicted outcome only."""
    made, columns = test, {}
    for i, (name, model) in enumerate(models.items()):
        columns[name] = f"_predicted{i}"
        made = model.predict(made, columns[name])
    each = F.array(*[F.struct(F.lit(n).alias("model"), F.col(c).cast("double").alias("predicted")) for n, c in columns.items()])
    rows = made.select(F.col("outcome").cast("double").alias("actual"), F.explode(each).alias("m"))
    return mt.regression_metrics(rows.select("actual", "m.*"), "actual", "predicted", ["model"])


def ablate(
    rows: DataFrame,
    feature_sets: Mapping[str, Sequence[str]],
    holdout: Sequence[int] = C.HOLDOUT_PERIODS,
    period: str = "period",
    fit: Fit = fit_ridge,
) -> DataFrame:
    """The same split and model with different feature sets; ridge models share their moments."""
    train, test = ft.temporal_split(rows, period, holdout)
    if fit is fit_ridge:
        models = fit_ridge_sets(train, feature_sets)
    else:
        models = {name: fit(train, columns, "outcome") for name, columns in feature_sets.items()}
    return score_side_by_side(test, models)


def ablate_by_role(
    rows: DataFrame,
    feature_sets: Mapping[str, Mapping[str, Sequence[str]]],
    holdout: Sequence[int] = C.HOLDOUT_PERIODS,
    period: str = "period",
) -> DataFrame:
    """Ridge scores of the feature sets of each role, with the role; the moments of all roles
    and sets are two aggregations."""
    train, test = ft.temporal_split(rows, period, holdout)
    every = [c for sets in feature_sets.values() for columns in sets.values() for c in columns]
    found = moments_by(train, every, by="role")
    parts = []
    for role, sets in feature_sets.items():
        models = {name: found[role].subset(columns).ridge() for name, columns in sets.items()}
        parts.append(score_side_by_side(test.filter(F.col("role") == role), models).withColumn("role", F.lit(role)))
    return union_all(parts)


def fielding_ablation(prepared: DataFrame, **split) -> DataFrame:
    bat = prepared.filter(F.col("role") == C.ROLE_BAT)
    without = [c for c in C.BAT_FEATURES if c != C.PRIOR_FIELDING]
    return ablate(
        bat, {"without prior_def_runs": without, "with prior_def_runs": C.BAT_FEATURES}, **split
    )


def extra_features_ablation(prepared: DataFrame, **split) -> DataFrame:
    bat = prepared.filter(F.col("role") == C.ROLE_BAT)
    without = [c for c in C.BAT_FEATURES if c not in C.EXTRA_BAT_FEATURES]
    return ablate(bat, {"without extra": without, "with extra": C.BAT_FEATURES}, **split)


def pitch_feature_swap(prepared: DataFrame, **split) -> DataFrame:
    pitch = add_rate_stats(prepared.filter(F.col("role") == C.ROLE_PITCH))
    return ablate(
        pitch, {"current": C.PITCH_FEATURES, "skill": C.SKILL_PITCH_FEATURES}, **split
    )


def candidate_models(boosted: dict | None = None, forest: dict | None = None) -> dict[str, Fit | tuple[str, ...]]:
    """The five models compared; sizes of the tree models can be set. A tuple averages models before it."""
    boosted, forest = boosted or {}, forest or {}
    return {
        "ridge": fit_ridge,
        "elastic_net": fit_elastic_net,
        "forest": partial(fit_forest, **forest) if forest else fit_forest,
        "boosted": partial(fit_boosted_trees, **boosted) if boosted else fit_boosted_trees,
        "blend": ("ridge", "boosted"),
    }


def compare_models_by_role(
    rows: DataFrame,
    role_columns: Mapping[str, Sequence[str]],
    models: Mapping[str, Fit | tuple[str, ...]] | None = None,
    holdout: Sequence[int] = C.HOLDOUT_PERIODS,
    period: str = "period",
) -> DataFrame:
    """The same features and split with different models, for each role. A kind of model that
    can train several roles in the same passes does."""
    train, test = ft.temporal_split(rows, period, holdout)
    made: dict[str, dict[str, Model]] = {role: {} for role in role_columns}
    for name, fit in (models or candidate_models()).items():
        fitted = {} if isinstance(fit, tuple) else fit_models(train, {role: (columns, fit) for role, columns in role_columns.items()})
        for role, own in made.items():
            own[name] = BlendModel([own[n] for n in fit]) if isinstance(fit, tuple) else fitted[role]
    parts = [
        score_side_by_side(test.filter(F.col("role") == role), own).withColumn("role", F.lit(role)) for role, own in made.items()
    ]
    return union_all(parts)


def compare_models(
    rows: DataFrame,
    columns: Sequence[str],
    models: Mapping[str, Fit | tuple[str, ...]] | None = None,
    holdout: Sequence[int] = C.HOLDOUT_PERIODS,
    period: str = "period",
) -> DataFrame:
    """The same features and split with different models, on the rows of one role."""
    one = rows.withColumn("role", F.lit("all"))
    return compare_models_by_role(one, {"all": columns}, models, holdout, period).drop("role")


# ---- value and pair quality ------------------------------------------------------


def entity_dim_for_period(features: DataFrame, registry: DataFrame, period: int) -> DataFrame:
    """entity_id, name and group of the entities present in a period, one row each; the
    lowest group code if a period records several."""
    groups = (
        features.filter(F.col("period") == period)
        .groupBy("entity_id")
        .agg(F.min("group_code").alias("group_code"))
    )
    names = registry.select(
        "entity_id", F.concat("first_name", F.lit(" "), "last_name").alias("name")
    )
    return groups.join(names, "entity_id")


def costs_from_outcomes(outcomes: DataFrame) -> DataFrame:
    """Known costs of every (entity, period)."""
    return (
        outcomes.filter("cost is not null")
        .groupBy("entity_id", "period")
        .agg(F.max("cost").alias("cost"))
    )


def with_realized_value(rows: DataFrame, outcomes: DataFrame, period: int) -> DataFrame:
    """Outcome in money less the period's cost, the minimum cost where none is known."""
    cost = ft.cost_by_entity(outcomes, period).withColumnRenamed("cost", "_cost")
    return (
        rows.join(cost, "entity_id", "left")
        .withColumn(
            "realized_value",
            realized_value(F.col("outcome"), F.coalesce("_cost", F.lit(float(C.MINIMUM_COST)))),
        )
        .drop("_cost")
    )


def value_frame(
    rows: DataFrame,
    outcomes: DataFrame,
    dims: DataFrame,
    target: int,
    scores: Mapping[str, str],
    keep_by: str,
) -> DataFrame:
    """Surplus per score column and realized value, one row per entity with a name and group.

    ``rows`` are lag-1 test rows; ``scores`` maps an output surplus column to the value
    column it starts from. Of two roles of one entity the one with the higher ``keep_by``
    stays. Rows without an age are left out.
    """
    costs = costs_from_outcomes(outcomes)
    frame = rows.withColumn("age_at_target", F.col("age") + 1)
    frame = with_surplus(frame, costs, target, scores, age="age_at_target", flag=None)
    frame = with_realized_value(frame, outcomes, target)
    kept = frame.join(dims.dropna(subset=["name", "group_code"]), "entity_id")
    return first_per_key(kept, ["entity_id"], [F.col(keep_by).desc_nulls_last(), F.col("role")])


def build_evaluation_frame(
    features: DataFrame,
    outcomes: DataFrame,
    registry: DataFrame,
    target: int,
    columns: Sequence[str],
    models: Mapping[str, tuple[list[str], Fit]] = ROLE_MODELS,
) -> DataFrame:
    """Train strictly before the target period, predict it, and put value on both the
    prediction and the repeat-last baseline."""
    prepared = materialize(
        ft.with_prior_fielding(
            ft.lag1_rows(features, outcomes, columns), ft.fielding_history(outcomes), "target_period"
        ),
        "lag1",
    )
    train, test = ft.split_at_target(prepared, target)
    fitted = fit_models(train, models)
    parts = [fitted[role].predict(test.filter(F.col("role") == role), "predicted_outcome") for role in models]
    return value_frame(
        union_all(parts),
        outcomes,
        entity_dim_for_period(features, registry, target),
        target,
        {"predicted_surplus": "predicted_outcome", "naive_surplus": "outcome_this_period"},
        "predicted_outcome",
    )


def surplus_accuracy(frame: DataFrame, scores: Sequence[str], k: int = C.TOP_K) -> DataFrame:
    """Per score: rank correlation with realized value, precision among the top ``k``, and
    the base rate of positive realized value."""
    parts = []
    for score in scores:
        rho = mt.spearman(frame, score, "realized_value").withColumn("score", F.lit(score))
        top = mt.precision_at_k(frame, score, "realized_value", k).select(
            F.col("rate").alias("precision"), F.lit(score).alias("score")
        )
        base = mt.hit_rate(frame, "realized_value").select(
            F.col("rate").alias("base_rate"), F.lit(score).alias("score")
        )
        parts.append(rho.join(top, "score").join(base, "score"))
    return union_all(parts)


def pairing_quality(
    frame: DataFrame, score: str, k: int = C.TOP_PAIRS, random_k: int = C.RANDOM_PAIRS, seed: int = 0
) -> DataFrame:
    """Median realized gap of the closest pairs by score and of random pairs."""
    values = frame.select(
        "entity_id", "group_code", "name", F.col(score).alias("surplus_value"),
        F.lit(None).cast("string").alias("primary_pos"),
        F.lit(None).cast("string").alias("other_pos"),
    )
    ids = ["entity_id_a", "entity_id_b"]
    chosen = closest_pairs(values, k, require_fit=False).select(*ids).withColumn("kind", F.lit("closest"))
    random = mt.hashed_pairs(frame, random_k, seed).select(*ids).withColumn("kind", F.lit("random"))
    gaps = mt.pair_gaps(chosen.unionByName(random), frame.select("entity_id", "realized_value"))
    return gaps.groupBy("kind").agg(
        F.count(F.lit(1)).alias("pairs"), F.median("realized_gap").alias("median_gap")
    )
