"""Train per-role models on history and predict the feed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitval import constants as C
from pitval.functions.numeric import clean_nonfinite
from pitval.operators import features as ft
from pitval.operators.models import Fit, fit_boosted_trees, fit_models, fit_ridge
from pitval.session import materialize
from pitval.sources.feeds import union_all
from pitval.sources.store import Store

ROLE_MODELS: dict[str, tuple[list[str], Fit]] = {
    C.ROLE_BAT: (C.BAT_FEATURES, fit_ridge),
    C.ROLE_PITCH: (C.PITCH_FEATURES, fit_boosted_trees),
}
FEATURE_COLUMNS = sorted(
    (set(C.BAT_FEATURES) | set(C.PITCH_FEATURES)) - {C.PRIOR_FIELDING}
)


def resolved_feed(feed: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Feed rows that have an entity, with the strikeout rate under its feature name."""
    ids = resolutions.filter("entity_id is not null").select("feed_id", "entity_id")
    return feed.join(ids, "feed_id").withColumn("so9", F.col("k_per_9"))


def train_and_predict(
    training: DataFrame,
    inputs: DataFrame,
    history: DataFrame,
    models: dict[str, tuple[list[str], Fit]] = ROLE_MODELS,
    anchor: str = "period",
    out: str = "projected_outcome",
) -> DataFrame:
    """Fit each role's model on ``training`` and predict the rows of ``inputs``.

    The prepared training rows are written once: every fit passes over them many times.
    """
    prepared = materialize(
        ft.with_prior_fielding(clean_nonfinite(training), history, anchor), "training"
    )
    ready = ft.with_prior_fielding(inputs, history, anchor)
    fitted = fit_models(prepared, models)
    return union_all([fitted[role].predict(ready.filter(F.col("role") == role), out) for role in models])


def forecast(
    store: Store,
    period: int,
    system: str,
    as_of: dt.date,
    models: dict[str, tuple[list[str], Fit]] = ROLE_MODELS,
) -> DataFrame:
    """Predict the latest resolved feed as of a date and store the predictions."""
    outcomes, features = store.snapshot("outcomes", as_of), store.snapshot("features", as_of)
    feed = store.snapshot("feed", as_of)
    predicted = train_and_predict(
        ft.training_rows(features, outcomes, FEATURE_COLUMNS),
        resolved_feed(feed, store.snapshot("resolutions", as_of).drop("as_of_date")),
        ft.fielding_history(outcomes),
        models,
    )
    store.replace_predictions(
        predicted.withColumns(
            {
                "period": F.lit(period),
                "system": F.lit(system),
                "as_of_date": F.lit(as_of).cast("date"),
                "projected_pa": F.col("pa").cast("double"),
                "projected_ip": F.col("ip").cast("double"),
            }
        )
    )
    return store.read("predictions").filter(
        (F.col("period") == period) & (F.col("system") == system)
    )
