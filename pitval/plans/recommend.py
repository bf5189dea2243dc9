"""Point-in-time valuations and the closest pairs among them, now or at a past date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitval.operators.asof import snapshot_as_of
from pitval.operators.dedupe import first_per_key
from pitval.operators.pairs import closest_pairs
from pitval.sources.store import Store

COLUMNS = [
    "entity_id", "as_of_date", "group_code", "primary_pos", "other_pos", "age",
    "outcome_year1", "surplus_value", "cost_estimated", "name",
]


def valuations_as_of(
    valuations: DataFrame,
    registry: DataFrame,
    resolutions: DataFrame,
    feed: DataFrame,
    cutoff: dt.date | str | None = None,
    entity_id: int | None = None,
) -> DataFrame:
    """One row per entity of the valuation snapshot visible at the cutoff.

    Every dated input is pinned to its own latest snapshot by the cutoff, so nothing that
    comes later can change a past answer; a registry or resolutions without a date are taken
    as given. An entity with both roles keeps its bat row.
    """
    values = snapshot_as_of(valuations, cutoff)
    return _described(values, _pinned(registry, cutoff), _pinned(resolutions, cutoff), snapshot_as_of(feed, cutoff), entity_id)


def _pinned(df: DataFrame, cutoff: dt.date | str | None) -> DataFrame:
    return snapshot_as_of(df, cutoff) if "as_of_date" in df.columns else df


def _described(
    values: DataFrame, registry: DataFrame, resolutions: DataFrame, feed: DataFrame, entity_id: int | None
) -> DataFrame:
    """Valuations of one snapshot with the group, positions and name of one snapshot each."""
    ids = resolutions.select("feed_id", "entity_id")
    if entity_id is not None:
        values = values.filter(F.col("entity_id") == entity_id)
        ids = ids.filter(F.col("entity_id") == entity_id)
    details = first_per_key(
        feed.select("feed_id", "role", "group_code", "primary_pos", "other_pos")
        .join(ids.filter("entity_id is not null"), "feed_id"),
        ["entity_id"],
        [F.col("role").asc(), F.col("feed_id").asc()],
    ).drop("feed_id", "role")
    names = registry.select(
        "entity_id", F.concat("first_name", F.lit(" "), "last_name").alias("name")
    )
    return values.join(details, "entity_id").join(names, "entity_id").select(*COLUMNS)


def _stored(store: Store, cutoff: dt.date | str | None, entity_id: int | None = None) -> DataFrame:
    pinned = [store.snapshot(table, cutoff) for table in ("valuations", "registry", "resolutions", "feed")]
    return _described(*pinned, entity_id)


def group_count(valuations: DataFrame) -> DataFrame:
    """Number of entities and of distinct groups, unknown groups left out."""
    return valuations.agg(
        F.count(F.lit(1)).alias("entities"), F.countDistinct("group_code").alias("groups")
    )


def recommend(
    store: Store,
    group: str | None = None,
    top_n: int = 15,
    require_fit: bool = True,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """The closest-valued pairs, as known at ``as_of`` or now."""
    if top_n < 1:
        raise ValueError("top_n must be at least 1")
    return closest_pairs(_stored(store, as_of), top_n, require_fit, group)


def backtest(
    store: Store, as_of: dt.date | str, group: str | None = None, top_n: int = 15
) -> DataFrame:
    """``recommend`` replayed at a past decision date."""
    return recommend(store, group, top_n, as_of=as_of)


def entity_valuation(store: Store, entity_id: int) -> DataFrame:
    """The latest valuation of one entity; empty if it has none."""
    return _stored(store, None, entity_id)
