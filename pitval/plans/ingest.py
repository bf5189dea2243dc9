"""Load landed feeds for one date. Every part is optional and safe to run again."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame

from pitval.sources import feeds
from pitval.sources.store import Store


def ingest(
    store: Store,
    as_of: dt.date,
    registry: DataFrame | None = None,
    outcomes: tuple[DataFrame, DataFrame] | None = None,
    seasons: Mapping[tuple[int, str], str] | None = None,
    feed_paths: tuple[str, str] | None = None,
    feed_period: int | None = None,
    feed_source: str = "feed",
) -> None:
    """Replace the date's snapshot of every part that is given, and nothing else.

    ``outcomes`` is the raw (bat, pitch) pair, ``seasons`` maps (period, role) to a CSV
    path, ``feed_paths`` is the (hitters, pitchers) pair of CSV paths.
    """
    if registry is not None:
        store.replace_for_date("registry", feeds.clean_registry(registry), as_of)
    if outcomes is not None:
        store.replace_for_date("outcomes", feeds.union_outcomes(*outcomes, as_of), as_of)
    if seasons is not None:
        loaded = feeds.load_seasons(store.spark, seasons, as_of)
        if loaded is not None:
            store.replace_for_date("features", loaded, as_of)
    if feed_paths is not None:
        loaded = feeds.load_feeds(store.spark, *feed_paths, feed_period, as_of, feed_source)
        if loaded is not None:
            store.replace_for_date("feed", feeds.with_feed_ids(loaded), as_of)
