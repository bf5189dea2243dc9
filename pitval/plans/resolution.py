"""Resolve every feed row and report on the result."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitval import constants as C
from pitval.operators.metrics import frequency_table
from pitval.operators.resolve import resolve_mentions
from pitval.session import materialize
from pitval.sources.store import Store


def resolve_all(
    store: Store,
    overrides: DataFrame,
    current_period: int,
    threshold: float = C.FUZZY_THRESHOLD,
    today: dt.date | None = None,
    dates: Sequence[dt.date] | None = None,
) -> DataFrame:
    """Resolve feeds and return all resolutions.

    By default the rows of any feed date that have no verdict yet: a date that is ingested
    again may bring new ones. Verdicts that stand are kept, so that a later override or
    registry leaves earlier resolutions, and every answer replayed from them, as they were;
    those of rows that left the feed go. ``dates`` names dates to resolve as a whole, also
    again. Each date uses what was known on it.
    """
    whole = dates is not None
    for day in dates if whole else _open_dates(store):
        feed = store.snapshot("feed", day).filter(F.col("as_of_date") == F.lit(day))
        old = store.read("resolutions").filter(F.col("as_of_date") == F.lit(day))
        resolved = resolve_mentions(
            feed if whole else feed.join(_merged(old), "feed_id", "left_anti"),
            store.snapshot("registry", day),
            store.snapshot("outcomes", day),
            overrides,
            current_period,
            threshold=threshold,
            resolved_at=today,
        )
        if not whole:
            kept = old.join(_merged(feed), "feed_id", "left_semi").select(resolved.columns)
            # The date is read before it is replaced.
            resolved = materialize(kept.unionByName(resolved), "resolutions")
        store.replace_for_date("resolutions", resolved, day)
    return store.read("resolutions")


def _merged(rows: DataFrame) -> DataFrame:
    """``rows`` as a side of a join that is sorted and merged. A table's file size is shared out over all of its
    columns, also those that are null throughout, so the ids of millions of rows look small enough to broadcast."""
    return rows.hint("merge")


def _open_dates(store: Store) -> list[dt.date]:
    """Feed dates with rows that have no verdict, or with verdicts of rows that are gone."""
    keys = ["as_of_date", "feed_id"]
    feed, done = (store.read(table).select(keys) for table in ("feed", "resolutions"))
    gone = done.join(_merged(feed), keys, "left_anti").join(feed.select("as_of_date").distinct(), "as_of_date", "left_semi")
    found = feed.join(_merged(done), keys, "left_anti").union(gone).select("as_of_date").distinct()
    return sorted(r["as_of_date"] for r in found.collect())


def method_summary(resolutions: DataFrame) -> DataFrame:
    """Rows and percent per method."""
    return frequency_table(resolutions, "method")


def resolved_rate(resolutions: DataFrame) -> DataFrame:
    """How many rows have an id, of how many."""
    return resolutions.agg(
        F.count("entity_id").alias("resolved"),
        F.count(F.lit(1)).alias("total"),
        (F.count("entity_id") * 100.0 / F.count(F.lit(1))).alias("percent"),
    )


def weakest_fuzzy(resolutions: DataFrame, feed: DataFrame, n: int = 5) -> DataFrame:
    """The lowest-scoring fuzzy matches with the name that was asked for."""
    weakest = resolutions.filter("method = 'fuzzy'").orderBy("score", "feed_id").limit(n)
    return _with_names(weakest, feed)


def unresolved_sample(resolutions: DataFrame, feed: DataFrame, n: int = 10) -> DataFrame:
    """The first unresolved or ambiguous rows by feed id."""
    open_rows = resolutions.filter(F.col("method").isin("unresolved", "ambiguous"))
    return _with_names(open_rows.orderBy("feed_id").limit(n), feed)


def _with_names(few: DataFrame, feed: DataFrame) -> DataFrame:
    """``few`` is a top-n result, so it is the side to broadcast."""
    names = feed.select("feed_id", "player_name", "group_code", "primary_pos")
    return names.join(F.broadcast(few), "feed_id").select(
        "feed_id", "method", "score", "entity_id", "player_name", "group_code", "primary_pos"
    )
