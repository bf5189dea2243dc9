"""One row per key under a declared, total order.

Written as ``row_number() = 1`` so that Spark's group-limit rule drops all but one row
per key before the shuffle; a key that holds a third of the table then sends one row
per map task, not all of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; ``order`` must leave no ties that differ in output."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_row", F.row_number().over(window)).filter(F.col("_row") == 1).drop("_row")
    )


def highest_volume(
    df: DataFrame, keys: Sequence[str], volume: str, ties: Sequence[Column] = ()
) -> DataFrame:
    """The row with the most volume per key, missing volume last."""
    return first_per_key(df, keys, [F.col(volume).desc_nulls_last(), *ties])


def best_prediction(
    df: DataFrame, keys: Sequence[str], value: str, role: str = "role"
) -> DataFrame:
    """Of several roles predicted for one key, the row with the highest value."""
    return first_per_key(df, keys, [F.col(value).desc_nulls_last(), F.col(role).asc()])
