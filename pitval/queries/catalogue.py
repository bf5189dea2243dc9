"""Every query by key, with the SQL that must give the same rows.

A query is a function of ``Views``. Its SQL runs over ``PRELUDE``; queries without SQL are
those whose algorithm has no SQL form (trees, cross-validation).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitval.queries.views import PRELUDE, Views

Query = Callable[[Views], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = _join(sql)
        return function

    return register


def _join(sql: str) -> str:
    """PRELUDE plus a body that either starts with SELECT or adds its own CTEs with WITH."""
    body = sql.strip()
    if body.upper().startswith("WITH"):
        return f"{PRELUDE.rstrip()},\n{body[4:].lstrip()}"
    return f"{PRELUDE}{body}"


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: function(Views(spark, folder))

    return {key: bind(function) for key, function in QUERIES.items()}


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})
