"""All registered queries: importing the modules fills the catalogue."""

from pitval.queries import names, points, quality, streams, tables  # noqa: F401
from pitval.queries.catalogue import ORACLES, QUERIES, callables

__all__ = ["ORACLES", "QUERIES", "callables"]
