"""pitval: point-in-time valuation and matching of entities, as Spark jobs."""

__version__ = "0.1.0"
