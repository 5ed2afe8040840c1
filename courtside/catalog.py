"""Registry of the queries over the driver tables and of their DuckDB statements."""

from courtside.plans.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
