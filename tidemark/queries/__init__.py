"""Every operator and feed as a query over the given tables, each with equal SQL for a second engine."""

from tidemark.queries import feeds, loads, relational, scalars, sinks
from tidemark.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "feeds", "loads", "relational", "scalars", "sinks"]
