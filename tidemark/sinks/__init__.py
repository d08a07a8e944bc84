"""Targets: appending by name or by position, deleting a load, emptying and creating tables."""

from tidemark.sinks.committed import CommittedTarget
from tidemark.sinks.schema import create_like, map_schema, map_type, mapped
from tidemark.sinks.targets import (
    JdbcTarget,
    PathTarget,
    TableTarget,
    Target,
    append_by_name,
    append_by_position,
    delete_load,
    truncate,
)

__all__ = [
    "CommittedTarget",
    "JdbcTarget",
    "PathTarget",
    "TableTarget",
    "Target",
    "append_by_name",
    "append_by_position",
    "create_like",
    "delete_load",
    "map_schema",
    "map_type",
    "mapped",
    "truncate",
]
