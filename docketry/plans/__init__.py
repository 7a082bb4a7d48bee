"""Registered queries over the given tables."""

from docketry.plans import (  # noqa: F401
    collections,
    conversations,
    files,
    metadata,
    quality,
    relational,
    search,
    streams,
    versions,
)
from docketry.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
