"""Registered queries: each runs an operator over the test tables, most with an equal SQL text."""

from tidemark.queries import (  # noqa: F401 - importing registers the queries
    bucket_queries,
    change_tracking,
    fanout_queries,
    function_queries,
    merge_queries,
    overwrite_queries,
    quality_queries,
    schema_queries,
    snapshot_queries,
    table_queries,
)
from tidemark.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
