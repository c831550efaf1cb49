"""Registered queries: the operators bound to the test tables, each with SQL to check it where SQL can."""

from millrace.queries.registry import ORACLES, QUERIES
from millrace.queries import (  # noqa: F401  (importing registers the queries)
    aggregates, joins, patterns, projections, sources, state, stream_patterns, stream_state, streams, time, topn, watermarks, windows,
)

__all__ = ["ORACLES", "QUERIES"]
