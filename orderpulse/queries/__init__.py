"""Registered queries and the SQL each must agree with."""

from orderpulse.queries import comparison, dimensions, documents, relational, streams, writes
from orderpulse.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "comparison", "dimensions", "documents", "relational", "streams", "writes"]
