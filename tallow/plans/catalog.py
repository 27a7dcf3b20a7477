"""All registered queries: importing this module registers every query."""

from . import parse_queries, stream_queries, window_queries  # noqa: F401  (register on import)
from .registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
