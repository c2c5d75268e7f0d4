"""All registered queries, in one place."""

from checks import stream_queries, table_queries  # noqa: F401 - register their queries
from checks.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
