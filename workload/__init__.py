"""The registered queries: each a Spark query with the SQL that checks it."""

from workload import discovery, lines, paging, patterns, payloads, relational, scans, selectors, stored, volume, windows  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
