"""The library's operators bound to the test tables, each next to its SQL."""

from workload import checks, extracts, marts, patterns, reports, storage  # noqa: F401  (register their queries)
from workload.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
