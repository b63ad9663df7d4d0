"""Registered queries over the star-schema test tables, and their SQL counterparts."""

from pavilion.workload import checks, ingest, models, scalars  # noqa: F401  (register the queries)
from pavilion.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
