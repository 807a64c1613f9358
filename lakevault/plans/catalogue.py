"""All registered queries."""

from lakevault.plans import queries_ingest, queries_quality, queries_time, queries_vault  # noqa: F401
from lakevault.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
