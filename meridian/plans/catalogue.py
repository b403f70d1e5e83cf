"""Imports every module that registers queries."""

from __future__ import annotations

from meridian.plans import composite_queries, report_queries, sequence_queries, store_queries, table_queries, text_queries, time_place_queries, vector_queries  # noqa: F401
from meridian.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
