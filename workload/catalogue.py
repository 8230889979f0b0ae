"""Importing this module registers every query."""

from __future__ import annotations

from . import landing_queries, silver_queries, star_queries, store_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
