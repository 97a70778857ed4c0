"""Registered queries: each library operator on the driver's tables, with its SQL twin."""

from tabulon.catalog import cleaning, dashboards, learning, readings, statistics, streams, substitutes  # noqa: F401
from tabulon.catalog.registry import CATALOG, Entry

__all__ = ["CATALOG", "Entry"]
