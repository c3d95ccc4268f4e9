"""Registered queries and the SQL that states the same result."""

from barwright.registry import analysis, cleaning, layering, metrics, reporting, series  # noqa: F401
from barwright.registry.base import ORACLES, QUERIES  # noqa: F401
