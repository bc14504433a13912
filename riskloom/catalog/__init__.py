"""Importing this package fills the query registry."""

from riskloom.catalog import features, models, profile, scores  # noqa: F401
from riskloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
