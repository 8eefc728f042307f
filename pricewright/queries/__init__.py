"""Registered queries: each reads the given tables; most have a SQL twin for an independent check."""

from pricewright.queries import brands, evaluation, models, numbers, texts, trees, vectors  # noqa: F401
from pricewright.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
