"""Registered queries over the driver's tables, each with its SQL twin."""

from . import data_queries, market_queries, state_queries, stream_queries  # noqa: F401  (registration)
from .registry import ORACLES, QUERIES, run

__all__ = ["ORACLES", "QUERIES", "run"]
