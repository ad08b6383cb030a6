"""Query registry: every operator over the shared test tables, with its SQL twin."""

from . import clean, model, series, stats, streams  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
