"""All registered queries of the core and their SQL."""

from __future__ import annotations

from . import model_queries, scope_queries  # noqa: F401 - they register their queries
from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
