"""Bindings of every operator to the driver's tables: Spark query + DuckDB oracle SQL."""

from __future__ import annotations

from . import cleaning, core, models, plans, profiles, relational, runlog, scaling, splits  # noqa: F401  (registration side effects)
from .registry import OPERATOR_IDS, ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE", "OPERATOR_IDS"]
