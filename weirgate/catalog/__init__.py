"""Registered queries: one per inventory row, each with its SQL where SQL can say it."""

from __future__ import annotations

from weirgate.catalog import (  # noqa: F401
    q_aggregates,
    q_dedup,
    q_projections,
    q_readme,
    q_sinks,
    q_sources,
    q_streaming,
    q_validation,
    q_windows,
)
from weirgate.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
