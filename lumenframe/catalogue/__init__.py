"""Registered queries, each with its SQL twin; see ``register``."""

from __future__ import annotations

from . import (  # noqa: F401
    aggregates, basics, clauses, client, dialect, expressions, frames, interchange, joins, more_functions, nested, relations, reports, results, scalars, sinks, surface, timeseries, windows,
)
from .registry import ORACLES, QUERIES, register

__all__ = ["ORACLES", "QUERIES", "register"]
