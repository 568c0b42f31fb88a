"""Registered queries: each key is one operator on the given tables, with the SQL that must agree."""

from __future__ import annotations

from strata.plans import (  # noqa: F401  (importing a module registers its queries)
    event_log,
    governance,
    layers,
    search,
    sql,
    streams,
    tables,
)
from strata.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
