"""Registry of named queries and their DuckDB oracle SQL.

Each query takes (spark, sf_dir) and returns a DataFrame over the driver
tables; the oracle computes the same relation in plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from segmetric.plans import (  # noqa: F401
        q_assoc,
        q_cluster,
        q_eval,
        q_models,
        q_prep,
        q_profile,
        q_reports,
    )
