"""Registered queries: each takes (spark, table folder) and returns a DataFrame.

``register(key, sql)`` records the Spark callable and, where the operator can be
written in SQL, the equivalent DuckDB query over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so that it registers its queries."""
    from keelson.plans import scans, prep, profile, series, evaluation, models, streams  # noqa: F401
