"""All queries of the engine with their SQL."""

from __future__ import annotations

from .plans import control, gates, histories, increments, registry, rules, star, states, storage  # noqa: F401


def queries() -> dict:
    return {name: q.run for name, q in registry.ALL.items()}


def oracle_sql() -> dict:
    return {name: q.sql for name, q in registry.ALL.items() if q.sql}
