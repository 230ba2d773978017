"""Registered queries: each operator on the shared tables, with its SQL counterpart."""

from __future__ import annotations

from acequia.registry import cleaning, dimensions, facts, matching, months, reports

_MODULES = (reports, cleaning, matching, dimensions, facts, months)


def queries() -> dict:
    return {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
