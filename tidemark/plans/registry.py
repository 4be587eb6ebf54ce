"""Queries by name, and SQL of the same result."""

from __future__ import annotations

FOUND: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        FOUND[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add
