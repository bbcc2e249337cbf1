"""Named queries and, side by side, the SQL that must give the same rows."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir) under a name."""

    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register
