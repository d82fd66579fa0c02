"""The queries of this subpackage, by name, and their SQL."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(plan):
        QUERIES[name] = plan
        if sql is not None:
            SQL[name] = sql
        return plan

    return register
