"""Queries of this subpackage over the test tables, and their SQL where SQL can say the same."""

from __future__ import annotations

from cohortflow.queries.registry import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


__all__ = ["QUERIES", "SQL", "query", "table"]
