"""The registry of queries: a name, a function of (spark, sf_dir), and the oracle's SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add
