"""The queries of this subpackage by name, each with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Build] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query under a name, with its SQL if there is one."""

    def add(build: Build) -> Build:
        if name in _QUERIES:
            raise ValueError(f"query {name} exists already")
        _QUERIES[name] = build
        if sql:
            _SQL[name] = sql
        return build

    return add


def queries() -> dict[str, Build]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
