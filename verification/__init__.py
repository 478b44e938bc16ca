"""Queries over the driver's tables, each with SQL that has to give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str) -> Callable[[Build], Build]:
    """Register a query under a name together with its SQL."""

    def add(build: Build) -> Build:
        if name in REGISTRY:
            raise ValueError(f"query {name} exists already")
        REGISTRY[name] = Query(build, sql)
        return build

    return add
