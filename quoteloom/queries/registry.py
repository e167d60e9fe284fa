"""Registration of named queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    ids: tuple[str, ...]
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, ids: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register ``build`` under ``name``; ``ids`` are the inventory entries it covers."""

    def add(build: Build) -> Build:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, tuple(ids.split()), build, sql)
        return build

    return add
