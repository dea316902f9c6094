"""Registry of named queries: a Spark builder and an independent SQL check each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None  # None: not expressible as one SQL statement; checked by tests


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    from .plans import queries, queries_io, queries_ops, queries_quality  # noqa: F401  (registers on import)
    return REGISTRY
