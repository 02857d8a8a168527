"""Registry of named queries: a Spark builder and, where one exists, an
equivalent ANSI-SQL text over the driver's tables (the DuckDB oracle)."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: QueryFn
    sql: str | None
    items: str  # SURVEY §2 ids covered


_REGISTRY: dict[str, Query] = {}


def register(name: str, items: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Query(name, fn, sql, items)
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    # importing the modules fills the registry
    from pixelframe.plans import (  # noqa: F401
        queries_prep, queries_features, queries_metrics, queries_raster, queries_models, queries_closed, queries_search,
        queries_storage)
    return dict(_REGISTRY)
