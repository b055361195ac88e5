"""Registry of named queries."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.session import Tables

_MODULES = ("sources", "projections", "filters", "joins", "aggregates", "windows", "cleaning", "similarity", "streams", "graphs", "learning", "evaluation")


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


_registry: dict[str, Query] = {}


def query(key: str, oracle: str | None = None):
    """Register ``build(tables)`` under ``key``; ``oracle`` is SQL giving the same rows."""

    def wrap(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if key in _registry:
            raise ValueError(f"duplicate query {key!r}")
        _registry[key] = Query(key, build, oracle)
        return build

    return wrap


def all_queries() -> dict[str, Query]:
    for name in _MODULES:
        importlib.import_module(f"millrace.plans.{name}")
    return dict(_registry)
