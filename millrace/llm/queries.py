"""Named queries of this subpackage, with SQL for those that SQL can express."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import Tables

_MODULES = ("classify", "near", "packing", "vbyte", "warc", "rules", "quotes", "search", "transducer", "lines", "middle", "phrases", "scoring")

_registry: dict[str, Callable[[Tables], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    """Register ``build(tables)`` under ``key``; ``oracle`` is DuckDB SQL giving the same rows."""

    def wrap(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        _registry[key] = build
        if oracle is not None:
            _sql[key] = oracle
        return build

    return wrap


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"millrace.llm.query_{name}")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def runner(key: str) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _registry[key](Tables(spark, sf_dir))

        run.__name__ = key
        return run

    return {key: runner(key) for key in _registry}


def all_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
