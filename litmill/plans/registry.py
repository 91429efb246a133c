"""One place where queries and their oracle SQL meet their names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}
#: Modules of this package that register queries when they are imported.
MODULES: tuple[str, ...] = ("identity", "ingest", "quality", "grounding", "review", "documents")


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = function
        if oracle:
            _ORACLES[name] = oracle
        return function

    return register


def _load() -> None:
    import importlib

    for name in MODULES:
        importlib.import_module(f"litmill.plans.{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
