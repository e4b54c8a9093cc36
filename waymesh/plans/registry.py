"""Registered queries of the conflation engine and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under the number of its operator; sql is its DuckDB counterpart, if SQL can express it."""

    def add(f: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"{name} is registered already")
        _QUERIES[name] = f
        if sql:
            _ORACLES[name] = sql
        return f

    return add


def _load() -> None:
    from . import choices, graphs, labels, more, relational, rules, scalars, spatial, stream  # noqa: F401


def FLAGSHIP(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The naive matcher: each reference segment's best target."""
    _load()
    return _QUERIES["q269_naive_matcher"](spark, sf_dir)


def queries() -> dict[str, Query]:
    _load()
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    _load()
    return _ORACLES
