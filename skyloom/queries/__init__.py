"""Registered queries: name -> (function of session and table folder, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query under ``name``; ``sql`` is DuckDB SQL over tables and fixture views."""
    from ..fixtures import oracle

    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = oracle(sql)
        return f

    return add


def load() -> None:
    from . import expressions, filtering, fitting, matching, pixel, readers, statistics, transient  # noqa: F401
