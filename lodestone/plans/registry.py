"""All queries of the library over the test tables, with their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_FOUND: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        _FOUND[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _load() -> None:
    from lodestone.plans import phase_queries, question_queries, row_queries, sampling_queries, text_queries, verdict_queries  # noqa: F401  each registers its own


def queries() -> dict[str, Query]:
    _load()
    return dict(_FOUND)


def oracles() -> dict[str, str]:
    _load()
    return dict(_SQL)
