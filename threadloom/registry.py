"""All queries of the library, by name, with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans.fixtures import Tables, with_tables

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of the domain tables as a query; `sql`: what DuckDB has to give for it."""

    def add(f: Callable[[Tables], DataFrame]):
        assert name not in _QUERIES, name
        _QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            _SQL[name] = with_tables(sql)
        return f

    return add


def _load() -> None:
    from .plans import aggregates, flagship, html_json, joins, keys, mutations, selection, streams, texts, validation  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["flagship_publishable_leaves"](spark, sf_dir)
