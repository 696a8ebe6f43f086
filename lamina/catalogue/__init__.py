"""The operators and layers bound to the given tables, each with its SQL twin.

Every module defines ``QUERIES`` (name -> callable of session and folder) and
``SQL`` (name -> equivalent DuckDB statement, where there is one).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lamina.session import configure, size_shuffles
from lamina.sources.folders import size

Query = Callable[[SparkSession, str], DataFrame]


def _configured(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        size_shuffles(configure(spark), size(spark, folder))
        return query(spark, folder)

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def all_queries() -> dict[str, Query]:
    from lamina.catalogue import cells, changes, files, relations, star

    modules = (cells, relations, star, changes, files)
    return {name: _configured(q) for m in modules for name, q in m.QUERIES.items()}


def all_sql() -> dict[str, str]:
    from lamina.catalogue import cells, changes, files, relations, star

    return {name: sql for m in (cells, relations, star, changes, files) for name, sql in m.SQL.items()}
