"""Where queries and their SQL forms are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
OPERATOR: dict[str, str] = {}


def query(operator: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its own name.

    ``operator`` is the inventory number. Without ``sql`` the result has no form
    that DuckDB can run.
    """

    def register(fn):
        QUERIES[fn.__name__] = fn
        OPERATOR[fn.__name__] = operator
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register
