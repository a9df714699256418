"""The registered queries and the SQL of each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str, views: str = ""):
    """Register a query under its name with its SQL; ``views`` are put before it."""

    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = f"WITH RECURSIVE {views}{sql}" if views else sql
        return f

    return add
