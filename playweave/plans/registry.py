"""Where queries and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playweave.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, table reader) under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, d: f(spark, lambda name: table(spark, d, name))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


#: A text without the blanks of any kind around it, in SQL.
def trimmed_sql(c: str) -> str:
    return rf"regexp_replace({c}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
