"""Queries by name, each with the SQL that gives the same rows, where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: In SQL texts: STRIP(x) and similar shorthands.
_STRIP = r"regexp_replace({}, '^[\s\x{{00a0}}\x{{3000}}]+|[\s\x{{00a0}}\x{{3000}}]+$', '', 'g')"


def strip_sql(x: str) -> str:
    return _STRIP.format(x)


def query(sql: str | None = None) -> Callable:
    """Register a function of (table reader) under its name; it gets a function from table name to DataFrame."""

    def register(f: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        run.__name__ = f.__name__
        run.__doc__ = f.__doc__
        QUERIES[f.__name__] = run
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register
