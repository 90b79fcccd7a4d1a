"""A decorator that files queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def filing(queries: dict[str, Query], oracles: dict[str, str]) -> Callable[[str | None], Callable[[Query], Query]]:
    """``query(sql)`` files the function under its own name; without SQL only its rows can be checked."""

    def query(sql: str | None = None) -> Callable[[Query], Query]:
        def file(f: Query) -> Query:
            queries[f.__name__] = f
            if sql:
                oracles[f.__name__] = sql
            return f

        return file

    return query
