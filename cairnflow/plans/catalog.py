"""A catalogue of queries with the SQL each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Register a function under its own name; a name that is taken is an error."""

        def register(f: Query) -> Query:
            if f.__name__ in self.queries:
                raise ValueError(f"query {f.__name__} exists")
            self.queries[f.__name__] = f
            if sql is not None:
                self.sql[f.__name__] = sql
            return f

        return register
