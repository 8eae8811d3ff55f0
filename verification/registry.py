"""Registry of the queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from helixframe.tables import Tables
from verification import fixtures


@dataclass(frozen=True)
class Context:
    spark: SparkSession
    sf_dir: str
    tables: Tables

    def view(self, sql: str, extra: dict[str, str] | None = None) -> DataFrame:
        return fixtures.stored_view(self.spark, self.sf_dir, sql, extra)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    """Register ``fn(ctx)`` under a name, with the SQL that must give the same rows."""

    def register(fn: Callable[[Context], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Context(spark, sf_dir, fixtures.tables(spark, sf_dir)))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql:
            ORACLES[name] = fixtures.with_views(sql, extra)
        return fn

    return register
