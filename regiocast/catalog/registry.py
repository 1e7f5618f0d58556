"""Registry of named queries: inventory rows covered, Spark builder, check statement."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from regiocast.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


QUERIES: dict[str, Query] = {}


def register(name: str, covers: str, sql: str | None = None):
    """Decorator: add a builder ``Tables -> DataFrame`` under ``name``."""
    def wrap(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(name, tuple(covers.split()), build, sql)
        return build
    return wrap
