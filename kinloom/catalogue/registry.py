"""Registration of queries and access to the input tables."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import identity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

AS_OF = "2024-02-01T00:00:00Z"

_MODULES = ["resolution", "tables", "scalars", "sources_sinks", "matching", "enrichment", "growing", "storekeeping", "observing"]


class Source:
    """The input tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def ident(self) -> DataFrame:
        return identity.ident(self.table("events"))

    def store(self) -> DataFrame:
        return identity.store(self.ident())

    def batch(self) -> DataFrame:
        return identity.batch(self.ident())


def query(name: str, sql: str | None = None, ident: bool = False):
    """Register ``fn(source) -> DataFrame``; ``ident`` puts the identity views
    in front of the SQL text."""

    def register(fn: Callable[[Source], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Source(spark, folder))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = identity.with_ident(sql) if ident else sql
        return fn

    return register


def load_all() -> None:
    for module in _MODULES:
        importlib.import_module(f"{__package__}.{module}")
