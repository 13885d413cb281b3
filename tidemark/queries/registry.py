"""Registration of queries and the readers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The input tables of one scale factor as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its equal SQL."""

    def add(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(configure(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add
