"""The registered queries of the library, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder, read as they are asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet")


    def stream(self, name: str) -> DataFrame:
        """A table as a stream of its files. The path is a pattern, so that it may be one file or a folder."""
        return self.spark.readStream.schema(getattr(self, name).schema).parquet(f"{self._folder}/{name}.parque[t]")


def query(sql: str | None = None):
    """Registers a function of Tables under its name."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register
