"""Registered queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """The driver tables of one folder, each read as a DataFrame on access."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str, table: str) -> DataFrame:
        """SQL that reads one of the tables; no view stays behind in the session."""
        return self.spark.sql(text.replace(f"FROM {table}", f"FROM {{{table}}}"), **{table: getattr(self, table)})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of the tables under its own name, with its SQL if any."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            SQL[build.__name__] = sql
        return build

    return register
