"""Registry of runnable queries: a Spark function and, where SQL can say it, the same thing in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Input tables of one data folder, read lazily: t.orders, t.customer, ..."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register `name`; `sql` is the oracle text, or None where SQL cannot express the query."""
    def wrap(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, build, sql)
        return build
    return wrap
