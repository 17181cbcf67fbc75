"""The registry of queries and of the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..relation import Relation
from ..session import Connection

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def register(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query ``(spark, sf_dir) -> DataFrame``, with SQL that gives the same rows."""

    def put(f: Query) -> Query:
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = f
        if sql is not None:
            ORACLES[key] = sql
        return f

    return put


def both(name: str, sql: str, oracle: str | None = None) -> None:
    """Register SQL of the relational dialect, run through a connection; its twin is the same text
    or ``oracle``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return connection(spark, sf_dir).sql(sql).dataframe

    run.__name__ = name
    register(oracle or sql, name)(run)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rel(spark: SparkSession, sf_dir: str, name: str) -> Relation:
    return Relation(table(spark, sf_dir, name), name)


class _Tables(Connection):
    """A connection in which the tables of a folder are views, made as they are named."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__(spark)
        self._folder = sf_dir

    def _one(self, sql: str, params: Any, depth: int) -> Relation:
        for name in TABLES:
            if re.search(rf"\b{name}\b", sql):
                table(self.spark, self._folder, name).createOrReplaceTempView(name)
        return super()._one(sql, params, depth + 1)


def connection(spark: SparkSession, sf_dir: str) -> Connection:
    return _Tables(spark, sf_dir)
