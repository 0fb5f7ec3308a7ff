"""Registry of the queries and of the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a query ``fn(spark, sf_dir)`` and its SQL, if it has one."""

    def register(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(value: Column) -> Column:
    """A mean to four places, for comparison with the SQL's.

    A hair is added first: a mean that lies exactly between two roundings would
    else fall either way with the order of summation.
    """
    return F.round(value + 1e-9, 4)
