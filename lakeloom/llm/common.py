"""What several of these operators share: word and space patterns, saved tables, registration."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeloom.session import scratch_dir

#: White space in the sense of the contracts, and a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Whether an execution's shuffle files go when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a query ``fn(spark, sf_dir)`` and its SQL, if it has one."""

    def register(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there.

    What the write shuffled is let go with it, and doesn't wait on the disks for the driver's next garbage collection.
    """
    spark = df.sparkSession
    path, usual = scratch_dir(spark, name), spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, usual)
    return spark.read.schema(df.schema).parquet(path)


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with the place of each row, ``_path`` and ``_row``, which is the same in every pass.

    A frame that isn't a plain scan of parquet files is written to the shared folder first.
    """
    place = (F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))
    try:
        return docs.select("*", *place)
    except AnalysisException:
        return saved(docs, "rows").select("*", *place)


def whole(docs: DataFrame) -> DataFrame:
    """Every row as one struct ``_all`` beside its place, so that no column of ``docs`` can clash with a helper's."""
    return located(docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("_all")))


def fields(rows: DataFrame, *names: str) -> DataFrame:
    """Columns of the rows that ``whole`` gave."""
    return rows.select(*(F.col(f"_all.`{n}`").alias(n) for n in names))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def filled(text: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text), F.lit(""))
