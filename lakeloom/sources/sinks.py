"""Writers that go beyond one call of ``DataFrameWriter``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


def replace_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """``CREATE OR REPLACE TABLE … AS SELECT`` for a catalog that refuses REPLACE."""
    df.write.format(fmt).mode("overwrite").saveAsTable(name)


def write_partitioned(df: DataFrame, path: str, columns: list[str], mode: str = "overwrite") -> None:
    """Write partition folders without small files or hot writers.

    REBALANCE groups the rows of a partition value for the writers and lets AQE
    split a value that holds much of the data. Overwriting replaces only the
    partitions the rows fall in.
    """
    (
        df.hint("rebalance", *columns)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def rewrite_partitions(
    spark: SparkSession, name: str, column: str, values: list, change: Callable[[DataFrame], DataFrame], staging: str
) -> None:
    """Apply a change to some partitions of a catalog table and leave the others unread.

    The changed rows go to ``staging`` first: the table is replaced only once
    they are whole, and a partition left without rows can be told and dropped.
    """
    table, given = spark.table(name), [v for v in values if v is not None]
    wanted = F.col(column).isin(given)
    affected = table.where(wanted | F.col(column).isNull() if len(given) < len(values) else wanted)
    change(affected).select(*table.columns).hint("rebalance", column).write.partitionBy(column).parquet(staging)
    staged = spark.read.schema(table.schema).parquet(staging)
    found = {r[0] for r in staged.select(column).distinct().limit(len(values) + 1).collect()}
    if found - set(values):
        # replacing that partition would lose the rows it holds
        raise ValueError(f"the change moves rows to other partitions of {column}")
    # a session of its own takes the setting, which this kind of insert reads from nowhere else
    writing = spark.newSession()
    writing.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    writing.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    writing.read.schema(table.schema).parquet(staging).select(*table.columns).write.mode("overwrite").insertInto(name)
    for value in set(values) - found:
        literal = "null" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({column} = {literal})")
    spark.catalog.refreshTable(name)
