"""Aggregates of a stream published as changes: a batch writes the groups it touched, and nothing else."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeloom.streaming.run import run


def run_updates(
    stream: DataFrame, target: str, checkpoint: str, timeout: float | None = None, state_partitions: int | None = None,
    state: dict[str, int] | None = None,
) -> int:
    """Append the changed groups of each batch under its id; rows read.

    A repeated batch replaces its own folder. Where ``stream`` has a watermark
    on its window, state of closed windows is dropped and their last row stays.
    """
    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return run(stream.writeStream.outputMode("update").foreachBatch(publish), checkpoint, timeout, state_partitions, state=state)


def _logged(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.option("basePath", target).parquet(target)


def read_updates(spark: SparkSession, target: str | list[str], keys: list[str]) -> DataFrame:
    """Every group as last published, from one log or several (a compacted one and the one that goes on growing)."""
    rows = None
    for log in [target] if isinstance(target, str) else target:
        rows = _logged(spark, log) if rows is None else rows.unionByName(_logged(spark, log))
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("last"))
    return last.select(*keys, *(F.col("last")[c].alias(c) for c in rest))


def rows_per_batch(spark: SparkSession, target: str) -> DataFrame:
    """What each batch has cost: rows written."""
    return _logged(spark, target).groupBy("batch").agg(F.count(F.lit(1)).alias("rows_written"))


def compact_updates(spark: SparkSession, target: str | list[str], compacted: str, keys: list[str]) -> None:
    """Write the last row of every group to a new log. Batches written before may then be removed."""
    logs = [target] if isinstance(target, str) else target
    newest = max(_logged(spark, log).agg(F.max("batch")).first()[0] for log in logs)
    read_updates(spark, logs, keys).write.mode("errorifexists").parquet(f"{compacted}/batch={newest}")


def run_added(
    stream: DataFrame, keys: list[str | Column], aggregates: list[Column], target: str, checkpoint: str, timeout: float | None = None
) -> int:
    """Append what each batch alone adds to the groups it touches, under its id; rows read.

    For counts and sums: it takes no state, and a batch costs what it holds.
    """
    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy(*keys).agg(*aggregates).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return run(stream.writeStream.foreachBatch(publish), checkpoint, timeout)


def read_added(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """Every group with the sums over all batches."""
    rows = _logged(spark, target).drop("batch")
    return rows.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in rows.columns if c not in keys))
