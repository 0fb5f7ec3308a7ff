"""A change feed applied as a stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from lakeloom.operators.changes import apply_changes, latest_by
from lakeloom.streaming.run import run_batches


def apply_changes_stream(
    changes: DataFrame, keys: list[str], sequence: list[str], log: str, checkpoint: str,
    timeout: float | None = None,
) -> int:
    """Append each batch's last change per key to a log table.

    Deletes stay in the log with their sequence, so a late older row cannot
    bring a deleted key back. A batch costs what it holds, not the whole state.
    """
    def keep_last(batch: DataFrame, batch_id: int) -> None:
        latest_by(batch, keys, sequence).write.mode("overwrite").parquet(f"{log}/batch={batch_id}")

    return run_batches(changes, keep_last, checkpoint, timeout)


def _read_logs(spark: SparkSession, logs: list[str]) -> DataFrame:
    parts = [spark.read.option("basePath", log).parquet(log).drop("batch") for log in logs]
    return reduce(lambda a, b: a.unionByName(b), parts)


def current_state(
    spark: SparkSession, log: str | list[str], keys: list[str], sequence: list[str], delete_when,
    drop: list[str] = (),
) -> DataFrame:
    """The table the feed describes, from one log or several.

    A change that stands in two logs counts once, so a compacted log can be
    read together with the one that goes on growing.
    """
    rows = _read_logs(spark, [log] if isinstance(log, str) else log)
    return apply_changes(rows, keys, sequence, delete_when, drop)


def compact_log(
    spark: SparkSession, log: str | list[str], target: str, keys: list[str], sequence: list[str]
) -> None:
    """Write the logs reduced to one row per key (deletes kept) to a new folder.

    Batches written before the compaction may then be removed.
    """
    rows = _read_logs(spark, [log] if isinstance(log, str) else log)
    latest_by(rows, keys, sequence).write.mode("errorifexists").parquet(f"{target}/batch=0")
