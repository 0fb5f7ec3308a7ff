"""Running a stream over what has arrived, and publishing its results as tables."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

PARTITIONS = "spark.sql.shuffle.partitions"


def finish(
    query: StreamingQuery, timeout: float | None = None, observed: dict[str, dict[str, int]] | None = None,
    state: dict[str, int] | None = None,
) -> int:
    """Wait for an available-now query; rows read. Past the timeout, stop it and fail.

    ``observed`` takes the sums over all batches of what ``DataFrame.observe`` counted, by name.
    ``state`` takes ``rows``, the rows that the stateful operators hold after the last batch.
    """
    deadline = time.monotonic() + timeout if timeout else float("inf")
    rows: dict[int, int] = {}
    counts: dict[tuple[str, int], dict[str, int]] = {}
    done = False
    while not done:
        done = query.awaitTermination(min(2.0, max(0.1, deadline - time.monotonic())))
        # Spark keeps the last progress reports only, so they are gathered on the way
        for progress in query.recentProgress:
            rows[progress.batchId] = max(progress.numInputRows, rows.get(progress.batchId, 0))
            counts |= {(name, progress.batchId): row.asDict() for name, row in progress.observedMetrics.items()}
        if not done and time.monotonic() >= deadline:
            query.stop()
            raise TimeoutError(f"stream still running after {timeout} s")
    if state is not None and query.lastProgress:
        state["rows"] = sum(operator.numRowsTotal for operator in query.lastProgress.stateOperators)
    if observed is not None:
        for (name, _), found in counts.items():
            total = observed.setdefault(name, {})
            for k, v in found.items():
                total[k] = total.get(k, 0) + (v or 0)
    return sum(rows.values())


def run(
    writer: DataStreamWriter, checkpoint: str, timeout: float | None = None, state_partitions: int | None = None,
    observed: dict[str, dict[str, int]] | None = None, state: dict[str, int] | None = None,
) -> int:
    """Process everything that has arrived since the checkpoint, then end.

    The first run of a stateful query fixes its number of state partitions in
    the checkpoint, and each one is a store opened in every batch.
    ``state_partitions`` sets it; else it is the session's shuffle partitions.
    """
    due = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if state_partitions is None:
        return finish(due.start(), timeout, observed, state)
    conf = SparkSession.active().conf
    usual = conf.get(PARTITIONS)
    conf.set(PARTITIONS, str(state_partitions))
    try:
        query = due.start()  # the query keeps a copy of the settings
    finally:
        conf.set(PARTITIONS, usual)
    return finish(query, timeout, observed, state)


def run_to_table(
    stream: DataFrame, target: str, checkpoint: str, partition_by: list[str] = (), timeout: float | None = None,
    state_partitions: int | None = None, observed: dict[str, dict[str, int]] | None = None, state: dict[str, int] | None = None,
) -> int:
    """Append a stream to a parquet table, each input row once; rows read."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", target)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return run(writer, checkpoint, timeout, state_partitions, observed, state)


def run_to_view(
    spark: SparkSession, stream: DataFrame, view: str, target: str, checkpoint: str, timeout: float | None = None
) -> int:
    """Append a stream to a table and show the table under a view name; rows read.

    Plays the part of a memory sink, without bringing the rows to the driver.
    """
    rows = run_to_table(stream, target, checkpoint, timeout=timeout)
    spark.read.parquet(target).createOrReplaceTempView(view)
    return rows


def run_complete(
    stream: DataFrame, target: str, checkpoint: str, timeout: float | None = None, state_partitions: int | None = None
) -> int:
    """Publish the full aggregate after each batch, in two folders by turns.

    While one is replaced the other holds the last whole result, and a repeated
    batch replaces its own folder: a lost job leaves neither gap nor duplicates.
    What readers take is named by a note that is written when a folder is whole.
    """
    def publish(batch: DataFrame, batch_id: int) -> None:
        slot = batch_id % 2
        batch.write.mode("overwrite").parquet(f"{target}/slot={slot}")
        note = batch.sparkSession.range(1).select(F.lit(batch_id).cast("long").alias("batch"))
        note.coalesce(1).write.mode("overwrite").parquet(f"{target}-whole/slot={slot}")

    writer = stream.writeStream.outputMode("complete").foreachBatch(publish)
    return run(writer, checkpoint, timeout, state_partitions)


def read_complete(spark: SparkSession, target: str) -> DataFrame:
    """The aggregate as last published whole by ``run_complete``; a folder that is being replaced isn't looked at."""
    newest = spark.read.schema("batch long, slot int").option("basePath", f"{target}-whole").parquet(f"{target}-whole").agg(F.max("batch")).first()[0]
    return spark.read.parquet(f"{target}/slot={newest % 2}")


def run_batches(
    stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, timeout: float | None = None
) -> int:
    """Hand each batch to ``work(batch, batch_id)``.

    A failed batch does not move the checkpoint and is handed over again, so
    ``work`` must be repeatable: write under the batch id, in overwrite mode.
    """
    return run(stream.writeStream.foreachBatch(work), checkpoint, timeout)


def stop_all(spark: SparkSession, timeout: float = 60, queries: list[StreamingQuery] | None = None) -> None:
    """Stop the given queries, or every active one of the session, and wait for their end."""
    for query in spark.streams.active if queries is None else queries:
        query.stop()
        query.awaitTermination(timeout)
