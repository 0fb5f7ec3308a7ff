"""Windows over event time whose state is bounded by a watermark, each published once when it is closed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def closed_windows(
    events: DataFrame, time: str, keys: list[str | Column], window: str, aggregates: list[Column], lateness: str
) -> DataFrame:
    """Aggregates per key and tumbling window, to be written in append mode.

    A window is closed, goes out and leaves the state once an event arrives that
    is ``lateness`` younger than its end; a row for a closed window is late and
    counts nowhere. The count of a window's rows, ``rows``, is always among the aggregates.
    """
    grouped = events.withWatermark(time, lateness).groupBy(*keys, F.window(time, window).alias("window"))
    return grouped.agg(F.count(F.lit(1)).alias("rows"), *aggregates)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows a query of ``closed_windows`` still holds in its state: their keys, window and ``rows``."""
    held = spark.read.format("statestore").load(checkpoint)
    # the row count is the first aggregate, so the first field of the state's value
    count = held.schema["value"].dataType.names[0]
    return held.select("key.*", F.col("value")[count].alias("rows"))


def window_report(spark: SparkSession, target: str, checkpoint: str, arrived: int) -> DataFrame:
    """One row that accounts for all rows that arrived: ``published`` in closed windows, ``waiting`` in
    open ones, ``late`` apart; and the number of closed and open windows."""
    closed = spark.read.parquet(target).select("rows", F.lit(True).alias("closed"))
    both = closed.unionByName(open_windows(spark, checkpoint).select("rows", F.lit(False).alias("closed")))
    total = both.agg(
        F.count_if("closed").alias("closed_windows"), F.count_if(~F.col("closed")).alias("open_windows"),
        *(F.coalesce(F.sum(F.when(F.col("closed") == flag, F.col("rows"))), F.lit(0)).alias(name) for name, flag in (("published", True), ("waiting", False))))
    late = F.lit(arrived).cast("bigint") - F.col("published") - F.col("waiting")
    return total.select(F.lit(arrived).cast("bigint").alias("arrived"), "published", "waiting", late.alias("late"), "closed_windows", "open_windows")
