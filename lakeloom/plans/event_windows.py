"""Event files → rows without nulls → events per name and minute."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.sources.ingest import json_stream, parsed_rows
from lakeloom.streaming.run import run_to_table
from lakeloom.streaming.updates import read_added, run_added

SCHEMA = "event_name string, event_time timestamp"


def cleaned(raw: DataFrame) -> DataFrame:
    return raw.dropna()


def minute() -> list:
    return ["event_name", F.window("event_time", "1 minute").alias("window")]


def per_minute(events: DataFrame) -> DataFrame:
    return events.groupBy(*minute()).count()


def update(spark: SparkSession, feed: str, out: str, timeout: float | None = None) -> DataFrame:
    """Take in what has arrived and add it to the counts."""
    raw = json_stream(spark, feed, SCHEMA)
    run_to_table(raw, f"{out}/raw", f"{out}/_checkpoints/raw", timeout=timeout)
    stored = spark.readStream.schema(raw.schema).parquet(f"{out}/raw")
    run_to_table(cleaned(parsed_rows(stored)), f"{out}/clean", f"{out}/_checkpoints/clean", timeout=timeout)
    events = spark.readStream.schema(SCHEMA).parquet(f"{out}/clean")
    run_added(events, minute(), [F.count(F.lit(1)).alias("count")], f"{out}/per_minute", f"{out}/_checkpoints/per_minute", timeout)
    return read_added(spark, f"{out}/per_minute", ["event_name", "window"])
