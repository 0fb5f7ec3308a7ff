"""Order status feed: raw files → recent status rows → rows with the e-mail to notify."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.operators.quality import Rule, apply_rules, record_counts, record_start
from lakeloom.sources.ingest import json_stream, parsed_rows
from lakeloom.streaming.run import run_to_table

FEED_SCHEMA = "order_id bigint, order_status string, status_timestamp bigint"


def rules(since: int) -> list[Rule]:
    return [Rule("valid_timestamp", f"status_timestamp > {since}", "drop"), Rule("known_status", "order_status IN ('O', 'F')")]


def silver(bronze: DataFrame, since: int) -> DataFrame:
    """Status rows after ``since`` (epoch seconds); older ones are dropped, unusual states only counted."""
    return apply_rules(bronze.drop("source_file"), rules(since), "status_silver" if bronze.isStreaming else None)


def email_updates(status: DataFrame, emails: DataFrame) -> DataFrame:
    a, b = status.alias("a"), emails.alias("b")
    return a.join(b, F.col("a.order_id") == F.col("b.order_id")).select("a.*", "b.email")


def update(spark: SparkSession, feed: str, out: str, since: int, timeout: float | None = None) -> DataFrame:
    """Take in what has arrived; the status rows so far."""
    update_id = uuid.uuid4().hex
    record_start(spark, f"{out}/event_log", "status_silver", ["status_bronze"], update_id)
    raw = json_stream(spark, feed, FEED_SCHEMA)
    run_to_table(raw, f"{out}/bronze", f"{out}/_checkpoints/bronze", timeout=timeout)
    stored = spark.readStream.schema(raw.schema).parquet(f"{out}/bronze")
    seen: dict[str, dict[str, int]] = {}
    run_to_table(silver(parsed_rows(stored), since), f"{out}/silver", f"{out}/_checkpoints/silver", timeout=timeout, observed=seen)
    record_counts(spark, f"{out}/event_log", "status_silver", rules(since), seen.get("status_silver", {}), update_id)
    return spark.read.parquet(f"{out}/silver")
