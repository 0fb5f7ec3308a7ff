"""Orders feed: raw files → checked orders → orders per day."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from lakeloom.operators.quality import Rule, apply_rules, record_counts
from lakeloom.sources.files import with_provenance
from lakeloom.sources.ingest import file_stream, parsed_rows, raw_schema, rescue_json
from lakeloom.streaming.run import run_batches
from lakeloom.streaming.updates import read_added

FEED_SCHEMA = "order_id bigint, customer_id bigint, order_timestamp bigint, notifications string"
RULES = [Rule("valid_date", "order_timestamp > timestamp'1990-01-01'", "fail")]


def silver(bronze: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Orders with a typed timestamp; an order dated before the shop opened stops the update."""
    typed = bronze.withColumn("order_timestamp", F.timestamp_seconds("order_timestamp"))
    return apply_rules(typed.drop("source_file"), RULES, seen)


def by_date(orders: DataFrame) -> DataFrame:
    daily = orders.groupBy(F.to_date("order_timestamp").alias("order_date"))
    return daily.agg(F.count("*").alias("total_daily_orders"))


def update(spark: SparkSession, feed: str, out: str, timeout: float | None = None) -> DataFrame:
    """Take in what has arrived and extend all three tables by it; the daily counts are the sum of what each batch added.

    A batch writes its part of every table under its id, each from the part
    before it. One that fails, or comes again, replaces what it had written.
    """
    counts: list[dict[str, int]] = []

    def extend(batch: DataFrame, batch_id: int) -> None:
        here, seen = batch.sparkSession, Observation()
        bronze, checked, daily = (f"{out}/{name}/batch={batch_id}" for name in ("bronze", "silver", "daily"))
        rescue_json(batch, raw_schema(FEED_SCHEMA)).write.mode("overwrite").parquet(bronze)
        silver(parsed_rows(here.read.parquet(bronze)), seen).write.mode("overwrite").parquet(checked)
        by_date(here.read.parquet(checked)).write.mode("overwrite").parquet(daily)
        counts.append(seen.get)

    run_batches(with_provenance(file_stream(spark, feed, "text", "value string")), extend, f"{out}/_checkpoints/orders", timeout)
    total = {name: sum(c[name] for c in counts) for c in counts[:1] for name in c}
    record_counts(spark, f"{out}/event_log", "orders_silver", RULES, total, uuid.uuid4().hex)
    return read_added(spark, f"{out}/daily", ["order_date"])
