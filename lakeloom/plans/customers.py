"""Customer change feed: raw files → checked changes → current customers → counts and e-mail list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.operators.joins import placed_anew
from lakeloom.operators.quality import EMAIL_PATTERN, Rule, apply_rules
from lakeloom.sources.ingest import json_stream, parsed_rows
from lakeloom.streaming.changes import apply_changes_stream, current_state
from lakeloom.streaming.run import run_to_table
from lakeloom.streaming.views import group_counts, run_group_counts

FEED_SCHEMA = (
    "customer_id bigint, name string, email string, state string, operation string, seq_us bigint, seq_id bigint"
)
RULES = [
    Rule("valid_id", "customer_id IS NOT NULL", "fail"),
    Rule("valid_operation", "operation IS NOT NULL", "drop"),
    Rule("valid_name", "name IS NOT NULL OR operation = 'DELETE'"),
    Rule("valid_state", "state IS NOT NULL OR operation = 'DELETE'"),
    Rule("valid_email", f"rlike(email, '{EMAIL_PATTERN}') OR operation = 'DELETE'", "drop"),
]
KEYS, SEQUENCE = ["customer_id"], ["seq_us", "seq_id"]


def clean(bronze: DataFrame) -> DataFrame:
    return apply_rules(bronze.drop("source_file", "processing_time"), RULES)


def counts_by_state(customers: DataFrame) -> DataFrame:
    """Customers per state, and the time of the last change to one of them."""
    return customers.groupBy("state").agg(F.count(F.lit(1)).alias("customer_count"), F.timestamp_micros(F.max("seq_us")).alias("last_change"))


def subscribed_emails(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Order and e-mail of customers who asked for notifications."""
    a = orders.where("notifications = 'Y'").alias("a")
    b = placed_anew(customers, ["customer_id"]).alias("b")
    return a.join(b, F.col("a.customer_id") == F.col("b.customer_id")).select("a.customer_id", "a.order_id", "b.email")


def update(spark: SparkSession, feed: str, out: str, timeout: float | None = None) -> DataFrame:
    """Take in what has arrived and return the customers as they now stand."""
    raw = json_stream(spark, feed, FEED_SCHEMA)
    run_to_table(raw, f"{out}/bronze", f"{out}/_checkpoints/bronze", timeout=timeout)
    stored = spark.readStream.schema(raw.schema).parquet(f"{out}/bronze")
    apply_changes_stream(clean(parsed_rows(stored)), KEYS, SEQUENCE, f"{out}/changes", f"{out}/_checkpoints/changes", timeout)
    return current_customers(spark, out)


def current_customers(spark: SparkSession, out: str) -> DataFrame:
    return current_state(spark, f"{out}/changes", KEYS, SEQUENCE, "operation = 'DELETE'", drop=["operation"])


def update_counts(spark: SparkSession, out: str, timeout: float | None = None, state_partitions: int | None = None) -> DataFrame:
    """Customers per state, brought up to date by what is new in the raw table alone."""
    stored = spark.readStream.schema(spark.read.parquet(f"{out}/bronze").schema).parquet(f"{out}/bronze")
    run_group_counts(
        clean(parsed_rows(stored)), KEYS, SEQUENCE, "state", "operation = 'DELETE'", f"{out}/moves", f"{out}/_checkpoints/moves", timeout, state_partitions)
    return group_counts(spark, f"{out}/moves", "state", "customer_count")
