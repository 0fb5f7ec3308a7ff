"""Retail sales: order documents and customer files → cleaned orders → product sales of some cities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.operators.quality import Rule, apply_rules
from lakeloom.sources.delimited import load_csv, read_loaded
from lakeloom.sources.ingest import json_stream, parsed_rows
from lakeloom.streaming.run import run_to_table

ORDER_SCHEMA = (
    "customer_id bigint, customer_name string, number_of_line_items bigint, order_datetime string, "
    "order_number bigint, ordered_products array<struct<id: bigint, price: double, qty: double, curr: string>>"
)
CUSTOMER_SCHEMA = (
    "customer_id bigint, customer_name string, state string, city string, units_purchased double, loyalty_segment string"
)


VALID_ORDER = [Rule("valid_order_number", "order_number IS NOT NULL", "drop")]
PLACE = ["state", "city", "units_purchased", "loyalty_segment"]


def cleaned(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Numbered orders with their time, their day and the customer's place (null where the customer isn't known).

    The customers are a table even where the orders are a stream, so the plain
    join serves both.
    """
    people = customers.select(F.col("customer_id").alias("_id"), F.col("customer_name").alias("_name"), *PLACE)
    numbered = apply_rules(orders, VALID_ORDER)
    placed = numbered.join(people, (numbered.customer_id == people._id) & (numbered.customer_name == people._name), "left")
    timed = placed.withColumn("order_datetime", F.timestamp_seconds(F.col("order_datetime").cast("bigint")))
    return timed.drop("_id", "_name").withColumn("order_date", F.to_date("order_datetime"))


def sales_in(cities: list[str], orders: DataFrame) -> DataFrame:
    """Revenue, units and the dearest line per city, currency and month of some cities."""
    local = orders.where(F.col("city").isin(cities)).withColumn("month", F.date_format("order_date", "yyyy-MM"))
    lines = local.select("month", "city", F.inline("ordered_products"))
    return lines.groupBy("city", "curr", "month").agg(
        F.sum("price").alias("revenue"), F.sum("qty").alias("units"), F.max("price").alias("dearest_line"), (F.sum("price") / F.sum("qty")).alias("mean_unit_price"))


def update(
    spark: SparkSession, order_feed: str, customer_feed: str, out: str, timeout: float | None = None
) -> DataFrame:
    """Take in both feeds; new orders meet the customers known by then."""
    load_csv(spark, customer_feed, CUSTOMER_SCHEMA, f"{out}/customers", f"{out}/_checkpoints/customers", timeout=timeout)
    customers = parsed_rows(read_loaded(spark, f"{out}/customers"))
    raw = json_stream(spark, order_feed, ORDER_SCHEMA)
    run_to_table(raw, f"{out}/bronze", f"{out}/_checkpoints/bronze", timeout=timeout)
    orders = parsed_rows(spark.readStream.schema(raw.schema).parquet(f"{out}/bronze"))
    run_to_table(cleaned(orders, customers), f"{out}/orders", f"{out}/_checkpoints/orders", timeout=timeout)
    return spark.read.parquet(f"{out}/orders")
