"""Batch jobs on shop tables: abandoned carts, click paths, clean users, ping report, delivery clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.operators.joins import outer_join_unique

# -- abandoned carts ------------------------------------------------------------


def conversions(users: DataFrame, sales: DataFrame) -> DataFrame:
    """Every e-mail of a user or a sale, and whether it bought."""
    # rows without the key meet nothing and are not wanted: drop them before they share one partition
    converted = sales.select("email").dropna().distinct().withColumn("converted", F.lit(True))
    return outer_join_unique(users.dropna(subset=["email"]), converted, "email").na.fill(False, ["converted"])


def cart_items(events: DataFrame) -> DataFrame:
    """Distinct (user_id, item_id) of the carts: the set per user as rows, so no cart grows into one value."""
    items = events.select("user_id", F.explode("items").alias("item"))
    return items.select("user_id", F.col("item.item_id").alias("item_id")).distinct()


def abandoned_items(users: DataFrame, sales: DataFrame, events: DataFrame) -> DataFrame:
    """Users per item left in the cart of someone who bought nothing."""
    left = conversions(users, sales).where(~F.col("converted")).select("user_id", "email")
    carts = left.join(cart_items(events), "user_id")
    return carts.groupBy("item_id").count().sort("item_id")


def abandoned_cart_stages(users: DataFrame, sales: DataFrame, events: DataFrame) -> DataFrame:
    """Rows after each stage, one row per stage."""
    people = conversions(users, sales)
    carts = cart_items(events).groupBy("user_id").agg(F.count("*").alias("cart_size"))
    joined = people.join(carts, "user_id", "left")
    counts = joined.agg(
        F.count("*").alias("users"),
        F.count_if(~F.col("converted")).alias("not_converted"),
        F.count_if(F.col("cart_size").isNull()).alias("without_cart"),
        F.count_if(~F.col("converted") & F.col("cart_size").isNotNull()).alias("abandoned"),
    )
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("stage"), F.col(c).alias("rows")) for c in counts.columns
    ])))


# -- click paths ----------------------------------------------------------------


def events_pivot(events: DataFrame, names: list[str]) -> DataFrame:
    """Events per user, one column per name."""
    return events.groupBy(F.col("user_id").alias("user")).pivot("event_type", names).count().na.fill(0, names)


def click_paths(events: DataFrame, names: list[str], transactions: DataFrame, buyer: str) -> DataFrame:
    paths = events_pivot(events, names)
    return paths.join(transactions, paths.user == F.col(buyer))


# -- clean users ----------------------------------------------------------------


def clean_users(dirty: DataFrame, first_seen_us: Column) -> DataFrame:
    """One row per user with the e-mail that is known, plus date, time and mail domain."""
    known = (
        dirty.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.max("email").alias("email"), F.max(first_seen_us).alias("first_us"))
    )
    seen = F.timestamp_micros("first_us")
    return known.select(
        "user_id", "email",
        F.date_format(seen, "MMM d, yyyy").alias("first_touch_date"),
        F.date_format(seen, "HH:mm:ss").alias("first_touch_time"),
        F.regexp_extract("email", "(?<=@).+", 0).alias("email_domain"),
    )


def is_unique(df: DataFrame, column: str) -> DataFrame:
    """One row: whether no value of the column repeats."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("row_count"))
    return counts.agg((F.coalesce(F.max("row_count"), F.lit(0)) <= 1).alias("no_duplicates"))


# -- ping report ----------------------------------------------------------------


def ping_report(pings: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records per user and hour of the day, mean and spread per user and three minutes, and a summary per user."""
    hours = pings.groupBy("user_id", F.hour("time").alias("hour")).agg(F.count("*").alias("records"))
    three = pings.groupBy("user_id", F.window("time", "3 minutes").alias("w")).agg(
        F.mean("ping").alias("mean_ping"), (F.max("ping") - F.min("ping")).alias("spread"))
    summary = pings.groupBy("user_id").agg(
        F.min("time").alias("since"), F.max("time").alias("until"), F.mean("ping").alias("mean_ping"), F.max("ping").alias("worst_ping"))
    return hours, three.select("user_id", F.col("w.start").alias("since"), "mean_ping", "spread"), summary


# -- deliveries (flights) ---------------------------------------------------------


def clean_flights(raw: DataFrame) -> DataFrame:
    """Flights that weren't diverted, with typed flags and the delay label.

    A flight is late if it was cancelled or came in a quarter of an hour late or
    more. Rows that lack the delay or a flag are left out.
    """
    cancelled, diverted = (F.col(c).cast("boolean") for c in ("cancelled", "diverted"))
    flown = raw.where(~diverted & cancelled.isNotNull() & F.col("arr_delay").isNotNull())
    others = [c for c in raw.columns if c not in ("cancelled", "diverted")]
    late = cancelled | (F.col("arr_delay") >= 15)
    return flown.select(*others, cancelled.alias("cancelled_flag"), diverted.alias("diverted_flag"), late.alias("delay15_flag"))
