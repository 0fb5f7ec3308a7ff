"""Shop, feed and clinic tables derived from the given tables.

Each function has a SQL twin for the checks, under the same name in capitals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.operators.nesting import pack_rows
from lakeloom.suite.base import table


def email_of(name: str = "c_name", segment: str = "c_mktsegment"):
    return F.concat(
        F.lower(F.regexp_replace(name, "#", "")), F.lit("@"), F.lower(F.col(segment)), F.lit(".com")
    )


EMAIL = "lower(replace(c_name, '#', '')) || '@' || lower(c_mktsegment) || '.com'"


def users(spark: SparkSession, sf: str) -> DataFrame:
    """user_id, email, balance, nation_id."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"),
        email_of().alias("email"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("nation_id"),
    )


USERS = f"""users AS (SELECT c_custkey AS user_id, {EMAIL} AS email,
    c_acctbal AS balance, c_nationkey AS nation_id FROM customer)"""


def users_dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Users with repeated rows that lack the e-mail, and rows without a key."""
    clean = users(spark, sf).select("user_id", "email", "balance")
    repeated = clean.where("balance < 0").withColumn("email", F.lit(None).cast("string"))
    keyless = table(spark, sf, "supplier").where("s_acctbal < 0").select(
        F.lit(None).cast("bigint").alias("user_id"),
        F.lit(None).cast("string").alias("email"),
        F.col("s_acctbal").alias("balance"),
    )
    return clean.union(repeated).union(keyless)


USERS_DIRTY = f"""{USERS}, users_dirty AS (
    SELECT user_id, email, balance FROM users
    UNION ALL SELECT user_id, NULL, balance FROM users WHERE balance < 0
    UNION ALL SELECT NULL, NULL, s_acctbal FROM supplier WHERE s_acctbal < 0)"""


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """order_id, email, ordered_at, revenue, status, priority."""
    orders = table(spark, sf, "orders")
    people = table(spark, sf, "customer").select("c_custkey", email_of().alias("email"))
    return orders.join(people, orders.o_custkey == people.c_custkey).select(
        F.col("o_orderkey").alias("order_id"),
        "email",
        F.col("o_orderdate").alias("ordered_at"),
        F.col("o_totalprice").alias("revenue"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )


SALES = f"""sales AS (SELECT o_orderkey AS order_id, {EMAIL} AS email, o_orderdate AS ordered_at,
    o_totalprice AS revenue, o_orderstatus AS status, o_orderpriority AS priority
    FROM orders JOIN customer ON o_custkey = c_custkey)"""


def places(spark: SparkSession, sf: str) -> DataFrame:
    """Users with a nested place: user_id, email, geo(city, state)."""
    customer = table(spark, sf, "customer")
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region")
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("c_custkey").alias("user_id"),
            email_of().alias("email"),
            F.col("c_acctbal").alias("balance"),
            F.struct(F.col("n_name").alias("city"), F.col("r_name").alias("state")).alias("geo"),
        )
    )


PLACES = f"""places AS (SELECT c_custkey AS user_id, {EMAIL} AS email, c_acctbal AS balance,
    n_name AS city, r_name AS state
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def sales_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of orders with their items nested; (order_id, pack) is the key, n_items the order's line count.

    order_id, pack, n_items, items array<struct<item_id, price, qty, curr>>.
    """
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("qty"),
        F.when(F.col("l_linestatus") == "O", "USD").otherwise("EUR").alias("curr"),
    )
    return pack_rows(lines, ["order_id"], ["item_id", "price", "qty", "curr"], "items")


ITEMS = """items AS (SELECT l_orderkey AS order_id, l_partkey AS item_id, l_extendedprice AS price,
    l_quantity AS qty, CASE WHEN l_linestatus = 'O' THEN 'USD' ELSE 'EUR' END AS curr FROM lineitem)"""


def change_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Customer change feed: customer_id, name, email, state, operation, seq_us, seq_id.

    A delete carries only key, operation and sequence. Some updates hold a
    broken e-mail and some rows no operation, so that the rules have work.
    """
    events = table(spark, sf, "events")
    people = table(spark, sf, "customer")
    k = F.get_json_object("props", "$.k").cast("int")
    operation = (
        F.when((F.col("event_type") == "view") & (k == 0), F.lit(None))
        .when(F.col("event_type") == "signup", "INSERT")
        .when(F.col("event_type") == "error", "DELETE")
        .otherwise("UPDATE")
    )
    gone = F.col("event_type") == "error"
    joined = events.join(people, events.user_id == people.c_custkey)
    return joined.select(
        F.col("user_id").alias("customer_id"),
        F.when(~gone, F.col("c_name")).alias("name"),
        F.when(~gone & (k < 5), F.lit("unknown")).when(~gone, email_of()).alias("email"),
        F.when(~gone, F.concat(F.lit("S"), (k % 10).cast("string"))).alias("state"),
        operation.alias("operation"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("seq_us"),
        F.col("event_id").alias("seq_id"),
    )


CHANGE_FEED = f"""feed0 AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events
    JOIN customer ON user_id = c_custkey),
change_feed AS (SELECT user_id AS customer_id,
    CASE WHEN event_type <> 'error' THEN c_name END AS name,
    CASE WHEN event_type <> 'error' AND k < 5 THEN 'unknown' WHEN event_type <> 'error' THEN {EMAIL} END AS email,
    CASE WHEN event_type <> 'error' THEN 'S' || CAST(k % 10 AS VARCHAR) END AS state,
    CASE WHEN event_type = 'view' AND k = 0 THEN NULL WHEN event_type = 'signup' THEN 'INSERT'
         WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPDATE' END AS operation,
    epoch_us(ts) AS seq_us, event_id AS seq_id FROM feed0)"""
