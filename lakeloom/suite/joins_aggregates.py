"""Batch joins, aggregates, pivots and time windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators.changes import apply_changes, insert_missing
from lakeloom.operators.joins import outer_join_unique
from lakeloom.operators.nesting import collect_distinct
from lakeloom.session import scratch_dir
from lakeloom.suite.base import query, settled, table
from lakeloom.suite.standins import (
    CHANGE_FEED, ITEMS, PLACES, SALES, USERS, change_feed, places, sales, sales_documents, users,
)

PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

# -- joins --------------------------------------------------------------------


@query("J01_inner_shared_column", f"""WITH {USERS}, {SALES} SELECT order_id, email, user_id, revenue
    FROM sales JOIN users USING (email)""")
def inner_shared_column(spark, sf):
    people = users(spark, sf).select("user_id", "email")
    return sales(spark, sf).join(people, on=["email"], how="inner").select("order_id", "email", "user_id", "revenue")


@query("J02_inner_expression", f"""WITH {PLACES} SELECT s_suppkey, n.n_nationkey, count(user_id) AS buyers
    FROM places p JOIN nation n ON p.city = n.n_name JOIN supplier s ON s.s_nationkey = n.n_nationkey
    GROUP BY s_suppkey, n.n_nationkey""")
def inner_expression(spark, sf):
    # buyers are counted per nation before they meet the suppliers: no pairs of buyer and supplier
    nation, supplier = table(spark, sf, "nation"), table(spark, sf, "supplier")
    buyers = places(spark, sf).groupBy("geo.city").agg(F.count("user_id").alias("buyers"))
    at_home = buyers.join(nation, buyers.city == nation.n_name)
    return at_home.join(supplier, at_home.n_nationkey == supplier.s_nationkey).select(
        "s_suppkey", "n_nationkey", "buyers"
    )


@query("J03_full_outer", f"""WITH {USERS}, {SALES},
    buyers AS (SELECT DISTINCT email, TRUE AS converted FROM sales WHERE status = 'F' AND priority = '1-URGENT')
    SELECT email, user_id, coalesce(converted, FALSE) AS converted FROM users FULL JOIN buyers USING (email)
    WHERE email IS NOT NULL""")
def full_outer(spark, sf):
    buyers = (
        sales(spark, sf).where("status = 'F' AND priority = '1-URGENT'").select("email").distinct()
        .withColumn("converted", F.lit(True))
    )
    people = users(spark, sf).select("email", "user_id")
    return outer_join_unique(people, buyers, "email").filter(F.col("email").isNotNull()).na.fill(False)


@query("J04_left_outer", """SELECT o_orderkey, o_orderstatus, coalesce(n, 0) AS n_lines FROM orders
    LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""")
def left_outer(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    orders = table(spark, sf, "orders")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select(
        "o_orderkey", "o_orderstatus", F.coalesce("n", F.lit(0)).alias("n_lines")
    )


@query("J06_right_semi_anti", """
    SELECT 'right' AS kind, count(*) AS n FROM (SELECT DISTINCT l_orderkey FROM lineitem) RIGHT JOIN orders ON l_orderkey = o_orderkey
    UNION ALL SELECT 'semi', count(*) FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    UNION ALL SELECT 'anti', count(*) FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def right_semi_anti(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    shipped = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k")).distinct()

    def counted(kind, df):
        return df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")

    return (
        counted("right", shipped.join(orders, "k", "right"))
        .union(counted("semi", orders.join(shipped, "k", "left_semi")))
        .union(counted("anti", orders.join(shipped, "k", "left_anti")))
    )


@query("J08_alias_join", f"""WITH {USERS} SELECT a.o_orderkey, a.o_custkey, b.email FROM orders a
    JOIN users b ON a.o_custkey = b.user_id WHERE a.o_orderpriority = '1-URGENT'""")
def alias_join(spark, sf):
    a = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_custkey").alias("a")
    b = users(spark, sf).alias("b")
    return a.join(b, F.col("a.o_custkey") == F.col("b.user_id")).select("a.*", "b.email")


@query("J09_insert_only", """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' OR o_totalprice > 250000""")
def insert_only(spark, sf):
    orders = table(spark, sf, "orders")
    loaded = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    arriving = orders.where("o_totalprice > 250000").select("o_orderkey", "o_totalprice")
    return insert_missing(loaded, arriving, ["o_orderkey"])


# -- aggregates ---------------------------------------------------------------


@query("A01_group_count", 'SELECT event_type, count(*) AS "count" FROM events GROUP BY event_type')
def group_count(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").count()


@query("A02_group_nested_key", f"""WITH {PLACES} SELECT state, round(avg(balance) + 1e-9, 4) AS avg_balance,
    round(sum(balance), 2) AS sum_balance, CAST(sum(user_id) AS BIGINT) AS sum_id FROM places GROUP BY state""")
def group_nested_key(spark, sf):
    grouped = places(spark, sf).groupBy("geo.state")
    sums = grouped.agg(F.avg("balance"), F.sum("balance"), F.sum("user_id")).toDF("state", "a", "s", "i")
    return sums.select("state", settled(F.col("a")).alias("avg_balance"), F.round("s", 2).alias("sum_balance"),
                       F.col("i").alias("sum_id"))


@query("A03_agg_aliases", """SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS gross,
    CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS DOUBLE) AS net, round(avg(l_quantity) + 1e-9, 4) AS mean_quantity,
    count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_aliases(spark, sf):
    # exact decimals: the sum does not depend on the order of the rows
    net = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18, 4)")
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("gross"),
        F.sum(net).cast("double").alias("net"),
        settled(F.avg("l_quantity")).alias("mean_quantity"),
        F.count("*").alias("n"),
    )


@query("A04_min_max_mean", """SELECT event_type, min(value) AS low, max(value) AS high, round(avg(value) + 1e-9, 4) AS mean_value,
    (SELECT max(value) FROM events) AS top FROM events GROUP BY event_type""")
def min_max_mean(spark, sf):
    events = table(spark, sf, "events")
    per_type = events.groupBy("event_type").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), settled(F.mean("value")).alias("mean_value")
    )
    return spark.sql(
        "SELECT *, (SELECT max(high) FROM {per_type}) AS top FROM {per_type}", per_type=per_type
    )


@query("A05_approx_distinct", """SELECT l_returnflag, count(DISTINCT l_partkey) AS exact, TRUE AS close
    FROM lineitem GROUP BY l_returnflag""")
def approx_distinct(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("exact"),
        F.approx_count_distinct("l_partkey", 0.02).alias("approx"),
    ).select("l_returnflag", "exact", (F.abs(F.col("approx") / F.col("exact") - 1) < 0.1).alias("close"))


@query("A05_stored_sketches")
def stored_sketches(spark, sf):
    # a sketch of parts for each day of shipping is kept as bytes; any span of days is the union of its sketches
    lines, path = table(spark, sf, "lineitem"), scratch_dir(spark, "sketches")
    lines.groupBy(F.to_date("l_shipdate").alias("day")).agg(F.hll_sketch_agg("l_partkey", 12).alias("sketch")).write.parquet(path)
    spans = F.explode(F.array(F.date_format("day", "yyyy-MM"), F.date_format("day", "yyyy"), F.lit("all"))).alias("span")
    merged = spark.read.parquet(path).select(spans, "sketch").groupBy("span").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("span", F.hll_sketch_estimate("sketch").alias("parts"))


@query("A06_distinct_tuple", """SELECT count(DISTINCT (l_orderkey, l_linenumber)) AS pairs FROM lineitem
    WHERE l_orderkey IS NOT NULL""")
def distinct_tuple(spark, sf):
    return (
        table(spark, sf, "lineitem").where("l_orderkey IS NOT NULL")
        .agg(F.count_distinct(F.struct("l_orderkey", "l_linenumber")).alias("pairs"))
    )


@query("A07_collect", f"""WITH {ITEMS}, kinds AS (SELECT order_id, list_sort(list(DISTINCT curr)) AS s FROM items GROUP BY order_id),
    lists AS (SELECT order_id, list(item_id) AS l FROM items GROUP BY order_id)
    SELECT order_id, len(l) AS n_items, CAST(list_sum(l) AS BIGINT) AS id_sum, array_to_string(s, ',') AS curr_set
    FROM lists JOIN kinds USING (order_id)""")
def collect(spark, sf):
    # lists come in packs of bounded length, so what is asked of them is asked pack by pack
    documents = sales_documents(spark, sf).select("order_id", F.col("items.item_id").alias("ids"))
    lists = documents.groupBy("order_id").agg(
        F.sum(F.size("ids")).alias("n_items"),
        F.sum(F.aggregate("ids", F.lit(0).cast("bigint"), lambda total, i: total + i)).alias("id_sum"),
    )
    currency = F.when(F.col("l_linestatus") == "O", "USD").otherwise("EUR")
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"), currency.alias("curr"))
    sets = collect_distinct(lines, ["order_id"], "curr", "curr_set")
    return lists.join(sets.withColumn("curr_set", F.array_join("curr_set", ",")), "order_id")


@query("A08_flattened_set", """SELECT o_custkey, array_to_string(list_sort(list(DISTINCT p_type)), ',') AS types
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey GROUP BY o_custkey""")
def flattened_set(spark, sf):
    bought = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    )
    # the distinct of collect_distinct does what array_distinct(flatten(collect_set(…))) does, without the array of arrays
    return collect_distinct(bought, ["o_custkey"], "p_type", "types").select(
        "o_custkey", F.array_join("types", ",").alias("types")
    )


@query("A09_statistics", """SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS r,
    round(stddev_samp(l_quantity), 6) AS sd, round(var_pop(l_discount), 8) AS var FROM lineitem GROUP BY l_returnflag""")
def statistics(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("r"),
        F.round(F.stddev_samp("l_quantity"), 6).alias("sd"),
        F.round(F.var_pop("l_discount"), 8).alias("var"),
    )


@query("A10_distinct_sum", """SELECT l_linestatus, CAST(sum(DISTINCT l_partkey) AS BIGINT) AS total FROM lineitem
    GROUP BY l_linestatus""")
def distinct_sum(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_linestatus").agg(F.sum_distinct("l_partkey").alias("total"))


_COUNTS = ", ".join(f"count(*) FILTER (WHERE event_type = '{e}') AS {e}" for e in EVENT_TYPES)


@query("A11_pivot_sql", f"SELECT user_id, {_COUNTS} FROM events GROUP BY user_id")
def pivot_sql(spark, sf):
    listed = ", ".join(f"'{e}' AS {e}" for e in EVENT_TYPES)
    wide = spark.sql(
        f"SELECT * FROM (SELECT user_id, event_type FROM {{events}}) PIVOT (count(*) FOR event_type IN ({listed}))",
        events=table(spark, sf, "events"),
    )
    return wide.na.fill(0, EVENT_TYPES)


_QUANTITIES = ", ".join(
    f"CAST(sum(l_quantity) FILTER (WHERE p_type = '{t}') AS BIGINT) AS \"{t}\"" for t in PART_TYPES
)
TRANSACTIONS = f"""transactions AS (SELECT o_custkey, {_QUANTITIES} FROM orders
    JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey GROUP BY o_custkey)"""


def transactions(spark, sf):
    """Quantity bought per customer, one column per part type."""
    return (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey")
        .pivot("p_type", PART_TYPES)
        .agg(F.sum(F.col("l_quantity").cast("bigint")))
    )


@query("A12_pivot_api", f"WITH {TRANSACTIONS} SELECT * FROM transactions")
def pivot_api(spark, sf):
    return transactions(spark, sf)


@query("A13_group_by_date", """SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_date, count(*) AS total_daily_orders
    FROM orders GROUP BY 1""")
def group_by_date(spark, sf):
    daily = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("order_date"))
    return daily.agg(F.count("*").alias("total_daily_orders")).withColumn(
        "order_date", F.col("order_date").cast("string")
    )


@query("A14_group_by_day", """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, user_id,
    round(avg(value) + 1e-9, 4) AS avg_value FROM events GROUP BY 1, 2""")
def group_by_day(spark, sf):
    return spark.sql(
        """SELECT date_format(date_trunc('DD', ts), 'yyyy-MM-dd') AS day, user_id, round(avg(value) + 1e-9, 4) AS avg_value
           FROM {events} GROUP BY date_trunc('DD', ts), user_id""",
        events=table(spark, sf, "events"),
    )


@query("A15_user_summary", """SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen,
    strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen, count(*) AS total_records,
    round(avg(value) + 1e-9, 4) AS total_avg FROM events GROUP BY user_id""")
def user_summary(spark, sf):
    seen = "yyyy-MM-dd HH:mm:ss"
    return table(spark, sf, "events").groupBy("user_id").agg(
        F.date_format(F.min("ts"), seen).alias("first_seen"),
        F.date_format(F.max("ts"), seen).alias("last_seen"),
        F.count("*").alias("total_records"),
        settled(F.avg("value")).alias("total_avg"),
    )


@query("A16_first_in_group", f"""WITH {PLACES} SELECT state, count(*) AS customer_count, TRUE AS just_updated
    FROM places GROUP BY state""")
def first_in_group(spark, sf):
    counts = places(spark, sf).groupBy("geo.state").agg(
        F.count("*").alias("customer_count"), F.first(F.current_timestamp()).alias("updated_at")
    )
    return counts.select(
        "state", "customer_count", (F.col("updated_at") <= F.current_timestamp()).alias("just_updated")
    )


@query("A17_conditional_sum", """SELECT o_custkey, CAST(sum(CAST(o_orderstatus = 'O' AS INT)) AS BIGINT) AS open_orders
    FROM orders GROUP BY o_custkey""")
def conditional_sum(spark, sf):
    is_open = (F.col("o_orderstatus") == "O").cast("int")
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum(is_open).alias("open_orders"))


@query("A18_describe", """SELECT 'count' AS summary, CAST(count(l_quantity) AS DOUBLE) AS l_quantity, CAST(count(l_tax) AS DOUBLE) AS l_tax FROM lineitem
    UNION ALL SELECT 'mean', round(avg(l_quantity), 6), round(avg(l_tax), 6) FROM lineitem
    UNION ALL SELECT 'stddev', round(stddev_samp(l_quantity), 6), round(stddev_samp(l_tax), 6) FROM lineitem
    UNION ALL SELECT 'min', min(l_quantity), min(l_tax) FROM lineitem
    UNION ALL SELECT 'max', max(l_quantity), max(l_tax) FROM lineitem""")
def describe(spark, sf):
    stats = table(spark, sf, "lineitem").select("l_quantity", "l_tax").summary("count", "mean", "stddev", "min", "max")
    return stats.select("summary", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in ("l_quantity", "l_tax")])


@query("A19_explode_aggregate", f"""WITH {ITEMS} SELECT order_id, curr, round(sum(price), 2) AS sales,
    CAST(sum(qty) AS BIGINT) AS quantity, count(item_id) AS product_count FROM items GROUP BY order_id, curr""")
def explode_aggregate(spark, sf):
    products = sales_documents(spark, sf).select("order_id", F.explode("items").alias("product"))
    return products.groupBy("order_id", "product.curr").agg(
        F.round(F.sum("product.price"), 2).alias("sales"),
        F.sum("product.qty").cast("bigint").alias("quantity"),
        F.count("product.item_id").alias("product_count"),
    )


@query("A20_counts_of_current_state", f"""WITH {CHANGE_FEED}, last AS (SELECT customer_id,
      arg_max(operation, (seq_us, seq_id)) AS op, arg_max(coalesce(state, '-'), (seq_us, seq_id)) AS state
      FROM change_feed WHERE operation IS NOT NULL GROUP BY customer_id)
    SELECT state, count(*) AS customer_count FROM last WHERE op <> 'DELETE' GROUP BY state""")
def counts_of_current_state(spark, sf):
    feed = change_feed(spark, sf).where("operation IS NOT NULL")
    state = apply_changes(feed, ["customer_id"], ["seq_us", "seq_id"], "operation = 'DELETE'", drop=["operation"])
    return state.groupBy("state").agg(F.count("*").alias("customer_count"))


# -- time windows -------------------------------------------------------------


@query("W01_tumbling_count", """SELECT event_type, strftime(time_bucket(INTERVAL '1 minute', ts), '%Y-%m-%d %H:%M:%S') AS start_time,
    count(*) AS n FROM events GROUP BY 1, 2""")
def tumbling_count(spark, sf):
    counts = table(spark, sf, "events").groupBy("event_type", F.window("ts", "1 minute").alias("w")).count()
    return counts.select(
        "event_type", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start_time"), F.col("count").alias("n")
    )


@query("W02_tumbling_mean", """SELECT user_id, strftime(time_bucket(INTERVAL '3 minutes', ts) + INTERVAL '3 minutes', '%Y-%m-%d %H:%M:%S') AS end_time,
    round(avg(value) + 1e-9, 4) AS avg_ping FROM events GROUP BY 1, 2""")
def tumbling_mean(spark, sf):
    return spark.sql(
        """SELECT user_id, date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS end_time, round(mean(value) + 1e-9, 4) AS avg_ping
           FROM {events} GROUP BY user_id, window(ts, '3 minutes')""",
        events=table(spark, sf, "events"),
    )
