"""Whole jobs, from raw files or tables to the final answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions.nested import json_field
from lakeloom.operators.quality import expectation_totals, latest_update
from lakeloom.plans import customers, event_windows, orders, recordings, retail, shop, status
from lakeloom.session import scratch_dir
from lakeloom.sources.ingest import json_stream
from lakeloom.streaming.run import run_to_table
from lakeloom.suite.base import query, settled, table
from lakeloom.suite.joins_aggregates import _COUNTS, EVENT_TYPES, TRANSACTIONS, transactions
from lakeloom.suite.quality_rules import CLEAN_FEED
from lakeloom.suite.standins import EMAIL, SALES, USERS, change_feed, sales, sales_documents, users
from lakeloom.suite.streams import arrivals

STAMP = "yyyy-MM-dd HH:mm:ss"


# -- orders ------------------------------------------------------------------


def order_feed(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("order_timestamp"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Y").otherwise("N").alias("notifications"),
    )


BEFORE_1998 = "order_timestamp < 883612800"  # 1998-01-01


@query("L01_orders", """SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_date, count(*) AS total_daily_orders FROM orders GROUP BY 1""")
def orders_flow(spark, sf):
    out = scratch_dir(spark, "orders")
    daily = arrivals(spark, order_feed(spark, sf), BEFORE_1998, lambda feed: orders.update(spark, feed, out), odd=True)
    return daily.withColumn("order_date", F.col("order_date").cast("string"))


@query("L01_orders_batch", """SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_date, count(*) AS total_daily_orders FROM orders GROUP BY 1""")
def orders_batch(spark, sf):
    bronze = order_feed(spark, sf).withColumn("source_file", F.lit("batch"))
    daily = orders.by_date(orders.silver(bronze))
    return daily.withColumn("order_date", F.col("order_date").cast("string"))


# -- customers ----------------------------------------------------------------

CURRENT = f"""{CLEAN_FEED}, ranked AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY seq_us DESC, seq_id DESC) AS rn FROM clean),
    current_customers AS (SELECT * FROM ranked WHERE rn = 1 AND operation <> 'DELETE')"""
EMAILS = """emails AS (SELECT o_orderkey AS order_id, c.email FROM orders JOIN current_customers c ON o_custkey = c.customer_id
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))"""
_FIRST_HALF = "seq_us < 1705363200000000"


def _customers_from_stream(spark, sf):
    out = scratch_dir(spark, "customers")
    return arrivals(spark, change_feed(spark, sf), _FIRST_HALF, lambda feed: customers.update(spark, feed, out), odd=True)


def _customers_from_batch(spark, sf):
    from lakeloom.operators.changes import apply_changes

    bronze = change_feed(spark, sf).withColumns({"source_file": F.lit("batch"), "processing_time": F.current_timestamp()})
    return apply_changes(
        customers.clean(bronze), customers.KEYS, customers.SEQUENCE, "operation = 'DELETE'", drop=["operation"]
    )


@query("L02_customers", f"WITH {CURRENT} SELECT state, count(*) AS customer_count FROM current_customers GROUP BY state")
def customers_flow(spark, sf):
    return customers.counts_by_state(_customers_from_stream(spark, sf)).drop("last_change")


@query("L02_maintained_counts", f"WITH {CURRENT} SELECT state, count(*) AS customer_count FROM current_customers GROUP BY state")
def maintained_customers(spark, sf):
    # the later half of the changes arrives first
    out = scratch_dir(spark, "maintained_customers")

    def step(feed):
        raw = json_stream(spark, feed, customers.FEED_SCHEMA)
        run_to_table(raw, f"{out}/bronze", f"{out}/_checkpoints/bronze")
        return customers.update_counts(spark, out, state_partitions=spark.sparkContext.defaultParallelism)

    return arrivals(spark, change_feed(spark, sf), f"NOT ({_FIRST_HALF})", step, odd=True)


@query("L02_subscribed_emails", f"""WITH {CURRENT}, {EMAILS} SELECT order_id, email FROM emails""")
def subscribed(spark, sf):
    emails = customers.subscribed_emails(order_feed(spark, sf), _customers_from_batch(spark, sf))
    return emails.select("order_id", "email")


# -- order status ---------------------------------------------------------------

SINCE = 852076800  # 1997-01-01 in epoch seconds


def status_feed(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("order_status"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("status_timestamp"),
    )


_STATUS = f"""WITH {CURRENT}, {EMAILS} SELECT order_id, o_orderstatus AS order_status, email FROM orders
    JOIN emails ON order_id = o_orderkey WHERE o_orderdate > TIMESTAMP '1997-01-01'"""


@query("L03_status", _STATUS)
def status_flow(spark, sf):
    out = scratch_dir(spark, "status")
    rows = arrivals(
        spark, status_feed(spark, sf), "status_timestamp < 883612800",
        lambda feed: status.update(spark, feed, out, SINCE), odd=True,
    )
    emails = customers.subscribed_emails(order_feed(spark, sf), _customers_from_batch(spark, sf))
    return status.email_updates(rows, emails).select("order_id", "order_status", "email")


@query("E05_flow_counts", """WITH late AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')
    SELECT 'status_silver' AS dataset, 'valid_timestamp' AS name, count(*) FILTER (WHERE o_orderdate > TIMESTAMP '1997-01-01') AS passing_records,
      count(*) FILTER (WHERE o_orderdate <= TIMESTAMP '1997-01-01') AS failing_records FROM late
    UNION ALL SELECT 'status_silver', 'known_status', count(*) FILTER (WHERE o_orderstatus IN ('O', 'F')),
      count(*) FILTER (WHERE o_orderstatus NOT IN ('O', 'F')) FROM late""")
def flow_counts(spark, sf):
    # the older half arrives last; its update's counts are what the flow itself wrote to its log
    out = scratch_dir(spark, "status_counts")
    arrivals(spark, status_feed(spark, sf), "status_timestamp >= 883612800", lambda feed: status.update(spark, feed, out, SINCE), odd=True)
    return expectation_totals(latest_update(spark.read.parquet(f"{out}/event_log")))


@query("E06_event_log", """WITH asked AS (SELECT count(*) AS n FROM orders)
    SELECT 'action' AS kind, 'START' AS answer, 2 AS events FROM asked UNION ALL SELECT 'latest lineage', 'status_bronze -> status_silver', 1 FROM asked
    UNION ALL SELECT 'rows checked by the latest update', CAST(count(*) AS VARCHAR), 1 FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def flow_log(spark, sf):
    # what the flow itself wrote about its two updates
    out = scratch_dir(spark, "status_log")
    arrivals(spark, status_feed(spark, sf), "status_timestamp < 883612800", lambda feed: status.update(spark, feed, out, SINCE), odd=True)
    log = spark.read.parquet(f"{out}/event_log")
    latest = latest_update(log)
    actions = log.where("event_type = 'user_action'").groupBy(json_field("details", "user_action", "action").alias("answer")).agg(F.count("*").alias("events"))
    lineage = latest.where("event_type = 'flow_definition'").select(
        F.lit("latest lineage").alias("kind"),
        F.concat(json_field("details", "flow_definition", "input_datasets[0]"), F.lit(" -> "), json_field("details", "flow_definition", "output_dataset")).alias("answer"))
    checked = expectation_totals(latest).select(
        F.lit("rows checked by the latest update").alias("kind"), (F.col("passing_records") + F.col("failing_records")).cast("string").alias("answer"))
    rest = lineage.unionByName(checked.distinct()).withColumn("events", F.lit(1))
    return actions.select(F.lit("action").alias("kind"), "answer", F.col("events").cast("int").alias("events")).unionByName(rest)


@query("L03_status_batch", _STATUS)
def status_batch(spark, sf):
    silver = status.silver(status_feed(spark, sf).withColumn("source_file", F.lit("batch")), SINCE)
    emails = customers.subscribed_emails(order_feed(spark, sf), _customers_from_batch(spark, sf))
    return status.email_updates(silver, emails).select("order_id", "order_status", "email")


# -- retail sales ---------------------------------------------------------------


def retail_orders(spark, sf):
    """Order documents; the number is missing on orders of one priority."""
    documents = sales_documents(spark, sf)
    heads = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    product = F.transform("items", lambda i: F.struct(
        i["item_id"].alias("id"), i["price"].alias("price"), i["qty"].alias("qty"), i["curr"].alias("curr")
    ))
    return documents.join(heads, documents.order_id == heads.o_orderkey).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("n_items").alias("number_of_line_items"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string").alias("order_datetime"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderkey")).alias("order_number"),
        product.alias("ordered_products"),
    )


def retail_customers(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    customer = table(spark, sf, "customer")
    placed = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    return placed.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.col("r_name").alias("state"), F.col("n_name").alias("city"),
        F.col("c_acctbal").alias("units_purchased"), F.col("c_mktsegment").alias("loyalty_segment"),
    )


_RETAIL = """SELECT strftime(o_orderdate, '%Y-%m') AS month, n_name AS city,
    CASE WHEN l_linestatus = 'O' THEN 'USD' ELSE 'EUR' END AS curr, round(sum(l_extendedprice), 2) AS revenue,
    CAST(sum(l_quantity) AS BIGINT) AS units, max(l_extendedprice) AS dearest_line, round(sum(l_extendedprice) / sum(l_quantity) + 1e-9, 4) AS mean_unit_price
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE n_name IN ('NATION_3', 'NATION_7') AND o_orderpriority <> '4-NOT SPECIFIED' GROUP BY 1, 2, 3"""


def _city_sales(cleaned):
    sales = retail.sales_in(["NATION_3", "NATION_7"], cleaned)
    return sales.withColumns({
        "revenue": F.round("revenue", 2), "units": F.col("units").cast("bigint"), "mean_unit_price": settled(F.col("mean_unit_price")),
    })


@query("L04_retail", _RETAIL)
def retail_flow(spark, sf):
    out, people = scratch_dir(spark, "retail"), scratch_dir(spark, "retail_customers")
    retail_customers(spark, sf).write.option("header", True).csv(people)
    cleaned = arrivals(
        spark, retail_orders(spark, sf), "order_datetime < '883612800'",
        lambda feed: retail.update(spark, feed, people, out), odd=True, once=True,
    )
    return _city_sales(cleaned)


@query("L04_retail_batch", _RETAIL)
def retail_batch(spark, sf):
    return _city_sales(retail.cleaned(retail_orders(spark, sf), retail_customers(spark, sf)))


# -- recordings -------------------------------------------------------------------


def recording_feed(spark, sf):
    """Readings as text fields, the time as epoch seconds with a fraction."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("reading_id"),
        F.col("event_id").cast("int").alias("device_id"),
        F.col("user_id").alias("mrn"),
        F.when(F.col("event_type") == "error", -F.col("value")).otherwise(F.col("value")).alias("heartrate"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("time"),
    )


_RECORDINGS = """SELECT user_id AS mrn, c_name AS name, strftime(ts, '%Y-%m-%d') AS date, round(avg(value) + 1e-9, 4) AS avg_heartrate
    FROM events JOIN customer ON user_id = c_custkey WHERE event_type <> 'error' AND value > 0 GROUP BY 1, 2, 3"""


@query("L05_recordings", _RECORDINGS)
def recordings_flow(spark, sf):
    out, patients = scratch_dir(spark, "recordings"), scratch_dir(spark, "patients")
    table(spark, sf, "customer").selectExpr("c_custkey AS mrn", "c_name AS name").write.option("header", True).csv(patients)
    daily = arrivals(
        spark, recording_feed(spark, sf), "time < 1705363200",
        lambda feed: recordings.update(
            spark, feed, patients, out, state_partitions=spark.sparkContext.defaultParallelism
        ), odd=True,
    )
    return daily.withColumns({"date": F.col("date").cast("string"), "avg_heartrate": settled(F.col("avg_heartrate"))})


_ADMISSIONS = """SELECT a.user_id AS mrn, c_name AS name, strftime(a.ts, '%Y-%m-%d') AS date, round(avg(a.value) + 1e-9, 4) AS avg_heartrate
    FROM events AS a JOIN events AS b ON a.user_id = b.user_id AND b.event_type = 'signup' AND a.ts >= b.ts AND a.ts <= b.ts + INTERVAL '2 days'
    JOIN customer ON b.user_id = c_custkey WHERE a.event_type <> 'error' AND a.value > 0 GROUP BY 1, 2, 3"""


def admissions(spark, sf):
    """A patient's admissions: the user's sign-ups, with the time as epoch seconds."""
    signups = table(spark, sf, "events").where("event_type = 'signup'")
    return signups.join(table(spark, sf, "customer"), F.col("user_id") == F.col("c_custkey")).select(
        F.col("user_id").alias("mrn"), F.col("c_name").alias("name"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("admitted"))


@query("L05_recordings_in_time", _ADMISSIONS)
def recordings_in_time(spark, sf):
    # recordings of up to two days after an admission; both feeds come in two arrivals
    out, patients = scratch_dir(spark, "recordings_in_time"), scratch_dir(spark, "admissions")
    came = iter(("admitted < 1705363200", "admitted >= 1705363200"))

    def step(feed):
        admissions(spark, sf).where(next(came)).write.mode("append").option("header", True).csv(patients)
        return recordings.update(
            spark, feed, patients, out, state_partitions=spark.sparkContext.defaultParallelism, within="2 days", lateness="1 hour")

    daily = arrivals(spark, recording_feed(spark, sf), "time < 1705363200", step, odd=True)
    return daily.withColumns({"date": F.col("date").cast("string"), "avg_heartrate": settled(F.col("avg_heartrate"))})


@query("L05_recordings_batch", _RECORDINGS)
def recordings_batch(spark, sf):
    patients = table(spark, sf, "customer").selectExpr("c_custkey AS mrn", "c_name AS name")
    daily = recordings.daily_mean(recordings.enriched(recording_feed(spark, sf), patients))
    return daily.withColumns({"date": F.col("date").cast("string"), "avg_heartrate": settled(F.col("avg_heartrate"))})


# -- event windows ------------------------------------------------------------------


def named_events(spark, sf):
    """Events with the name missing on one type; the time as epoch seconds, as JSON timestamps travel."""
    return table(spark, sf, "events").select(
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_name"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("event_time"),
    )


_WINDOWS = """SELECT event_type AS event_name, strftime(time_bucket(INTERVAL '1 minute', ts), '%Y-%m-%d %H:%M:%S') AS start_time, count(*) AS n
    FROM events WHERE event_type <> 'error' GROUP BY 1, 2"""


def _shown(counts):
    return counts.select("event_name", F.date_format("window.start", STAMP).alias("start_time"), F.col("count").alias("n"))


@query("L06_event_windows", _WINDOWS)
def event_windows_flow(spark, sf):
    out = scratch_dir(spark, "event_windows")
    return _shown(arrivals(
        spark, named_events(spark, sf), "event_time < 1705363200", lambda feed: event_windows.update(spark, feed, out), odd=True
    ))


@query("L06_event_windows_batch", _WINDOWS)
def event_windows_batch(spark, sf):
    raw = named_events(spark, sf).withColumn("event_time", F.timestamp_seconds("event_time"))
    return _shown(event_windows.per_minute(event_windows.cleaned(raw)))


# -- abandoned carts ------------------------------------------------------------------

CARTS = f"""{USERS}, {SALES}, converted AS (SELECT DISTINCT email FROM sales WHERE status = 'F' AND priority = '1-URGENT'),
    carts AS (SELECT DISTINCT o_custkey AS user_id, l_partkey AS item_id FROM orders JOIN lineitem ON o_orderkey = l_orderkey
      WHERE o_orderstatus = 'O' AND o_orderpriority = '2-HIGH'),
    people AS (SELECT u.user_id, u.email, c.email IS NOT NULL AS converted FROM users u LEFT JOIN converted c ON u.email = c.email)"""


def cart_tables(spark, sf):
    """users, sales (finished urgent orders) and cart events (items of open high-priority orders)."""
    people = users(spark, sf).select("user_id", "email")
    bought = sales(spark, sf).where("status = 'F' AND priority = '1-URGENT'")
    in_cart = table(spark, sf, "orders").where("o_orderstatus = 'O' AND o_orderpriority = '2-HIGH'")
    documents = sales_documents(spark, sf)
    events = in_cart.join(documents, in_cart.o_orderkey == documents.order_id).select(
        F.col("o_custkey").alias("user_id"), "items"
    )
    return people, bought, events


@query("L07_abandoned_carts", f"""WITH {CARTS} SELECT item_id, count(*) AS "count" FROM people JOIN carts USING (user_id)
    WHERE NOT converted GROUP BY item_id""")
def abandoned_carts(spark, sf):
    return shop.abandoned_items(*cart_tables(spark, sf))


@query("L07_cart_stages", f"""WITH {CARTS}, sized AS (SELECT people.*, n FROM people
      LEFT JOIN (SELECT user_id, count(*) AS n FROM carts GROUP BY 1) c ON people.user_id = c.user_id)
    SELECT 'users' AS stage, count(*) AS "rows" FROM sized UNION ALL SELECT 'not_converted', count(*) FROM sized WHERE NOT converted
    UNION ALL SELECT 'without_cart', count(*) FROM sized WHERE n IS NULL
    UNION ALL SELECT 'abandoned', count(*) FROM sized WHERE NOT converted AND n IS NOT NULL""")
def cart_stages(spark, sf):
    return shop.abandoned_cart_stages(*cart_tables(spark, sf))


# -- click paths, clean users, pings, deliveries ---------------------------------------


@query("L08_click_paths", f"""WITH {TRANSACTIONS}, paths AS (SELECT user_id AS "user", {_COUNTS} FROM events GROUP BY user_id)
    SELECT * FROM paths JOIN transactions ON "user" = o_custkey""")
def click_paths(spark, sf):
    return shop.click_paths(table(spark, sf, "events"), EVENT_TYPES, transactions(spark, sf), "o_custkey")


@query("L09_clean_users", f"""WITH first AS (SELECT user_id, min(ts) AS ts FROM events GROUP BY user_id)
    SELECT user_id, CASE WHEN c_acctbal >= 0 THEN {EMAIL} END AS email, strftime(first.ts, '%b %-d, %Y') AS first_touch_date,
    strftime(first.ts, '%H:%M:%S') AS first_touch_time, CASE WHEN c_acctbal >= 0 THEN regexp_extract({EMAIL}, '@(.+)', 1) END AS email_domain
    FROM first JOIN customer ON user_id = c_custkey""")
def clean_users(spark, sf):
    # every user twice, once without the e-mail, plus rows without a key
    first = table(spark, sf, "events").groupBy("user_id").agg(F.min("ts").alias("ts"))
    people = users(spark, sf).withColumn("email", F.when(F.col("balance") >= 0, F.col("email")))
    known = people.join(first, "user_id").select("user_id", "email", "ts")
    bare = known.withColumn("email", F.lit(None).cast("string"))
    keyless = bare.withColumn("user_id", F.lit(None).cast("bigint"))
    dirty = known.union(bare).union(keyless)
    return shop.clean_users(dirty, F.unix_micros(F.col("ts").cast("timestamp")))


@query("L09_checks", f"""WITH {USERS} SELECT 'user_id' AS column_name, TRUE AS no_duplicates
    UNION ALL SELECT 'email', (SELECT max(n) <= 1 FROM (SELECT count(*) AS n FROM users GROUP BY email))""")
def clean_user_checks(spark, sf):
    clean = users(spark, sf).dropDuplicates(["user_id"])

    def check(column):
        return shop.is_unique(clean, column).select(F.lit(column).alias("column_name"), "no_duplicates")

    return check("user_id").union(check("email"))


@query("L10_deliveries", """SELECT l_orderkey, l_linenumber, l_partkey, l_discount * 100 > 7 AS late, l_returnflag = 'R' AS cancelled_flag,
    CASE WHEN l_returnflag = 'R' THEN TRUE ELSE round(l_tax * 1000) >= 15 END AS delay15_flag
    FROM lineitem WHERE l_linestatus <> 'F' AND l_quantity > 5""")
def deliveries(spark, sf):
    # a line item stands for a flight; a small quantity stands for a missing delay ('NA' in the file)
    raw = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (F.col("l_discount") * 100 > 7).alias("late"),
        F.when(F.col("l_quantity") > 5, F.round(F.col("l_tax") * 1000).cast("int")).alias("arr_delay"),
        (F.col("l_returnflag") == "R").cast("int").alias("cancelled"),
        (F.col("l_linestatus") == "F").cast("int").alias("diverted"),
    )
    feed, out = scratch_dir(spark, "flights"), scratch_dir(spark, "flights_parquet")
    raw.write.option("header", True).option("nullValue", "NA").csv(feed)
    read = spark.read.option("header", True).option("nullValue", "NA").schema(raw.schema).csv(feed)
    shop.clean_flights(read).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out).select("l_orderkey", "l_linenumber", "l_partkey", "late", "cancelled_flag", "delay15_flag")


@query("L11_ping_report", """WITH three AS (SELECT user_id, avg(value) AS m, max(value) - min(value) AS s FROM events GROUP BY user_id, time_bucket(INTERVAL '3 minutes', ts)),
    per_user AS (SELECT user_id, count(*) AS windows, round(max(m) + 1e-9, 4) AS top_mean, round(max(s) + 1e-9, 4) AS top_spread FROM three GROUP BY 1),
    hours AS (SELECT user_id, max(n) AS in_busiest_hour FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id, hour(ts)) GROUP BY 1)
    SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS since, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS until, round(avg(value) + 1e-9, 4) AS mean_ping,
    round(max(value) + 1e-9, 4) AS worst_ping, any_value(windows) AS windows, any_value(top_mean) AS top_mean, any_value(top_spread) AS top_spread,
    any_value(in_busiest_hour) AS in_busiest_hour FROM events JOIN per_user USING (user_id) JOIN hours USING (user_id) GROUP BY user_id""")
def ping_report(spark, sf):
    pings = table(spark, sf, "events").select("user_id", F.col("value").alias("ping"), F.col("ts").alias("time"))
    hours, three, summary = shop.ping_report(pings)
    per_user = three.groupBy("user_id").agg(
        F.count("*").alias("windows"), settled(F.max("mean_ping")).alias("top_mean"), settled(F.max("spread")).alias("top_spread"))
    busiest = hours.groupBy("user_id").agg(F.max("records").alias("in_busiest_hour"))
    return summary.join(busiest, "user_id").join(per_user, "user_id").select(
        "user_id", F.date_format("since", STAMP).alias("since"), F.date_format("until", STAMP).alias("until"), settled(F.col("mean_ping")).alias("mean_ping"),
        settled(F.col("worst_ping")).alias("worst_ping"), "windows", "top_mean", "top_spread", "in_busiest_hour")
