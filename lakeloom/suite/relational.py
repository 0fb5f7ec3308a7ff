"""Projection, filters, nulls, duplicates, sampling, limits, sorts and unions."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from lakeloom.functions.nested import words
from lakeloom.operators.joins import sort_rows
from lakeloom.operators.plan_facts import executed, plan_facts
from lakeloom.operators.quality import EMAIL_PATTERN
from lakeloom.suite.base import query, table
from lakeloom.suite.standins import (
    PLACES, SALES, USERS, USERS_DIRTY, places, sales, users, users_dirty,
)

# -- projection, predicates, columns ------------------------------------------


@query("P01_select_nested", f"WITH {PLACES} SELECT user_id AS id, email, city, state AS region_name FROM places")
def select_nested(spark, sf):
    return places(spark, sf).select(
        F.col("user_id").alias("id"), "email", F.col("geo.city"), F.col("geo.state").alias("region_name")
    )


@query("P02_select_expr", """SELECT event_id, event_type IN ('click', 'view') AS is_browse,
    round(value * 2, 2) AS doubled FROM events""")
def select_expr(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "event_id", "event_type IN ('click', 'view') AS is_browse", "round(value * 2, 2) AS doubled"
    )


@query("P03_drop_columns", "SELECT event_id, user_id, event_type FROM events")
def drop_columns(spark, sf):
    events = table(spark, sf, "events")
    return events.drop("ts", "props").drop(F.col("value"))


@query("P04_with_column", """SELECT o_orderkey, o_orderpriority, o_orderstatus IN ('O', 'P') AS is_open
    FROM orders""")
def with_column(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return orders.withColumn("is_open", F.col("o_orderstatus").isin("O", "P")).drop("o_orderstatus")


@query("P05_rename_column", "SELECT o_orderkey, o_totalprice AS revenue FROM orders")
def rename_column(spark, sf):
    return (
        table(spark, sf, "orders").select("o_orderkey", "o_totalprice").withColumnRenamed("o_totalprice", "revenue")
    )


@query("P06_all_except", "SELECT * EXCLUDE (ts, props) FROM events")
def all_except(spark, sf):
    return spark.sql("SELECT * EXCEPT (ts, props) FROM {events}", events=table(spark, sf, "events"))


@query("P07_struct_star", f"WITH {PLACES} SELECT user_id, city, state FROM places")
def struct_star(spark, sf):
    return places(spark, sf).select("user_id", "geo.*")


@query("P08_filter_where", """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice > 200000 AND o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'""")
def filter_where(spark, sf):
    orders = table(spark, sf, "orders")
    return (
        orders.where("o_totalprice > 200000")
        .filter(F.col("o_orderstatus") == "F")
        .filter(orders.o_orderpriority != "5-LOW")
        .select("o_orderkey", "o_totalprice")
    )


@query("P09_arithmetic", """SELECT l_orderkey, l_linenumber, l_partkey,
    round(l_extendedprice * (1 - l_discount), 4) AS net, CAST(l_quantity AS INT) % 7 AS rest
    FROM lineitem WHERE l_quantity >= 10 AND l_discount < 0.05 AND l_returnflag <> 'R' AND NOT l_linestatus = 'O'""")
def arithmetic(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.filter(
        (F.col("l_quantity") >= 10)
        & (lines["l_discount"] < 0.05)
        & (lines.l_returnflag != "R")
        & ~(F.col("l_linestatus") == "O")
    ).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net"),
        (F.col("l_quantity").cast("int") % 7).alias("rest"),
    )


@query("P10_membership", """SELECT p_partkey, p_type FROM part
    WHERE p_type IN ('PROMO', 'SMALL') AND p_brand NOT IN ('Brand#1', 'Brand#2')""")
def membership(spark, sf):
    return (
        table(spark, sf, "part")
        .filter(F.col("p_type").isin("PROMO", "SMALL") & ~F.col("p_brand").isin("Brand#1", "Brand#2"))
        .select("p_partkey", "p_type")
    )


@query("P11_null_nan", f"""WITH {USERS_DIRTY} SELECT count(*) FILTER (WHERE email IS NULL) AS no_email,
    count(*) FILTER (WHERE email IS NOT NULL) AS with_email, count(*) FILTER (WHERE user_id IS NULL) AS no_id,
    (SELECT count(*) FROM users_dirty WHERE balance < 0) AS not_a_number FROM users_dirty""")
def null_nan(spark, sf):
    dirty = users_dirty(spark, sf).withColumn(
        "root", F.when(F.col("balance") < 0, F.lit(float("nan"))).otherwise(F.sqrt(F.abs("balance")))
    )
    return dirty.agg(
        F.count_if(F.col("email").isNull()).alias("no_email"),
        F.count_if(F.col("email").isNotNull()).alias("with_email"),
        F.count_if(F.isnull("user_id")).alias("no_id"),
        F.count_if(F.isnan("root")).alias("not_a_number"),
    )


@query("P12_cast", """SELECT event_id, CAST(trunc(value) AS INT) AS whole, CAST(event_id AS VARCHAR) AS id_text,
    TRY_CAST(event_type AS INT) AS not_a_number, strftime(ts, '%Y-%m-%d') AS day FROM events""")
def cast(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.col("value").cast("int").alias("whole"),
        F.expr("string(event_id)").alias("id_text"),
        F.col("event_type").try_cast("int").alias("not_a_number"),
        F.col("ts").cast(T.TimestampType()).cast("date").cast("string").alias("day"),
    )


@query("P13_conditional", """SELECT band, count(*) AS n FROM (SELECT CASE WHEN c_acctbal < 0 THEN 'debt'
    WHEN c_acctbal < 5000 THEN 'small' ELSE 'large' END AS band FROM customer) GROUP BY band""")
def conditional(spark, sf):
    band = F.when(F.col("c_acctbal") < 0, "debt").when(F.col("c_acctbal") < 5000, "small").otherwise("large")
    return table(spark, sf, "customer").groupBy(band.alias("band")).agg(F.count("*").alias("n"))


@query("P14_literal", f"WITH {SALES} SELECT DISTINCT email, TRUE AS converted FROM sales WHERE status = 'F'")
def literal(spark, sf):
    buyers = sales(spark, sf).where("status = 'F'").select("email").distinct()
    return buyers.withColumn("converted", F.lit(True))


@query("P15_pattern", f"""WITH {USERS} SELECT user_id, email LIKE 'customer%' AS like_name,
    regexp_matches(email, '{EMAIL_PATTERN}') AS valid,
    suffix(email, 'building.com') AS builder FROM users""")
def pattern(spark, sf):
    return users(spark, sf).select(
        "user_id",
        F.col("email").like("customer%").alias("like_name"),
        F.col("email").rlike(EMAIL_PATTERN).alias("valid"),
        F.col("email").endswith("building.com").alias("builder"),
    )


@query("P16_parameter", """SELECT l_returnflag, count(*) AS n, round(avg(l_quantity) + 1e-9, 4) AS mean_quantity
    FROM lineitem WHERE l_linestatus = 'O' AND l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY l_returnflag""")
def parameter(spark, sf):
    return spark.sql(
        """SELECT l_returnflag, count(*) AS n, round(avg(l_quantity) + 1e-9, 4) AS mean_quantity FROM {lines}
           WHERE l_linestatus = :status AND l_shipdate >= to_timestamp_ntz(:since) GROUP BY l_returnflag""",
        args={"status": "O", "since": "1997-01-01"},
        lines=table(spark, sf, "lineitem"),
    )


@query("P17_cte", """WITH big AS (SELECT o_custkey, o_totalprice FROM orders WHERE o_totalprice > 300000)
    SELECT o_custkey, count(*) AS n FROM big GROUP BY o_custkey""")
def cte(spark, sf):
    return spark.sql(
        """WITH big AS (SELECT o_custkey, o_totalprice FROM {orders} WHERE o_totalprice > 300000)
           SELECT o_custkey, count(*) AS n FROM big GROUP BY o_custkey""",
        orders=table(spark, sf, "orders"),
    )


@query("P18_subquery", """SELECT day, n FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events
    GROUP BY 1) WHERE n > 100""")
def subquery(spark, sf):
    return spark.sql(
        """SELECT day, n FROM (SELECT date_format(ts, 'yyyy-MM-dd') AS day, count(*) AS n FROM {events}
           GROUP BY 1) WHERE n > 100""",
        events=table(spark, sf, "events"),
    )


@query("P19_truncate_cents", """SELECT o_orderkey, CAST(trunc(o_totalprice / 3 * 100) AS BIGINT) / 100.0 AS cut,
    abs(round(o_totalprice / 3, 2) - trunc(o_totalprice / 3 * 100) / 100.0) > 0.001 AS differs FROM orders""")
def truncate_cents(spark, sf):
    share = F.col("o_totalprice") / 3
    cut = (share * 100).cast("long") / 100
    return table(spark, sf, "orders").select(
        "o_orderkey", cut.alias("cut"), (F.abs(F.round(share, 2) - cut) > 0.001).alias("differs")
    )


@query("P20_column_profile", """SELECT * FROM (
    SELECT 'c_acctbal' AS name, 'double' AS type, count(c_acctbal) AS filled FROM customer
    UNION ALL SELECT 'c_custkey', 'bigint', count(c_custkey) FROM customer
    UNION ALL SELECT 'c_mktsegment', 'string', count(c_mktsegment) FROM customer
    UNION ALL SELECT 'c_name', 'string', count(c_name) FROM customer
    UNION ALL SELECT 'c_nationkey', 'int', count(c_nationkey) FROM customer)""")
def column_profile(spark, sf):
    customer = table(spark, sf, "customer")
    filled = customer.agg(*[F.count(c).alias(c) for c in customer.columns])
    rows = [F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
                     F.col(f.name).alias("filled")) for f in customer.schema]
    return filled.select(F.inline(F.array(*rows)))


# -- nulls, duplicates, sampling, limits --------------------------------------


@query("D01_drop_nulls", f"""WITH {USERS_DIRTY} SELECT 'any' AS how, count(*) AS n FROM users_dirty
      WHERE user_id IS NOT NULL AND email IS NOT NULL AND balance IS NOT NULL
    UNION ALL SELECT 'all', count(*) FROM users_dirty WHERE user_id IS NOT NULL OR email IS NOT NULL
    UNION ALL SELECT 'subset', count(*) FROM users_dirty WHERE user_id IS NOT NULL""")
def drop_nulls(spark, sf):
    dirty = users_dirty(spark, sf)

    def counted(how, df):
        return df.agg(F.count("*").alias("n")).select(F.lit(how).alias("how"), "n")

    return (
        counted("any", dirty.na.drop())
        .union(counted("all", dirty.dropna(how="all", subset=["user_id", "email"])))
        .union(counted("subset", dirty.dropna(how="any", subset=["user_id"])))
    )


@query("D02_fill_nulls", f"""WITH {USERS_DIRTY} SELECT coalesce(user_id, -1) AS user_id,
    coalesce(email, 'NO EMAIL') AS email, balance FROM users_dirty""")
def fill_nulls(spark, sf):
    return users_dirty(spark, sf).na.fill("NO EMAIL", ["email"]).na.fill(-1, ["user_id"])


@query("D03_replace_values", """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished'
    WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def replace_values(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return orders.na.replace({"F": "finished", "O": "open"}, subset=["o_orderstatus"])


@query("D04_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("D05_drop_duplicates", f"""WITH {USERS_DIRTY} SELECT DISTINCT user_id FROM users_dirty
    WHERE user_id IS NOT NULL""")
def drop_duplicates(spark, sf):
    return users_dirty(spark, sf).where("user_id IS NOT NULL").select("user_id").dropDuplicates(["user_id"])


@query("D06_dedupe_group_max", f"""WITH {USERS_DIRTY} SELECT user_id, max(email) AS email, max(balance) AS balance
    FROM users_dirty WHERE user_id IS NOT NULL GROUP BY user_id""")
def dedupe_group_max(spark, sf):
    return (
        users_dirty(spark, sf)
        .where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.max("email").alias("email"), F.max("balance").alias("balance"))
    )


@query("D07_null_counts", f"""WITH {USERS_DIRTY} SELECT count(*) AS n, count(email) AS emails,
    count(*) FILTER (WHERE email IS NULL) AS missing, count(*) - count(user_id) AS keyless FROM users_dirty""")
def null_counts(spark, sf):
    return users_dirty(spark, sf).selectExpr(
        "count(*) AS n", "count(email) AS emails", "count_if(email IS NULL) AS missing",
        "count(*) - count(user_id) AS keyless",
    )


@query("D08_uniqueness", f"""WITH {USERS_DIRTY} SELECT
    (SELECT max(n) <= 1 FROM (SELECT count(*) AS n FROM users_dirty WHERE user_id IS NOT NULL GROUP BY user_id)) AS id_unique,
    (SELECT max(n) <= 1 FROM (SELECT count(*) AS n FROM users_dirty WHERE email IS NOT NULL GROUP BY email)) AS email_unique""")
def uniqueness(spark, sf):
    dirty = users_dirty(spark, sf)

    def unique(column):
        counts = dirty.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
        return counts.agg((F.max("n") <= 1).alias("ok"))

    return spark.sql(
        "SELECT (SELECT ok FROM {ids}) AS id_unique, (SELECT ok FROM {emails}) AS email_unique",
        ids=unique("user_id"), emails=unique("email"),
    )


@query("D09_limit", """SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 25""")
def limit(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    return events.orderBy(F.desc("value"), "event_id").limit(25)


@query("D10_random_split", "SELECT count(*) AS n, TRUE AS disjoint, TRUE AS near_share FROM orders")
def random_split(spark, sf):
    train, test = table(spark, sf, "orders").select("o_orderkey").randomSplit([0.8, 0.2], seed=7)
    marked = train.withColumn("part", F.lit(1)).union(test.withColumn("part", F.lit(0)))
    per_key = marked.groupBy("o_orderkey").agg(F.count("*").alias("n"), F.max("part").alias("part"))
    return per_key.agg(
        F.sum("n").alias("n"), (F.max("n") == 1).alias("disjoint"),
        F.avg("part").between(0.75, 0.85).alias("near_share"),
    )


@query("D11_random_column", """SELECT event_type, count(*) AS n, TRUE AS in_range, TRUE AS varied FROM events
    GROUP BY event_type""")
def random_column(spark, sf):
    drawn = table(spark, sf, "events").withColumn("r", F.rand(11))
    return drawn.groupBy("event_type").agg(
        F.count("*").alias("n"),
        ((F.min("r") >= 0) & (F.max("r") < 1)).alias("in_range"),
        (F.stddev("r") > 0.1).alias("varied"),
    )


# -- sorts, top-k, unions -----------------------------------------------------


@query("O01_sort", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey")
def sort(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return sort_rows(customer, "c_mktsegment", F.desc("c_acctbal"), "c_custkey")


@query("O02_sort_nulls_last", f"""WITH {USERS_DIRTY} SELECT user_id, email, balance FROM users_dirty
    ORDER BY email DESC NULLS LAST, user_id NULLS LAST, balance""")
def sort_nulls_last(spark, sf):
    return sort_rows(
        users_dirty(spark, sf), F.col("email").desc_nulls_last(), F.col("user_id").asc_nulls_last(), "balance"
    )


@query("O03_top_k", """SELECT o_orderkey, o_totalprice, rank_of FROM (
      SELECT o_orderkey, o_totalprice, 'largest' AS rank_of FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3)
    UNION ALL SELECT * FROM (
      SELECT o_orderkey, o_totalprice, 'latest' AS rank_of FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 1)""")
def top_k(spark, sf):
    orders = table(spark, sf, "orders")
    largest = orders.sort(F.desc("o_totalprice"), "o_orderkey").limit(3)
    latest = orders.sort(F.desc("o_orderdate"), "o_orderkey").limit(1)
    columns = ["o_orderkey", "o_totalprice"]
    return largest.select(*columns, F.lit("largest").alias("rank_of")).union(
        latest.select(*columns, F.lit("latest").alias("rank_of"))
    )


@query("O04_revenue_chain", """SELECT l_returnflag, round(sum(l_extendedprice), 2) AS total_rev,
    round(avg(l_extendedprice), 2) AS avg_rev FROM lineitem GROUP BY l_returnflag
    ORDER BY total_rev DESC LIMIT 3""")
def revenue_chain(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_returnflag")
        .agg(F.sum("l_extendedprice").alias("total_rev"), F.avg("l_extendedprice").alias("avg_rev"))
        .sort(F.desc("total_rev"))
        .limit(3)
        .withColumn("total_rev", F.round("total_rev", 2))
        .withColumn("avg_rev", F.round("avg_rev", 2))
    )


@query("U01_union", """SELECT n_nationkey AS k, balance, n FROM (
    SELECT c_nationkey AS n_nationkey, round(sum(c_acctbal), 2) AS balance, count(*) AS n FROM customer GROUP BY 1
    UNION ALL SELECT s_nationkey, round(sum(s_acctbal), 2), count(*) FROM supplier GROUP BY 1)""")
def union(spark, sf):
    def per_nation(name, prefix):
        return table(spark, sf, name).groupBy(F.col(f"{prefix}_nationkey").alias("k")).agg(
            F.round(F.sum(f"{prefix}_acctbal"), 2).alias("balance"), F.count("*").alias("n")
        )

    buyers, sellers = per_nation("customer", "c"), per_nation("supplier", "s")
    if buyers.schema.simpleString() != sellers.schema.simpleString():
        raise ValueError("the two sides must have the same columns")
    return buyers.union(sellers)


@query("U02_union_by_name", """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""")
def union_by_name(spark, sf):
    customer = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance")
    supplier = table(spark, sf, "supplier").selectExpr("s_acctbal AS balance", "s_name AS name", "s_suppkey AS id")
    return customer.unionByName(supplier)


# -- pandas-style frames, caching, actions -------------------------------------


@query("S23_literal_table", """SELECT coalesce(weight, 0) AS weight, count(*) AS n, round(sum(o_totalprice), 2) AS revenue FROM orders
    LEFT JOIN (VALUES ('1-URGENT', 3), ('2-HIGH', 2), ('3-MEDIUM', 1)) AS w(priority, weight) ON o_orderpriority = priority
    GROUP BY 1""")
def literal_table(spark, sf):
    weights = spark.sql("SELECT * FROM VALUES ('1-URGENT', 3), ('2-HIGH', 2), ('3-MEDIUM', 1) AS w(priority, weight)")
    orders = table(spark, sf, "orders")
    return (
        orders.join(weights, orders.o_orderpriority == weights.priority, "left")
        .groupBy(F.coalesce("weight", F.lit(0)).alias("weight"))
        .agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))
    )


@query("S24_range", """WITH b AS (SELECT *, CAST(floor(value / 10) AS BIGINT) AS tens FROM events)
    SELECT bucket, count(event_id) AS n FROM (SELECT unnest(range(min(tens), max(tens) + 1)) AS bucket FROM b) AS r
    LEFT JOIN b ON tens = bucket GROUP BY bucket""")
def range_source(spark, sf):
    counts = table(spark, sf, "events").groupBy(F.floor(F.col("value") / 10).alias("bucket")).count()
    low, high = counts.agg(F.min("bucket"), F.max("bucket")).first()
    buckets = spark.range(low or 0, (high or 0) + 1).withColumnRenamed("id", "bucket")
    return buckets.join(counts, "bucket", "left").select("bucket", F.coalesce("count", F.lit(0)).alias("n"))


@query("S25_rows", """SELECT coalesce(label, 'plain') AS label, count(*) AS n FROM part LEFT JOIN (VALUES ('PROMO', 'on offer'), ('ECONOMY', 'cheap'))
    AS l(kind, label) ON p_type = kind GROUP BY 1""")
def rows(spark, sf):
    labels = spark.createDataFrame(
        [T.Row(kind="PROMO", label="on offer"), T.Row(kind="ECONOMY", label="cheap")], "kind string, label string"
    )
    part = table(spark, sf, "part")
    named = part.join(labels, part.p_type == labels.kind, "left").select(F.coalesce("label", F.lit("plain")).alias("label"))
    return named.groupBy("label").agg(F.count("*").alias("n"))


@query("B01_pandas_assign", "SELECT event_id, value + 1 AS x FROM events")
def pandas_assign(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.col("value").alias("x"))
    frame = events.pandas_api(index_col="event_id")
    frame["x"] = frame["x"] + 1
    return frame.to_spark(index_col="event_id")


@query("B02_pandas_sql", "SELECT event_type, round(avg(value) + 1e-9, 4) AS mean_value FROM events GROUP BY event_type")
def pandas_sql(spark, sf):
    import pyspark.pandas as ps

    frame = table(spark, sf, "events").select("event_id", "event_type", "value").pandas_api(index_col="event_id")
    means = ps.sql(
        "SELECT event_type, round(avg(value) + 1e-9, 4) AS mean_value FROM {events} GROUP BY event_type",
        index_col="event_type", events=frame,
    )
    return means.to_spark(index_col="event_type")


@query("B03_cache", """SELECT l_returnflag, count(*) AS n, (SELECT max(l_quantity) FROM lineitem WHERE l_discount > 0.05) AS top
    FROM lineitem WHERE l_discount > 0.05 GROUP BY l_returnflag""")
def cache(spark, sf):
    discounted = table(spark, sf, "lineitem").where("l_discount > 0.05").select("l_returnflag", "l_quantity").cache()
    top = discounted.agg(F.max("l_quantity")).first()[0]
    per_flag = discounted.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.lit(top).alias("top"))
    counted = per_flag.persist()
    counted.count()
    discounted.unpersist()
    return counted


@query("B05_actions", """SELECT (SELECT count(*) FROM orders) AS n_rows, (SELECT min(o_orderkey) FROM orders) AS first_key,
    3 AS taken, count(*) AS open_orders FROM orders WHERE o_orderstatus = 'O'""")
def actions(spark, sf):
    orders = table(spark, sf, "orders")
    ordered = orders.select("o_orderkey").orderBy("o_orderkey")
    return orders.where("o_orderstatus = 'O'").agg(
        F.lit(orders.count()).alias("n_rows"),
        F.lit(ordered.first()[0]).alias("first_key"),
        F.lit(len(ordered.take(3))).alias("taken"),
        F.count("*").alias("open_orders"),
    )


@query("G01_session_context", """SELECT o_orderstatus, count(*) AS n, TRUE AS has_user, 'spark_catalog' AS catalog_name
    FROM orders GROUP BY o_orderstatus""")
def session_context(spark, sf):
    return spark.sql(
        """SELECT o_orderstatus, count(*) AS n, bool_and(length(current_user()) > 0) AS has_user,
                  max(current_catalog()) AS catalog_name
           FROM {orders} WHERE current_database() IS NOT NULL GROUP BY o_orderstatus""",
        orders=table(spark, sf, "orders"),
    )


@query("C02_size", "SELECT doc_id, len(string_split(text, ' ')) AS n_words FROM documents WHERE len(string_split(text, ' ')) > 50")
def size(spark, sf):
    return (
        table(spark, sf, "documents")
        .select("doc_id", F.size(words("text")).alias("n_words"))
        .where("n_words > 50")
    )


# -- plans --------------------------------------------------------------------


_PLAN_FACTS = """WITH urgent AS (SELECT o_orderstatus, sum(o_totalprice) AS total FROM orders WHERE o_totalprice > 1000 AND o_orderpriority = '1-URGENT' GROUP BY 1),
    named AS (SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE length(o_orderpriority) > 5),
    facts(asked, kind, detail) AS (VALUES
      ('urgent', 'column read', 'orders: o_orderstatus'), ('urgent', 'column read', 'orders: o_totalprice'), ('urgent', 'column read', 'orders: o_orderpriority'),
      ('urgent', 'pushed filter', 'orders: IsNotNull(o_totalprice)'), ('urgent', 'pushed filter', 'orders: IsNotNull(o_orderpriority)'),
      ('urgent', 'pushed filter', 'orders: GreaterThan(o_totalprice,1000.0)'), ('urgent', 'pushed filter', 'orders: EqualTo(o_orderpriority,1-URGENT)'),
      ('urgent', 'exchange', 'hashpartitioning(o_orderstatus)'),
      ('named', 'column read', 'orders: o_orderkey'), ('named', 'column read', 'orders: o_custkey'), ('named', 'column read', 'orders: o_orderpriority'),
      ('named', 'column read', 'customer: c_custkey'), ('named', 'column read', 'customer: c_name'),
      ('named', 'pushed filter', 'orders: IsNotNull(o_orderpriority)'), ('named', 'pushed filter', 'orders: IsNotNull(o_custkey)'), ('named', 'pushed filter', 'customer: IsNotNull(c_custkey)'),
      ('named', 'exchange', 'hashpartitioning(o_custkey)'), ('named', 'exchange', 'hashpartitioning(c_custkey)'), ('named', 'join', 'SortMergeJoin Inner'))
    SELECT asked, kind, detail, CASE asked WHEN 'urgent' THEN (SELECT count(*) FROM urgent) ELSE (SELECT count(*) FROM named) END AS result_rows FROM facts"""


@query("B04_plan_facts", _PLAN_FACTS)
def facts_of_plans(spark, sf):
    # the second query's filter can't be pushed to the scan: it reads every order and then tests the length
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    asked = {
        "urgent": orders.where("o_totalprice > 1000 AND o_orderpriority = '1-URGENT'").groupBy("o_orderstatus").agg(F.sum("o_totalprice").alias("total")),
        "named": orders.where("length(o_orderpriority) > 5").hint("merge").join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name"),
    }
    found = [(name, kind, detail, n) for name, df in asked.items() for n in [executed(df)] for kind, detail in plan_facts(df) if kind != "filter"]
    return spark.createDataFrame(found, "asked string, kind string, detail string, result_rows bigint")
