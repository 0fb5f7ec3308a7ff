"""Reading files in place, tables over files, and writers, each checked by reading back."""

from __future__ import annotations

import json

from pyspark.sql import functions as F, types as T

from lakeloom.session import scratch_database, scratch_dir, view_name
from lakeloom.sources import files
from lakeloom.sources.sinks import replace_table, write_partitioned
from lakeloom.suite.base import query, table
from lakeloom.suite.standins import ITEMS, USERS, USERS_DIRTY, sales_documents, users, users_dirty

PEOPLE = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _written(spark, df, fmt, name, **options):
    path = scratch_dir(spark, name)
    df.write.format(fmt).options(**options).save(path)
    return path


# -- sources ------------------------------------------------------------------


@query("S01_json_in_place", PEOPLE)
def json_in_place(spark, sf):
    path = _written(spark, table(spark, sf, "customer"), "json", "people")
    return files.query_files(spark, "json", path).withColumn("c_nationkey", F.col("c_nationkey").cast("int"))


@query("S02_text_lines", "SELECT count(*) AS n, count(DISTINCT text) AS texts FROM (SELECT unnest(string_split(text, chr(10))) AS text FROM documents)")
def text_lines(spark, sf):
    path = _written(spark, table(spark, sf, "documents").select("text"), "text", "texts", lineSep="\n")
    lines = files.query_files(spark, "text", path)
    return lines.agg(F.count("value").alias("n"), F.count_distinct("value").alias("texts"))


@query("S03_whole_files", "SELECT TRUE AS has_files, TRUE AS lengths_match, TRUE AS dated, count(*) AS n_lines FROM customer")
def whole_files(spark, sf):
    # files of at most 10,000 rows: whole-file rows then stay small
    people = table(spark, sf, "customer")
    path = _written(spark, people, "json", "whole", maxRecordsPerFile=10_000)
    content = files.file_listing(spark, path, content=True).select(
        "length", "modificationTime", F.col("content").cast("string").alias("text"), F.octet_length("content").alias("bytes")
    )
    return content.agg(
        (F.count("*") > 0).alias("has_files"),
        F.bool_and(F.col("length") == F.col("bytes")).alias("lengths_match"),
        F.bool_and(F.col("modificationTime") <= F.current_timestamp()).alias("dated"),
        F.sum(F.size(F.split("text", "\n")) - 1).alias("n_lines"),
    )


@query("S04_csv_without_options", """SELECT CAST(c_custkey AS VARCHAR) AS _c0, c_mktsegment AS _c1, FALSE AS is_header FROM customer
    UNION SELECT 'c_custkey', 'c_mktsegment', TRUE FROM customer""")
def csv_without_options(spark, sf):
    people = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    path = _written(spark, people, "csv", "plain", header=True)
    # every file's header is a data row here; copies of it are folded
    return files.query_files(spark, "csv", path).withColumn("is_header", F.col("_c0") == "c_custkey").distinct()


@query("S05_parquet_in_place", PEOPLE)
def parquet_in_place(spark, sf):
    return files.query_files(spark, "parquet", f"{sf}/customer.parquet")


@query("S06_written_table_in_place", """SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_returnflag""")
def written_table_in_place(spark, sf):
    path = scratch_dir(spark, "lines")
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    write_partitioned(lines, path, ["l_returnflag"])
    return (
        files.query_files(spark, "parquet", path).where("l_returnflag = 'R'").groupBy("l_returnflag")
        .agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
    )


@query("S07_csv_inferred", PEOPLE)
def csv_inferred(spark, sf):
    path = _written(spark, table(spark, sf, "customer"), "csv", "tabbed", header=True, sep="\t")
    read = spark.read.option("sep", "\t").option("header", True).option("inferSchema", True).csv(path)
    return read.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("S08_csv_with_schema", """SELECT p_partkey, p_name, p_retailprice FROM part""")
def csv_with_schema(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    path = _written(spark, part, "csv", "items", header=True)
    struct = T.StructType([
        T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ])
    by_struct = spark.read.option("header", True).schema(struct).csv(path)
    by_ddl = spark.read.option("header", True).schema("p_partkey bigint, p_name string, p_retailprice double").csv(path)
    return by_struct.where("p_retailprice < 1500").union(by_ddl.where("p_retailprice >= 1500"))


@query("S09_csv_null_marker", f"WITH {USERS_DIRTY} SELECT count(*) AS n, count(email) AS emails, count(user_id) AS ids FROM users_dirty")
def csv_null_marker(spark, sf):
    path = _written(spark, users_dirty(spark, sf), "csv", "marked", header=True, nullValue="NA")
    read = spark.read.option("header", True).option("nullValue", "NA").schema("user_id bigint, email string, balance double").csv(path)
    return read.agg(F.count("*").alias("n"), F.count("email").alias("emails"), F.count("user_id").alias("ids"))


@query("S10_csv_fail_fast", "SELECT count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer")
def csv_fail_fast(spark, sf):
    path = _written(spark, table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "csv", "strict")
    read = spark.read.option("mode", "FAILFAST").schema("id bigint, balance double").csv(path)
    return read.agg(F.count("balance").alias("n"), F.round(F.sum("balance"), 2).alias("balance"))


@query("S11_json_nested_schema", f"""WITH {ITEMS} SELECT order_id, count(*) AS n, max(price) AS top FROM items GROUP BY order_id""")
def json_nested_schema(spark, sf):
    path = _written(spark, sales_documents(spark, sf), "json", "documents")
    inferred = spark.read.json(path).schema
    schema = T.StructType.fromJson(json.loads(inferred.json()))
    ddl = "order_id bigint, pack bigint, n_items bigint, items array<struct<item_id: bigint, price: double, qty: double, curr: string>>"
    if {f.name for f in schema} != {"order_id", "pack", "n_items", "items"}:
        raise ValueError(f"unexpected fields {schema.simpleString()}")
    items = spark.read.schema(ddl).json(path).select("order_id", F.inline("items"))
    return items.groupBy("order_id").agg(F.count("*").alias("n"), F.max("price").alias("top"))


@query("S12_external_table", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def external_table(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = _written(spark, orders, "csv", "external", header=True, sep="|")
    name = f"{scratch_database(spark)}.sales_csv"
    spark.sql(f"""CREATE TABLE {name} (o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE) USING csv
                  OPTIONS (header = 'true', delimiter = '|') LOCATION '{path}'""")
    return spark.table(name)


@query("S13_refresh_table", "SELECT o_orderstatus, 2 * count(*) AS n FROM orders GROUP BY o_orderstatus")
def refresh_table(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    path = _written(spark, orders, "csv", "growing")
    name = f"{scratch_database(spark)}.growing"
    spark.sql(f"CREATE TABLE {name} (o_orderkey BIGINT, o_orderstatus STRING) USING csv LOCATION '{path}'")
    spark.table(name).count()
    orders.write.mode("append").csv(path)  # files added behind the table's back
    spark.catalog.refreshTable(name)
    return spark.table(name).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("S14_view_over_files", "SELECT p_partkey, p_brand FROM part WHERE p_size > 10")
def view_over_files(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    path = _written(spark, part, "csv", "piped", header=True, sep="|")
    view, target = view_name("piped"), f"{scratch_database(spark)}.items"
    spark.sql(f"""CREATE TEMPORARY VIEW {view} (p_partkey BIGINT, p_brand STRING, p_size INT) USING csv
                  OPTIONS (path '{path}', header 'true', delimiter '|')""")
    spark.sql(f"CREATE TABLE {target} USING parquet AS SELECT p_partkey, p_brand FROM {view} WHERE p_size > 10")
    return spark.table(target)


@query("S21_queue_payload", "SELECT event_id, event_type, value FROM events")
def queue_payload(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    message = files.encode_message(events, "event_id")
    binary = message.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    path = _written(spark, binary, "json", "messages")
    received = spark.read.schema("key binary, value binary").json(path)
    decoded = files.decode_message(received, "event_id bigint, event_type string, value double")
    return decoded.where(F.col("key") == F.col("json.event_id").cast("string")).select("json.*")


@query("S22_provenance", "SELECT count(*) AS n, TRUE AS from_files, TRUE AS stamped FROM customer")
def provenance(spark, sf):
    path = _written(spark, table(spark, sf, "customer").select("c_custkey"), "json", "traced")
    traced = files.with_provenance(spark.read.schema("c_custkey bigint").json(path))
    return traced.agg(
        F.count("*").alias("n"), F.bool_and(F.col("source_file").endswith(".json")).alias("from_files"),
        F.bool_and(F.col("processing_time").isNotNull()).alias("stamped"),
    )


@query("S26_catalog_table", "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0")
def catalog_table(spark, sf):
    name = f"{scratch_database(spark)}.supplier"
    table(spark, sf, "supplier").write.saveAsTable(name)
    rich = spark.table(name).where("s_acctbal >= 5000")
    others = spark.read.table(name).where("s_acctbal > 0 AND s_acctbal < 5000")
    return rich.union(others).select("s_suppkey", "s_name")


@query("S27_pandas_read", "SELECT event_id, value, value * 2 AS doubled FROM events")
def pandas_read(spark, sf):
    import pyspark.pandas as ps

    path = _written(spark, table(spark, sf, "events").select("event_id", "value"), "csv", "frame", header=True)
    frame = ps.read_csv(path, index_col="event_id")
    frame["doubled"] = frame["value"] * 2
    return frame.to_spark(index_col="event_id").withColumn("event_id", F.col("event_id").cast("bigint"))


# -- sinks and table loading -----------------------------------------------------

_BY_STATUS = "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY o_orderstatus"


def _by_status(df):
    return df.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("K01_parquet_overwrite", _BY_STATUS)
def parquet_overwrite(spark, sf):
    path = scratch_dir(spark, "snappy")
    for rows in (_orders(spark, sf).where("o_orderstatus = 'P'"), _orders(spark, sf)):
        rows.write.option("compression", "snappy").mode("overwrite").parquet(path)
    return _by_status(spark.read.parquet(path))


@query("K02_csv_append", "SELECT o_orderstatus, 2 * count(*) AS n FROM orders GROUP BY o_orderstatus")
def csv_append(spark, sf):
    path = scratch_dir(spark, "appended")
    for _ in range(2):
        _orders(spark, sf).write.mode("append").option("header", True).csv(path)
    read = spark.read.option("header", True).schema("o_orderkey bigint, o_orderstatus string, o_totalprice double").csv(path)
    return read.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("K03_managed_table", _BY_STATUS)
def managed_table(spark, sf):
    name = f"{scratch_database(spark)}.orders"
    _orders(spark, sf).write.mode("overwrite").saveAsTable(name)
    return _by_status(spark.table(name))


@query("K04_table_at_path", _BY_STATUS)
def table_at_path(spark, sf):
    path = scratch_dir(spark, "at_path")
    _orders(spark, sf).write.format("parquet").mode("overwrite").save(path)
    return _by_status(spark.read.load(path, format="parquet"))


@query("K05_create_table_as", _BY_STATUS)
def create_table_as(spark, sf):
    database = scratch_database(spark)
    _orders(spark, sf).createOrReplaceTempView(source := view_name("orders"))
    spark.sql(f"CREATE TABLE {database}.copy USING parquet AS SELECT * FROM {source} WHERE o_orderstatus = 'F'")
    replace_table(_orders(spark, sf), f"{database}.copy")
    return _by_status(spark.table(f"{database}.copy"))


@query("K06_create_table_subset", "SELECT o_orderkey AS id, o_totalprice AS price FROM orders")
def create_table_subset(spark, sf):
    name = f"{scratch_database(spark)}.purchases"
    _orders(spark, sf).select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price")).write.saveAsTable(name)
    return spark.table(name)


@query("K07_partitioned_external", f"""WITH {USERS} SELECT user_id, email, nation_id, TRUE AS loaded FROM users WHERE nation_id = 7""")
def partitioned_external(spark, sf):
    path = scratch_dir(spark, "by_nation")
    people = users(spark, sf).select("user_id", "email", "nation_id").withColumn("loaded_at", F.current_timestamp())
    write_partitioned(people, path, ["nation_id"])
    name = f"{scratch_database(spark)}.users_by_nation"
    spark.sql(f"""CREATE TABLE {name} (user_id BIGINT, email STRING, loaded_at TIMESTAMP, nation_id INT) USING parquet
                  PARTITIONED BY (nation_id) COMMENT 'users by nation' LOCATION '{path}'""")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name).where("nation_id = 7").select(
        "user_id", "email", "nation_id", F.col("loaded_at").isNotNull().alias("loaded")
    )


@query("K08_insert", """SELECT o_orderstatus, 2 * count(*) + CAST(o_orderstatus = 'F' AS INT) AS n FROM orders GROUP BY o_orderstatus""")
def insert(spark, sf):
    name = f"{scratch_database(spark)}.loaded"
    _orders(spark, sf).write.saveAsTable(name)
    _orders(spark, sf).createOrReplaceTempView(source := view_name("orders"))
    spark.sql(f"INSERT INTO {name} SELECT * FROM {source}")
    spark.sql(f"INSERT INTO {name} VALUES (-1, 'F', 0.0D)")
    return spark.table(name).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("K09_insert_overwrite", """SELECT o_orderstatus, count(*) AS n, round(sum(CASE o_orderstatus WHEN 'F' THEN 0 ELSE o_totalprice END), 2) AS revenue
    FROM orders GROUP BY o_orderstatus""")
def insert_overwrite(spark, sf):
    name = f"{scratch_database(spark)}.overwritten"
    columns = ["o_orderkey", "o_totalprice", "o_orderstatus"]
    orders = _orders(spark, sf).select(*columns)
    orders.write.partitionBy("o_orderstatus").saveAsTable(name)
    orders.createOrReplaceTempView(source := view_name("orders"))
    spark.sql(f"INSERT OVERWRITE {name} SELECT * FROM {source}")  # the same rows again: nothing doubles
    spark.sql(f"""INSERT OVERWRITE {name} PARTITION (o_orderstatus = 'F')
                  SELECT o_orderkey, 0.0D FROM {source} WHERE o_orderstatus = 'F'""")  # one partition, the others stay
    return _by_status(spark.table(name))


@query("K15_queue_body", "SELECT event_id, event_type, round(value, 2) AS value FROM events")
def queue_body(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    path = _written(spark, files.encode_message(events, "event_id").select(F.col("value").alias("body")), "parquet", "bodies")
    bodies = spark.read.parquet(path)
    return bodies.select(F.from_json("body", "event_id bigint, event_type string, value double").alias("r")).select("r.*")


@query("K16_views", """SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderstatus""")
def views(spark, sf):
    database = scratch_database(spark)
    _orders(spark, sf).write.saveAsTable(f"{database}.orders")
    spark.sql(f"CREATE VIEW {database}.large AS SELECT * FROM {database}.orders WHERE o_totalprice > 100000")
    session_view = view_name("large")
    spark.table(f"{database}.large").createOrReplaceTempView(session_view)
    counts = view_name("counts")
    spark.sql(f"CREATE TEMPORARY VIEW {counts} AS SELECT o_orderstatus, count(*) AS n FROM {session_view} GROUP BY o_orderstatus")
    return spark.table(counts)


@query("K17_saved_pipeline", "SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS DOUBLE) AS idx FROM orders GROUP BY 1")
def saved_pipeline(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer

    from lakeloom.operators.ml import save_and_reload

    orders = table(spark, sf, "orders").select("o_orderpriority")
    fitted = Pipeline(stages=[StringIndexer(inputCol="o_orderpriority", outputCol="idx")]).fit(orders)
    return save_and_reload(fitted, scratch_dir(spark, "indexer")).transform(orders).distinct()
