"""Scalar, collection, JSON and user-defined functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import udfs
from lakeloom.functions.nested import json_field, lines, parse_like, words
from lakeloom.suite.base import query, table
from lakeloom.suite.standins import ITEMS, USERS, sales_documents, users

# -- dates and times ----------------------------------------------------------


@query("F01_date_format", """SELECT event_id, strftime(ts, '%b %-d, %Y') AS day, strftime(ts, '%H:%M:%S.%f') AS at FROM events""")
def date_format(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.date_format("ts", "MMM d, yyyy").alias("day"),
        F.date_format("ts", "HH:mm:ss.SSSSSS").alias("at"),
    )


@query("F02_epoch", """SELECT event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS seconds, epoch_us(ts) AS micros,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS from_seconds, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS from_micros FROM events""")
def epoch(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("t"))
    seconds, micros = F.unix_timestamp("t"), F.unix_micros("t")
    return events.select(
        "event_id",
        seconds.alias("seconds"),
        micros.alias("micros"),
        F.from_unixtime(seconds).alias("from_seconds"),
        F.date_format(F.timestamp_micros(micros), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("from_micros"),
    )


@query("F03_date_parts", """SELECT event_id, year(ts) AS y, month(ts) AS m, dayofweek(ts) + 1 AS dow, minute(ts) AS mi,
    second(ts) AS s FROM events""")
def date_parts(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.dayofweek("ts").alias("dow"),
        F.minute("ts").alias("mi"), F.second("ts").alias("s"),
    )


@query("F04_to_date", """SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders""")
def to_date(spark, sf):
    return table(spark, sf, "orders").select(F.to_date("o_orderdate").cast("string").alias("day")).distinct()


@query("F05_date_arithmetic", """SELECT o_orderkey, strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m-%d') AS later,
    strftime(o_orderdate + INTERVAL 3 MONTH, '%Y-%m-%d') AS quarter_on FROM orders""")
def date_arithmetic(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_add("o_orderdate", 2).cast("string").alias("later"),
        F.add_months("o_orderdate", 3).cast("string").alias("quarter_on"),
    )


@query("F06_date_trunc", """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, count(*) AS n FROM events GROUP BY 1""")
def date_trunc(spark, sf):
    hourly = table(spark, sf, "events").groupBy(F.date_trunc("hour", "ts").alias("h")).count()
    return hourly.select(F.date_format("h", "yyyy-MM-dd HH").alias("hour"), F.col("count").alias("n"))


@query("F07_current_timestamp", "SELECT count(*) AS n, TRUE AS one_instant, TRUE AS after_data FROM events")
def current_timestamp(spark, sf):
    stamped = table(spark, sf, "events").withColumn("now", F.current_timestamp())
    return stamped.agg(
        F.count("*").alias("n"),
        (F.min("now") == F.max("now")).alias("one_instant"),
        F.bool_and(F.col("now") > F.col("ts").cast("timestamp")).alias("after_data"),
    )


# -- text and numbers ---------------------------------------------------------


@query("F08_regexp", f"""WITH {USERS} SELECT user_id, regexp_extract(email, '@(.+)', 1) AS domain,
    regexp_replace(email, '[0-9]+', '#', 'g') AS hidden FROM users""")
def regexp(spark, sf):
    return users(spark, sf).select(
        "user_id",
        F.regexp_extract("email", "(?<=@).+", 0).alias("domain"),
        F.regexp_replace("email", "[0-9]+", "#").alias("hidden"),
    )


@query("F09_split", f"WITH {USERS} SELECT user_id, string_split(email, '@')[1] AS handle FROM users")
def split(spark, sf):
    return users(spark, sf).select("user_id", F.split("email", "@", 0)[0].alias("handle"))


@query("F10_text", """SELECT p_partkey, lower(p_brand) AS low, ltrim('  ' || p_name) AS trimmed,
    translate(p_name, 'aeiou', '12345') AS coded FROM part""")
def text(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        F.lower("p_brand").alias("low"),
        F.ltrim(F.concat(F.lit("  "), "p_name")).alias("trimmed"),
        F.translate("p_name", "aeiou", "12345").alias("coded"),
    )


@query("F11_concat_mask", """SELECT c_custkey, repeat('*', length(c_name) - 2) || right(c_name, 2) AS masked FROM customer""")
def concat_mask(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", F.expr("concat(repeat('*', length(c_name) - 2), right(c_name, 2))").alias("masked")
    )


@query("F12_round", """SELECT o_orderkey, round(o_totalprice / 3, 2) AS cents, round(o_totalprice / 3, 0) AS whole FROM orders""")
def round_half_up(spark, sf):
    third = F.col("o_totalprice") / 3
    return table(spark, sf, "orders").select(
        "o_orderkey", F.round(third, 2).alias("cents"), F.round(third, 0).alias("whole")
    )


@query("F13_math", """SELECT event_id, CAST(ceil(value) AS BIGINT) AS up, round(cos(value), 6) AS c, round(ln(value), 6) AS l,
    round(sqrt(value), 6) AS r FROM events WHERE value > 0""")
def math(spark, sf):
    return table(spark, sf, "events").where("value > 0").select(
        "event_id", F.ceil("value").alias("up"), F.round(F.cos("value"), 6).alias("c"),
        F.round(F.log("value"), 6).alias("l"), F.round(F.sqrt("value"), 6).alias("r"),
    )


@query("F14_random_int", "SELECT count(*) AS n, TRUE AS in_range FROM events")
def random_int(spark, sf):
    pings = table(spark, sf, "events").withColumn("ping", (F.rand(5) * 250).cast("int"))
    return pings.agg(F.count("*").alias("n"), ((F.min("ping") >= 0) & (F.max("ping") < 250)).alias("in_range"))


# -- collections --------------------------------------------------------------


@query("C01_explode", f"""WITH {ITEMS} SELECT p_type, count(*) AS n, CAST(sum(qty) AS BIGINT) AS quantity
    FROM items JOIN part ON item_id = p_partkey GROUP BY p_type""")
def explode(spark, sf):
    items = sales_documents(spark, sf).select(F.explode("items").alias("item"))
    part = table(spark, sf, "part")
    return (
        items.join(part, F.col("item.item_id") == part.p_partkey)
        .groupBy("p_type")
        .agg(F.count("*").alias("n"), F.sum("item.qty").cast("bigint").alias("quantity"))
    )


@query("C03_contains_element_at", """SELECT doc_id, list_contains(string_split(text, ' '), 'the') AS has_the,
    string_split(text, ' ')[2] AS second, string_split(text, ' ')[-1] AS final FROM documents""")
def contains_element_at(spark, sf):
    return table(spark, sf, "documents").withColumn("w", words("text")).select(
        "doc_id",
        F.array_contains("w", "the").alias("has_the"),
        F.try_element_at("w", F.lit(2)).alias("second"),
        F.element_at("w", -1).alias("final"),
    )


@query("C04_flatten_distinct", r"""SELECT doc_id, len(list_distinct(flatten(list_transform(string_split(text, chr(10)),
    lambda x: string_split(x, ' '))))) AS n_distinct FROM documents""")
def flatten_distinct(spark, sf):
    per_line = F.transform(lines("text"), lambda line: F.split(line, " "))
    return table(spark, sf, "documents").select(
        "doc_id", F.size(F.array_distinct(F.flatten(per_line))).cast("bigint").alias("n_distinct")
    )


@query("C05_filter", """SELECT doc_id, array_to_string(list_filter(string_split(text, ' '), lambda w: length(w) >= 12), ' ') AS long_words
    FROM documents WHERE len(list_filter(string_split(text, ' '), lambda w: length(w) >= 12)) > 0""")
def filter_items(spark, sf):
    long_words = F.filter(words("text"), lambda w: F.length(w) >= 12)
    return (
        table(spark, sf, "documents").select("doc_id", long_words.alias("found"))
        .where(F.size("found") > 0)
        .select("doc_id", F.array_join("found", " ").alias("long_words"))
    )


@query("C06_transform", f"""WITH {ITEMS} SELECT 'P' || CAST(item_id AS VARCHAR) AS code, count(*) AS n FROM items GROUP BY 1""")
def transform(spark, sf):
    codes = F.transform("items.item_id", lambda i: F.concat(F.lit("P"), i.cast("string")))
    return sales_documents(spark, sf).select(F.explode(codes).alias("code")).groupBy("code").agg(F.count("*").alias("n"))


@query("C07_exists", """SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x: length(x) > 200)) > 0 AS has_long_line,
    len(list_filter(string_split(text, chr(10)), lambda x: contains(x, 'http'))) > 0 AS has_link FROM documents""")
def exists(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        F.exists(lines("text"), lambda x: F.length(x) > 200).alias("has_long_line"),
        F.exists(lines("text"), lambda x: F.contains(x, F.lit("http"))).alias("has_link"),
    )


@query("C08_reduce", """SELECT doc_id, CAST(list_sum(list_transform(string_split(text, ' '), lambda w: length(w))) AS BIGINT) AS letters
    FROM documents""")
def reduce(spark, sf):
    letters = F.aggregate(words("text"), F.lit(0).cast("bigint"), lambda total, w: total + F.length(w), lambda x: x)
    return table(spark, sf, "documents").select("doc_id", letters.alias("letters"))


@query("C09_field_of_array", f"""WITH {ITEMS} SELECT order_id, max(price) AS top_price, len(list(DISTINCT item_id)) AS kinds
    FROM items GROUP BY order_id""")
def field_of_array(spark, sf):
    per_document = sales_documents(spark, sf).select(
        "order_id", F.array_max("items.price").alias("top"), F.explode(F.array_distinct("items.item_id")).alias("item")
    )
    return per_document.groupBy("order_id").agg(
        F.max("top").alias("top_price"), F.count_distinct("item").alias("kinds")
    )


# -- JSON ---------------------------------------------------------------------


@query("N01_json_path", """SELECT CAST(json_extract_string(props, '$.k') AS INT) AS k, count(*) AS n FROM events GROUP BY 1""")
def json_path(spark, sf):
    events = table(spark, sf, "events")
    by_path = events.select(json_field("props", "k").cast("int").alias("k"), "props")
    same = F.expr("variant_get(parse_json(props), '$.k', 'int')")
    return by_path.where(F.col("k") == same).groupBy("k").agg(F.count("*").alias("n"))


@query("N02_from_json", f"""WITH {ITEMS} SELECT order_id, count(*) AS n, round(sum(price), 2) AS total FROM items GROUP BY order_id""")
def from_json(spark, sf):
    texts = sales_documents(spark, sf).select("order_id", F.to_json("items").alias("payload"))
    schema = "array<struct<item_id: bigint, price: double, qty: double, curr: string>>"
    items = texts.select("order_id", F.inline(F.from_json("payload", schema)))
    return items.groupBy("order_id").agg(F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("total"))


@query("N03_schema_of_json", """SELECT CAST(sum(CAST(json_extract_string(props, '$.k') AS INT)) AS BIGINT) AS total, count(*) AS n FROM events""")
def schema_of_json(spark, sf):
    parsed = parse_like(table(spark, sf, "events"), "props")
    return parsed.agg(F.sum("json.k").alias("total"), F.count("json").alias("n"))


# -- user-defined functions ---------------------------------------------------


@query("X01_sql_function", """SELECT p_partkey, p_name || ': ' || CAST(p_size * 12 AS VARCHAR) || ' a dozen' AS message
    FROM part""")
def sql_function(spark, sf):
    udfs.create_sql_function(
        spark, "lakeloom_dozen(item STRING, price INT)", "STRING", "concat(item, ': ', price * 12, ' a dozen')",
    )
    return spark.sql("SELECT p_partkey, lakeloom_dozen(p_name, p_size) AS message FROM {part}", part=table(spark, sf, "part"))


@query("X02_sql_function_case", """SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'on offer'
    WHEN p_size > 40 THEN 'too large: ' || p_name ELSE 'take ' || p_name END AS advice FROM part""")
def sql_function_case(spark, sf):
    udfs.create_sql_function(
        spark, "lakeloom_advice(kind STRING, item STRING, size INT)", "STRING",
        """CASE WHEN kind = 'PROMO' THEN 'on offer' WHEN size > 40 THEN concat('too large: ', item)
           ELSE concat('take ', item) END""",
    )
    return spark.sql("SELECT p_partkey, lakeloom_advice(p_type, p_name, p_size) AS advice FROM {part}", part=table(spark, sf, "part"))


@query("X07_described_functions", """WITH used AS (SELECT p_name || ': ' || CAST(p_size * 12 AS VARCHAR) AS dozen,
      CASE WHEN p_type = 'PROMO' THEN 'on offer' WHEN p_size > 40 THEN 'too large: ' || p_name ELSE 'take ' || p_name END AS advice FROM part)
    SELECT 'lakeloom_dozen' AS name, 'item STRING, price INT' AS input, 'STRING' AS returns, count(*) AS uses, count(DISTINCT dozen) AS results FROM used
    UNION ALL SELECT 'lakeloom_advice', 'kind STRING, item STRING, size INT', 'STRING', count(*), count(DISTINCT advice) FROM used""")
def described_functions(spark, sf):
    # what the catalog says of two functions, beside what they give
    dozen = sql_function(spark, sf).agg(F.count("*").alias("uses"), F.count_distinct("message").alias("results")).withColumn("name", F.lit("lakeloom_dozen"))
    advice = sql_function_case(spark, sf).agg(F.count("*").alias("uses"), F.count_distinct("advice").alias("results")).withColumn("name", F.lit("lakeloom_advice"))
    described = udfs.function_facts(spark, "lakeloom_dozen").unionByName(udfs.function_facts(spark, "lakeloom_advice"))
    return described.join(dozen.unionByName(advice), "name").select("name", "input", "returns", "uses", "results")


@query("X03_sql_function_random", "SELECT user_id, count(*) AS n, TRUE AS in_range FROM events GROUP BY user_id")
def sql_function_random(spark, sf):
    udfs.create_sql_function(spark, "lakeloom_ping()", "INT", "int(rand() * 250)")
    udfs.create_sql_function(spark, "lakeloom_active()", "BOOLEAN", "rand() > 0.25")
    return spark.sql(
        """SELECT user_id, count(*) AS n, min(ping) >= 0 AND max(ping) < 250 AND count(active) = count(*) AS in_range
           FROM (SELECT user_id, lakeloom_ping() AS ping, lakeloom_active() AS active FROM {events}) GROUP BY user_id""",
        events=table(spark, sf, "events"),
    )


_LETTERS = "SELECT left(p_name, 1) AS letter, count(*) AS n FROM part GROUP BY 1"


@query("X04_row_udf", _LETTERS)
def row_udf(spark, sf):
    letters = table(spark, sf, "part").select(udfs.first_letter_by_row()("p_name").alias("letter"))
    return letters.groupBy("letter").agg(F.count("*").alias("n"))


@query("X05_registered_udf", _LETTERS)
def registered_udf(spark, sf):
    spark.udf.register("lakeloom_letter", udfs.first_letter_by_row())
    return spark.sql(
        "SELECT letter, count(*) AS n FROM (SELECT lakeloom_letter(p_name) AS letter FROM {part}) GROUP BY letter",
        part=table(spark, sf, "part"),
    )


@query("X06_vectorised_udf", _LETTERS)
def vectorised_udf(spark, sf):
    spark.udf.register("lakeloom_letter_batch", udfs.first_letter_by_batch())
    letters = table(spark, sf, "part").select(F.expr("lakeloom_letter_batch(p_name)").alias("letter"))
    return letters.groupBy("letter").agg(F.count("*").alias("n"))
