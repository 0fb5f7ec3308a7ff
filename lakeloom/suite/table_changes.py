"""Updates, deletes, merges, versions, layout, and rules on write."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import changes as ch, clones
from lakeloom.operators.layout import file_spans, optimize
from lakeloom.session import scratch_database, scratch_dir
from lakeloom.sources.sinks import rewrite_partitions
from lakeloom.suite.base import query, table
from lakeloom.suite.standins import CHANGE_FEED, USERS, USERS_DIRTY, change_feed, users, users_dirty


@query("T01_update", """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority LIKE '1%' THEN round(o_totalprice + 1, 2)
    ELSE o_totalprice END AS o_totalprice FROM orders""")
def update(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    raised = ch.update_where(orders, "o_orderpriority LIKE '1%'", {"o_totalprice": "round(o_totalprice + 1, 2)"})
    return ch.update_where(raised, "CAST(NULL AS BOOLEAN)", {"o_orderstatus": F.lit("?")}).drop("o_orderpriority")


@query("T02_delete", f"""WITH {USERS_DIRTY} SELECT user_id, email, balance FROM users_dirty
    WHERE NOT coalesce(email LIKE '%building.com' OR balance < 100, FALSE)""")
def delete(spark, sf):
    dirty = users_dirty(spark, sf)
    kept = ch.delete_where(dirty, "email LIKE '%building.com' OR balance < 100")
    return kept.union(ch.delete_where(dirty))  # without a predicate nothing is left


@query("T02_delete_in_partitions", """SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS revenue FROM orders
    WHERE o_orderstatus = 'O' OR (o_orderstatus = 'F' AND o_totalprice >= 100000) GROUP BY o_orderstatus""")
def delete_in_partitions(spark, sf):
    name = f"{scratch_database(spark)}.orders"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    orders.write.partitionBy("o_orderstatus").saveAsTable(name)
    rewrite_partitions(
        spark, name, "o_orderstatus", ["F", "P"],
        lambda rows: ch.delete_where(rows, "o_orderstatus = 'P' OR o_totalprice < 100000"), scratch_dir(spark, "staged"),
    )
    return spark.table(name).groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("revenue")
    )


@query("T03_merge_insert_only", """SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0
    OR c_mktsegment = 'BUILDING'""")
def merge_insert_only(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    target = customer.where("c_acctbal > 0").drop("c_acctbal")
    return ch.insert_missing(target, customer, ["c_custkey"], when="s.c_mktsegment = 'BUILDING'")


@query("T04_merge_clauses", """WITH last AS (SELECT user_id AS id, arg_max(event_type, (ts, event_id)) AS type,
      arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id),
    target AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS value FROM customer WHERE c_mktsegment <> 'BUILDING')
    SELECT t.id, t.name, CASE WHEN last.type IN ('purchase', 'click') THEN last.value ELSE t.value END AS value
      FROM target t LEFT JOIN last ON t.id = last.id WHERE last.type IS DISTINCT FROM 'error'
    UNION ALL SELECT id, NULL, value FROM last WHERE type = 'signup' AND id NOT IN (SELECT id FROM target)""")
def merge_clauses(spark, sf):
    target = table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_acctbal AS value"
    )
    events = table(spark, sf, "events").selectExpr("user_id AS id", "ts", "event_id", "event_type AS type", "value")
    source = ch.latest_by(events, ["id"], ["ts", "event_id"]).select("id", "type", "value")
    return ch.merge(
        target, source, ["id"],
        matched=[ch.Update(when="s.type IN ('purchase', 'click')"), ch.Delete(when="s.type = 'error'")],
        not_matched=[ch.Insert(when="s.type = 'signup'")],
    )


@query("T05_merge_expression", """SELECT l_partkey, l_returnflag, CAST(sum(l_quantity) AS BIGINT) AS qty FROM lineitem
    GROUP BY l_partkey, l_returnflag""")
def merge_expression(spark, sf):
    lines = table(spark, sf, "lineitem")

    def totals(status):
        part = lines.where(F.col("l_linestatus") == status).groupBy("l_partkey", "l_returnflag")
        return part.agg(F.sum("l_quantity").cast("bigint").alias("qty"))

    return ch.merge(
        totals("O"), totals("F"), ["l_partkey", "l_returnflag"],
        matched=[ch.Update(set={"qty": "t.qty + s.qty"})],
        not_matched=[ch.Insert(values={"l_partkey": "s.l_partkey", "l_returnflag": "s.l_returnflag", "qty": "s.qty"})],
    )


@query("T06_merge_conditional_update", f"""WITH {USERS} SELECT user_id, email FROM users""")
def merge_conditional_update(spark, sf):
    people = users(spark, sf).select("user_id", "email", "balance")
    stale = people.where("balance < 5000").select(
        "user_id", F.when(F.col("balance") >= 0, F.col("email")).alias("email")
    )
    return ch.merge(
        stale, people.drop("balance"), ["user_id"],
        matched=[ch.Update(set={"email": "s.email"}, when="t.email IS NULL AND s.email IS NOT NULL")],
        not_matched=[ch.Insert()],
    )


STATE = f"""{CHANGE_FEED}, ranked AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY seq_us DESC, seq_id DESC) AS rn
      FROM change_feed WHERE operation IS NOT NULL),
    state AS (SELECT customer_id, name, email, state, seq_us, seq_id FROM ranked WHERE rn = 1 AND operation <> 'DELETE')"""


@query("T07_apply_changes", f"WITH {STATE} SELECT * FROM state")
def apply_changes(spark, sf):
    feed = change_feed(spark, sf).where("operation IS NOT NULL")
    return ch.apply_changes(
        feed, ["customer_id"], ["seq_us", "seq_id"], "operation = 'DELETE'", drop=["operation"]
    )


# -- versions: one version per day of events, keyed by user ------------------------


def change_log(spark, sf):
    op = F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "error", "delete")
    events = table(spark, sf, "events").select(
        "user_id", F.dayofmonth("ts").alias("version"), "ts", "event_id", op.alias("op"), "value"
    )
    last = ch.latest_by(events.fillna("update", ["op"]), ["user_id", "version"], ["ts", "event_id"])
    return last.select("user_id", "version", "op", "value")


LOG = """log0 AS (SELECT *, day(ts) AS version, CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete'
      ELSE 'update' END AS op FROM events),
    log AS (SELECT user_id, version, arg_max(op, (ts, event_id)) AS op, arg_max(value, (ts, event_id)) AS value
      FROM log0 GROUP BY user_id, version)"""


def _as_of_sql(version):
    return f"""SELECT user_id, value FROM (SELECT user_id, arg_max(op, version) AS op, arg_max(value, version) AS value
        FROM log WHERE version <= {version} GROUP BY user_id) WHERE op <> 'delete'"""


@query("T08_as_of", f"WITH {LOG} {_as_of_sql(12)}")
def as_of(spark, sf):
    return ch.as_of(change_log(spark, sf), ["user_id"], 12)


@query("T09_history", f"""WITH {LOG} SELECT version, count(*) FILTER (WHERE op = 'insert') AS inserted,
    count(*) FILTER (WHERE op = 'update') AS updated, count(*) FILTER (WHERE op = 'delete') AS deleted FROM log GROUP BY version""")
def history(spark, sf):
    return ch.history(change_log(spark, sf))


@query("T09_restore", f"WITH {LOG} {_as_of_sql(12)}")
def restore(spark, sf):
    path = scratch_dir(spark, "log")
    change_log(spark, sf).write.parquet(path)
    log = spark.read.parquet(path)
    newest = log.agg(F.max("version")).first()[0]
    restored = log.unionByName(ch.restore_changes(log, ["user_id"], 12, newest + 1))
    return ch.as_of(restored, ["user_id"], newest + 1)


@query("T11_purge", f"""WITH {LOG}, horizon AS (SELECT user_id, max(version) AS h FROM log WHERE version <= 20 GROUP BY user_id)
    SELECT log.version < coalesce(h, 0) AS purged, count(*) AS n FROM log LEFT JOIN horizon USING (user_id) GROUP BY 1""")
def purge(spark, sf):
    log = change_log(spark, sf)
    dry_run = ch.superseded(log, ["user_id"], 20).withColumn("purged", F.lit(True))
    kept = ch.purge(log, ["user_id"], 20).withColumn("purged", F.lit(False))
    return dry_run.unionByName(kept).groupBy("purged").agg(F.count("*").alias("n"))


@query("T12_clone", f"WITH {LOG} SELECT user_id, version, op, value FROM log")
def clone(spark, sf):
    log = change_log(spark, sf)
    path = scratch_dir(spark, "clone")
    log.where("version <= 15").write.parquet(path)
    copied = spark.read.parquet(path)
    ch.sync_rows(log, copied, ["user_id", "version"]).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def _damaged_clone(spark, sf):
    """A clone that lacks each nation's first customer, holds a stale balance of its last, and has kept a customer of each segment that is gone."""
    source = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    ends = source.groupBy("c_nationkey").agg(F.min("c_custkey").alias("least"), F.max("c_custkey").alias("most"))
    stale = source.join(ends, "c_nationkey").where("c_custkey <> least").withColumn(
        "c_acctbal", F.when(F.col("c_custkey") == F.col("most"), F.col("c_acctbal") - 1).otherwise(F.col("c_acctbal"))).select(*source.columns)
    gone = source.groupBy("c_mktsegment").agg(F.max("c_custkey").alias("k")).join(source.drop("c_mktsegment"), F.col("k") == F.col("c_custkey")).select(
        (F.col("c_custkey") + 1_000_000).alias("c_custkey"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    name = f"{scratch_database(spark)}.customers"
    clones.clone_table(stale.unionByName(gone), ["c_custkey"], name)
    return source, name


@query("T12_clone_repair", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def clone_repair(spark, sf):
    source, name = _damaged_clone(spark, sf)
    clones.resync_clone(spark, source, name, ["c_custkey"], scratch_dir(spark, "repair"))
    return spark.table(name).drop(clones.BUCKET)


@query("T12_clone_differences", """SELECT 'missing' AS difference, count(*) AS n, TRUE AS some_buckets_unread, TRUE AS whole_after FROM (SELECT min(c_custkey) FROM customer GROUP BY c_nationkey)
    UNION ALL SELECT 'changed', count(*), TRUE, TRUE FROM (SELECT max(c_custkey) AS k, min(c_custkey) AS l FROM customer GROUP BY c_nationkey) WHERE k <> l
    UNION ALL SELECT 'vanished', count(DISTINCT c_mktsegment), TRUE, TRUE FROM customer""")
def clone_differences(spark, sf):
    source, name = _damaged_clone(spark, sf)
    unlike, found = clones.resync_clone(spark, source, name, ["c_custkey"], scratch_dir(spark, "repair"))
    again, _ = clones.resync_clone(spark, source, name, ["c_custkey"], scratch_dir(spark, "repair"))
    return found.groupBy("difference").agg(
        F.count("*").alias("n"), F.lit(0 < len(unlike) < 256).alias("some_buckets_unread"), F.lit(not again).alias("whole_after"))


# -- layout ---------------------------------------------------------------------


@query("T10_optimize", """SELECT count(*) AS n, round(sum(l_quantity), 2) AS quantity, CAST(sum(l_orderkey) AS BIGINT) AS keys,
    TRUE AS fewer_files, TRUE AS narrower FROM lineitem""")
def optimize_table(spark, sf):
    lines = table(spark, sf, "lineitem")
    small, clustered = scratch_dir(spark, "small"), scratch_dir(spark, "clustered")
    files = max(8, -(-lines.count() // 1_000_000))  # a task sorts one file's rows, whatever the table's size
    lines.repartition(3 * files).write.parquet(small)
    optimize(spark.read.parquet(small), clustered, ["l_partkey", "l_quantity"], files=files)

    def summary(path):
        spans = file_spans(spark.read.parquet(path), "l_partkey")
        return spans.agg(F.count("*").alias("files"), F.avg(F.col("high") - F.col("low")).alias("span"))

    rows = spark.read.parquet(clustered).agg(
        F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.sum("l_orderkey").alias("keys")
    )
    return spark.sql(
        """SELECT n, quantity, keys,
                  (SELECT files FROM {after}) < (SELECT files FROM {before}) AS fewer_files,
                  (SELECT span FROM {after}) < (SELECT span FROM {before}) AS narrower FROM {rows}""",
        rows=rows, before=summary(small), after=summary(clustered),
    )


# -- rules on write ---------------------------------------------------------------


@query("T13_generated_column", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day, round(o_totalprice / 2, 4) AS half FROM orders""")
def generated_column(spark, sf):
    rules = {"order_day": "date_format(o_orderdate, 'yyyy-MM-dd')", "half": "round(o_totalprice / 2, 4)"}
    orders = table(spark, sf, "orders").withColumn("order_day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return ch.with_generated(orders, rules).select("o_orderkey", "order_day", "half")


@query("T14_constraints", """SELECT 'recent' AS constraint_name, count(*) FILTER (WHERE o_orderdate <= TIMESTAMP '1996-01-01') AS violations FROM orders
    UNION ALL SELECT 'o_orderkey not null', count(*) FILTER (WHERE o_orderkey IS NULL) FROM orders
    UNION ALL SELECT 'positive', count(*) FILTER (WHERE o_totalprice <= 0) FROM orders""")
def constraints(spark, sf):
    orders = table(spark, sf, "orders")
    path = scratch_dir(spark, "checked")
    ch.enforce(orders, {"positive": "o_totalprice > 0"}, not_null=["o_orderkey"]).write.parquet(path)
    checks = {"positive": "o_totalprice > 0", "recent": "o_orderdate > to_timestamp_ntz('1996-01-01')"}
    return ch.violations(spark.read.parquet(path), checks, not_null=["o_orderkey"])


@query("T15_schema_evolution", """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL AS nation FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, s_nationkey FROM supplier""")
def schema_evolution(spark, sf):
    target = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance")
    wider = table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS id", "s_name AS name", "s_acctbal AS balance", "s_nationkey AS nation"
    )
    matched = ch.match_schema(wider.select(target.columns), target)
    evolved = ch.match_schema(wider, target, evolve=True)
    # both forms hold the same suppliers; the evolved one adds its column to the table
    return target.unionByName(evolved, allowMissingColumns=True).where(
        F.lit(matched.schema == target.schema)
    )
