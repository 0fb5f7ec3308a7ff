"""Results kept up to date: group counts, added counts, updates, clones, sketches, plans."""

import random

from pyspark.sql import functions as F

from lakeloom.operators import clones
from lakeloom.operators.changes import apply_changes
from lakeloom.operators.plan_facts import executed, plan_facts
from lakeloom.session import scratch_database, scratch_dir
from lakeloom.sources.ingest import file_stream
from lakeloom.streaming.updates import compact_updates, read_added, read_updates, rows_per_batch, run_added, run_updates
from lakeloom.streaming.views import compact_moves, group_counts, run_group_counts
from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"
FEED = "k bigint, s bigint, g string, op string"


def test_group_counts_after_batches_in_any_order(spark, tmp_path, rows):
    r = random.Random(7)
    # one hot key, deletes, null groups, late older rows; sequence numbers are unique
    feed = [(1 if r.random() < 0.3 else r.randrange(60), s, r.choice(["a", "b", "c", None]), r.choice(["D", "U", "U", "U"])) for s in range(3000)]
    r.shuffle(feed)
    folder, out = str(tmp_path / "in"), str(tmp_path / "moves")
    for part in (feed[:1000], feed[1000:1400], feed[1400:]):
        spark.createDataFrame(part, FEED).repartition(3).write.mode("append").parquet(folder)
        stream = file_stream(spark, folder, "parquet", FEED)
        run_group_counts(stream, ["k"], ["s"], "g", "op = 'D'", out, str(tmp_path / "check"), state_partitions=3)
    now = apply_changes(spark.createDataFrame(feed, FEED), ["k"], ["s"], "op = 'D'", drop=["op"])
    want = rows(now.groupBy("g").agg(F.count("*").alias("n")))
    assert rows(group_counts(spark, out, "g")) == want
    compact_moves(spark, out, str(tmp_path / "compacted"), "g")
    assert rows(group_counts(spark, str(tmp_path / "compacted"), "g")) == want
    assert spark.read.parquet(out).count() < 600  # moves, not changes


def test_updates_cost_the_groups_they_touch(spark, tmp_path, rows):
    folder, log, added = str(tmp_path / "in"), str(tmp_path / "log"), str(tmp_path / "added")
    for lot in (range(100), range(90, 95)):
        spark.createDataFrame([(i, 1) for i in lot], "k bigint, v bigint").write.mode("append").parquet(folder)
        stream = file_stream(spark, folder, "parquet", "k bigint, v bigint")
        run_updates(stream.groupBy("k").agg(F.sum("v").alias("v")), log, str(tmp_path / "c1"), state_partitions=2)
        run_added(stream, ["k"], [F.sum("v").alias("v")], added, str(tmp_path / "c2"))
    assert rows(rows_per_batch(spark, log)) == [(0, 100), (1, 5)]
    want = sorted(((i, 1 + (90 <= i < 95)) for i in range(100)), key=repr)
    assert rows(read_updates(spark, log, ["k"])) == want == rows(read_added(spark, added, ["k"]))
    compact_updates(spark, log, str(tmp_path / "compacted"), ["k"])
    assert rows(read_updates(spark, [log, str(tmp_path / "compacted")], ["k"])) == want


def test_clone_of_rows_with_nulls_and_repeated_keys(spark, rows):
    schema = "k bigint, a string, b string"
    source = spark.createDataFrame([(1, "x", None), (2, None, "x"), (3, "p", "q"), (3, "p", "q"), (None, "n", None), (5, None, None)], schema)
    name = f"{scratch_database(spark)}.copy"
    clones.clone_table(source, ["k"], name, buckets=16)
    assert clones.unlike_buckets(source, spark.table(name), ["k"], 16) == []
    # a null that changed its place, one of two equal rows gone, a key gone, a key that is new
    after = spark.createDataFrame([(1, None, "x"), (2, None, "x"), (3, "p", "q"), (None, "n", None), (6, "new", None)], schema)
    unlike, report = clones.resync_clone(spark, after, name, ["k"], scratch_dir(spark, "resync"), buckets=16)
    assert 0 < len(unlike) <= 4
    assert rows(report) == sorted([(1, "changed"), (3, "changed"), (5, "vanished"), (6, "missing")], key=repr)
    assert rows(spark.table(name).drop(clones.BUCKET)) == rows(after)
    assert clones.resync_clone(spark, after, name, ["k"], scratch_dir(spark, "resync"), buckets=16)[0] == []


def test_stored_sketches_are_close(spark):
    got = {r["span"]: r["parts"] for r in queries()["A05_stored_sketches"](spark, SF).collect()}
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    spans = F.explode(F.array(F.date_format("l_shipdate", "yyyy-MM"), F.date_format("l_shipdate", "yyyy"), F.lit("all"))).alias("span")
    exact = {r["span"]: r["n"] for r in lines.select(spans, "l_partkey").groupBy("span").agg(F.count_distinct("l_partkey").alias("n")).collect()}
    # 2 ** 12 registers: a standard error of 1.6 %; three of them, and a little for small counts
    assert got.keys() == exact.keys() and all(abs(got[s] - n) <= 0.05 * n + 1 for s, n in exact.items())


def test_plan_facts_name_python_and_joins(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    longest = F.udf(lambda s: len(s), "int")
    df = orders.where(longest("o_orderpriority") > 5).groupBy("o_orderstatus").count()
    assert executed(df) == orders.where("length(o_orderpriority) > 5").select("o_orderstatus").distinct().count()
    facts = plan_facts(df)
    assert any(k == "python" for k, _ in facts) and ("exchange", "hashpartitioning(o_orderstatus)") in facts
    assert {d for k, d in facts if k == "column read"} == {"orders: o_orderpriority", "orders: o_orderstatus"}
