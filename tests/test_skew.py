"""One key holding most rows must neither fill one task nor change the answer."""

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import changes as ch
from lakeloom.operators.changes import latest_by
from lakeloom.operators.joins import outer_join_unique, placed_anew, salted_join, sort_rows
from lakeloom.operators.layout import (
    file_spans, optimize, range_code, with_z_order, z_value,
)
from lakeloom.operators.nesting import collect_distinct, pack_rows


@pytest.fixture
def skewed(spark):
    """20,000 rows, a third of them under key 0 and all alike there."""
    return spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("k"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"),
    )


def _exploded(packed):
    return packed.select("k", F.inline("items")).groupBy("k", "v").count()


def test_packs_are_bounded_and_whole(skewed, rows):
    packed = pack_rows(skewed, ["k"], ["v"], "items", max_items=1000)
    sizes = packed.select("k", F.size("items").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= 1100
    assert sizes.where("k = 0").count() >= 6
    assert rows(_exploded(packed)) == rows(skewed.groupBy("k", "v").count())


def test_a_key_of_many_packs_keeps_its_count(skewed):
    packed = pack_rows(skewed, ["k"], ["v"], "items", max_items=500)
    totals = {r.k: (r.n, r.size) for r in packed.groupBy("k").agg(
        F.max("n_items").alias("n"), F.sum(F.size("items")).alias("size")).collect()}
    assert totals[0][0] > 500 and all(n == size for n, size in totals.values())


def test_small_keys_stay_in_one_pack(skewed):
    packed = pack_rows(skewed.where("k > 0"), ["k"], ["v"], "items")
    assert packed.count() == packed.select("k").distinct().count()


def test_rows_of_small_keys_are_not_joined_with_their_counts(skewed):
    small = skewed.where("k > 0")
    packed = pack_rows(small, ["k"], ["v"], "items")
    assert tuple(packed.agg(F.sum(F.size("items")), F.sum("n_items")).first()) == (small.count(),) * 2
    packed.collect()
    plan = packed._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("Initial Plan")]
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "Join" not in final


def test_packs_of_rows_without_a_key(spark, rows):
    df = spark.createDataFrame([(1, 2), (None, 3), (1, None), (1, 1)], "k int, v int")
    assert rows(pack_rows(df, ["k"], ["v"], "items").select("k", "pack", "n_items", "items.v")) == [(1, 0, 3, [None, 1, 2])]


def test_collect_distinct(skewed, rows):
    got = collect_distinct(skewed, ["k"], "v", "vs")
    want = skewed.groupBy("k").agg(F.array_sort(F.collect_set("v")).alias("vs"))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, skewed, rows, how):
    facts = skewed.withColumn("i", F.monotonically_increasing_id())
    names = spark.range(0, 400).select(F.col("id").alias("e"), F.concat(F.lit("n"), "id").alias("name"))
    on = F.col("k") == F.col("e")
    assert rows(salted_join(facts, names, on, ["i"], how)) == rows(facts.join(names, on, how))
    with pytest.raises(ValueError):
        salted_join(facts, names, on, ["i"], "outer")


def test_salt_divides_a_hot_key(spark, skewed):
    facts = skewed.withColumn("i", F.monotonically_increasing_id()).where("k = 0")
    salts = facts.groupBy(F.pmod(F.xxhash64("i"), F.lit(8)).alias("s")).count()
    assert salts.count() == 8 and salts.agg(F.max("count")).first()[0] < facts.count() / 4


def test_outer_join_unique_equals_full_outer(spark, skewed, rows):
    entities = spark.range(300, 700).select(F.col("id").alias("k"), F.lit(True).alias("seen"))
    assert rows(outer_join_unique(skewed, entities, "k")) == rows(skewed.join(entities, "k", "outer"))


def test_equal_rows_are_sorted_over_several_partitions(spark, skewed):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = sort_rows(skewed.where("k = 0"), "k").groupBy(F.spark_partition_id().alias("p")).count()
        assert parts.count() > 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_latest_by_hot_key(skewed, rows):
    got = latest_by(skewed, ["k"], ["v"])
    assert rows(got) == rows(skewed.groupBy("k").agg(F.max("v").alias("v")))


def test_optimize_divides_a_hot_value(spark, skewed, tmp_path, rows):
    out = str(tmp_path / "clustered")
    optimize(skewed, out, ["k", "v"], files=6)
    spans = file_spans(spark.read.parquet(out), "k")
    sizes = [r["rows"] for r in spans.collect()]
    assert len(sizes) == 6 and max(sizes) < 2 * sum(sizes) / 6
    assert rows(spark.read.parquet(out).groupBy("k", "v").count()) == rows(skewed.groupBy("k", "v").count())


def test_optimize_counts_files_by_rows(spark, skewed, tmp_path):
    out = str(tmp_path / "sized")
    optimize(skewed, out, ["v"], rows_per_file=5000)
    assert file_spans(spark.read.parquet(out), "v").count() == 4


def test_z_value_interleaves_bits(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (1, 1), (2, 3)], "a bigint, b bigint")
    got = [r[0] for r in df.select(z_value([F.col("a"), F.col("b")], 2)).collect()]
    assert got == [0, 1, 2, 3, 0b1110]


def test_range_code_counts_the_cuts_below(spark):
    cuts = [1.0, 2.0, 2.5, 9.0, 10.0]
    values = [None, 0.0, 1.0, 1.5, 2.0, 2.5, 8.0, 9.0, 10.0, 99.0]
    df = spark.createDataFrame([(v,) for v in values], "x double").select("x", range_code(F.col("x"), cuts).alias("c"))
    for r in df.collect():
        assert r.c == (0 if r.x is None else sum(cut <= r.x for cut in cuts))


def test_z_order_without_any_value(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert with_z_order(df, ["a", "b"]).count() == 2


@pytest.mark.parametrize("values", [
    [f"{k}/customer-{i:05d}" for k in "ab" for i in range(500)], ["same", "same"], ["", "a", "é", "z" * 100, "z" * 100 + "1"],
])
def test_texts_are_cut_by_whole_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [(r.t, r._z) for r in with_z_order(df, ["t"]).collect()]
    assert [t for t, _ in sorted(got)] == [t for t, _ in sorted(got, key=lambda r: (r[1], r[0]))]
    assert len({z for _, z in got}) >= min(len(set(values)), 40)


def test_z_order_on_text_and_time(spark, tmp_path):
    df = spark.range(4000).select(
        F.concat(F.lit("name"), F.col("id") % 4).alias("event_name"),
        F.timestamp_seconds(F.lit(1540601000) + F.col("id")).alias("event_time"),
    )
    out = str(tmp_path / "events")
    optimize(df, out, ["event_name", "event_time"], files=4)
    spans = file_spans(spark.read.parquet(out), "event_name")
    assert spark.read.parquet(out).count() == 4000
    assert spans.where("low = 'name0' AND high = 'name3'").count() < 4


SKEW_SETTINGS = {
    "spark.sql.shuffle.partitions": "50",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.files.maxPartitionBytes": "50k",
    "spark.sql.files.openCostInBytes": "1k",
}


@pytest.fixture
def hot_table(spark, tmp_path):
    """60,000 rows over several files, a third of them under one key; joins must shuffle."""
    path = str(tmp_path / "hot")
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 900).alias("k"), F.col("id").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    rows.repartition(8).write.parquet(path)
    before = {k: spark.conf.get(k, None) for k in SKEW_SETTINGS}
    for k, v in SKEW_SETTINGS.items():
        spark.conf.set(k, v)
    yield spark.read.parquet(path)
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _final_plan(df):
    counted = df.groupBy().agg(*[F.max(F.col(c).cast("string")).alias(c) for c in df.columns])
    counted.collect()
    return counted._jdf.queryExecution().executedPlan().toString()


def test_merge_splits_a_hot_target_key(spark, hot_table):
    source = hot_table.groupBy("k").agg(F.max("v").alias("v"), F.max("text").alias("text"))
    merged = ch.merge(hot_table, source, ["k"], matched=[ch.Update(set={"v": "s.v"})])
    assert "skew=true" in _final_plan(merged)


def test_merge_splits_a_hot_source_key_of_inserts(spark, hot_table):
    target = hot_table.where("k > 0")
    merged = ch.merge(target, hot_table, ["k"], not_matched=[ch.Insert()])
    assert "skew=true" in _final_plan(merged)
    assert merged.count() == hot_table.count()


def test_outer_join_splits_a_hot_key(spark, hot_table):
    entities = hot_table.select("k").distinct().withColumn("seen", F.lit(True))
    assert "skew=true" in _final_plan(outer_join_unique(hot_table, entities, "k"))


def test_purge_splits_a_hot_key(spark, hot_table):
    log = hot_table.select("k", F.col("v").alias("version"), "text")
    assert "skew=true" in _final_plan(ch.purge(log, ["k"], 30_000))


def test_plain_join_of_an_aggregate_would_not_split(spark, hot_table):
    """Why ``placed_anew`` is there; should Spark learn to split this, it can go."""
    entities = hot_table.groupBy("k").agg(F.max("v").alias("top"))
    assert "skew=true" not in _final_plan(hot_table.join(entities, "k", "left"))
    assert "skew=true" in _final_plan(hot_table.join(placed_anew(entities, ["k"]), "k", "left"))


def test_a_task_of_the_clustering_job_sorts_a_million_rows_at_most_or_so(spark, tmp_path):
    out = str(tmp_path / "by_rows")
    optimize(spark.range(2_100_000).selectExpr("id % 1000 AS k"), out, ["k"])
    sizes = spark.read.parquet(out).groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(sizes) == 3 and max(r["count"] for r in sizes) < 1_500_000
