"""What the optimizer makes of the queries."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from lakeloom.functions import udfs
from lakeloom.sources.sinks import write_partitioned

SF = "/root/testdata/sf0.01"


@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_chained_and_repeated_filters_become_one(orders):
    df = orders.where("o_totalprice > 1000").where("o_orderstatus = 'F'").where("o_orderstatus = 'F'").select("o_orderkey")
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("Filter") == 1 and optimized.count("= F") == 1


def test_filters_and_columns_reach_the_scan(orders):
    plan = _physical(orders.where("o_orderstatus = 'F' AND o_totalprice > 1000").select("o_orderkey"))
    assert "EqualTo(o_orderstatus,F)" in plan and "GreaterThan(o_totalprice,1000.0)" in plan
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>", plan)


def test_a_cache_stands_between_filter_and_scan(orders):
    cached = orders.cache()
    try:
        cached.count()
        plan = _physical(cached.where("o_orderstatus = 'F'"))
        assert "InMemoryTableScan" in plan and plan.index("Filter") < plan.index("InMemoryTableScan")
    finally:
        orders.unpersist()


def test_partition_folders_are_pruned(spark, orders, tmp_path):
    path = str(tmp_path / "by_status")
    write_partitioned(orders, path, ["o_orderstatus"])
    df = spark.read.parquet(path).where("o_orderstatus = 'F'")
    assert re.search(r"PartitionFilters: \[[^\]]*o_orderstatus#\d+ = F", _physical(df))
    assert df.count() == orders.where("o_orderstatus = 'F'").count()


def test_sql_function_is_inlined_and_python_is_not(spark, orders):
    udfs.create_sql_function(spark, "half_of(x DOUBLE)", "DOUBLE", "x / 2")
    assert "Python" not in _physical(orders.select(F.expr("half_of(o_totalprice)")))
    assert "half_of" in " ".join(r[0] for r in udfs.describe_function(spark, "half_of").collect())
    assert "ArrowEvalPython" in _physical(orders.select(udfs.first_letter_by_row()("o_orderstatus")))
    assert "ArrowEvalPython" in _physical(orders.select(udfs.first_letter_by_batch()("o_orderstatus")))


def test_same_plan_for_sql_and_methods(spark, orders):
    by_method = orders.where("o_totalprice > 1000").select("o_orderkey")
    by_sql = spark.sql("SELECT o_orderkey FROM {o} WHERE o_totalprice > 1000", o=orders)
    assert by_method.sameSemantics(by_sql)


BATCH = [k for k in queries() if re.match("(P|D|J0[1-46-9]|A|O|U|F|C|N|T0[1-8]|T11|T13|E0[24567]|X|W02)", k)
         and k not in ("J05_stream_static_left", "J07_stream_stream", "T07_apply_changes_stream")]


@pytest.mark.parametrize("key", BATCH)
def test_no_pair_joins_and_partial_aggregates(spark, key):
    """With broadcasting off: no nested loops, no global windows, every aggregate has a map side."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _physical(queries()[key](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Window" not in plan
    assert plan.count("functions=[count") == 0 or "partial_count" in plan


def test_select_reads_only_its_columns(spark):
    plan = _physical(queries()["A03_agg_aliases"](spark, SF))
    schema = re.search(r"ReadSchema: struct<([^>]*)", plan).group(1)
    assert "l_shipdate" not in schema and "l_tax" not in schema and "l_orderkey" not in schema


def test_top_k_is_not_a_global_sort(spark):
    assert "TakeOrderedAndProject" in _physical(queries()["D09_limit"](spark, SF))


def test_partition_write_rebalances(spark, orders):
    assert "RebalancePartitions" in orders.hint("rebalance", "o_orderstatus")._jdf.queryExecution().optimizedPlan().toString()
