import json

import pytest
from pyspark.sql import functions as F, types as T

from lakeloom import session
from lakeloom.sources import files
from lakeloom.sources.ingest import ingest_schema, rescue_json
from lakeloom.sources.sinks import replace_table, rewrite_partitions, write_partitioned


def test_fail_fast_refuses_a_bad_line(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1,2.5\nx,y\n")
    read = spark.read.schema("a int, b double")
    assert read.csv(str(tmp_path)).count() == 2
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        read.option("mode", "FAILFAST").csv(str(tmp_path)).collect()


SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


@pytest.mark.parametrize("line, row, rescued", [
    ('{"a": 1, "b": "x"}', (1, "x"), None),
    ('{"a": 1}', (1, None), None),
    ('{"a": 1, "b": null}', (1, None), None),
    ('{"a": 1, "c": 2}', (1, None), {"c": "2"}),
    ('{"a": "one", "b": "x"}', (None, "x"), {"a": "one"}),
    ('{"a": "one", "c": {"d": 3}}', (None, None), {"a": "one", "c": '{"d":3}'}),
    ("not json", (None, None), {"_line": "not json"}),
])
def test_rescued_data(spark, line, row, rescued):
    lines = spark.createDataFrame([("f", line)], "file string, value string")
    got = rescue_json(lines, SCHEMA).first()
    assert got["file"] == "f" and (got["a"], got["b"]) == row
    assert (json.loads(got["_rescued_data"]) if got["_rescued_data"] else None) == rescued


def test_a_line_without_a_field_is_parsed_once_and_one_with_a_name_twice_is_kept(spark):
    lines = spark.createDataFrame([('{"a": 1}',), ('{"c": 1, "c": 2}',)], "value string")
    seen = rescue_json(lines, SCHEMA)
    assert [r[0] for r in seen.select("_rescued_data").collect()] == [None, '{"c":"1","c":"2"}']
    steps = seen._jdf.queryExecution().optimizedPlan().toString()
    assert steps.count("map_filter(") <= 1


def test_schema_of_ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.json").write_text('{"a": 1, "t": "5.5"}\n')
    path, location = str(tmp_path / "in"), str(tmp_path / "schema")
    assert ingest_schema(spark, path, "json").simpleString() == "struct<a:string,t:string>"
    assert ingest_schema(spark, path, "json", infer=True).simpleString() == "struct<a:bigint,t:string>"
    kept = ingest_schema(spark, path, "json", hints={"t": "double"}, location=location)
    assert kept.simpleString() == "struct<a:string,t:double>"
    (tmp_path / "in" / "y.json").write_text('{"new": 1}\n')
    assert ingest_schema(spark, path, "json", location=location) == kept


def test_message_round_trip(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, v string")
    message = files.encode_message(df, "id").select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    decoded = files.decode_message(message, "id int, v string")
    assert rows(decoded.select("json.*")) == rows(df)
    assert [r[0] for r in rows(decoded.select("key"))] == ["1", "2"]


def test_jdbc_options(spark, monkeypatch):
    """No database here: only what is handed to the reader."""
    from pyspark.sql.readwriter import DataFrameReader

    seen = {}
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, **kw: seen.update(kw, url=url, table=table))
    files.jdbc_table_partitioned(spark, "jdbc:x", "t", "id", 1, 1_000_000, 8, user="u")
    assert seen == {"url": "jdbc:x", "table": "t", "column": "id", "lowerBound": 1, "upperBound": 1_000_000,
                    "numPartitions": 8, "properties": {"user": "u"}}


def test_replace_table(spark, rows):
    name = f"{session.scratch_database(spark)}.t"
    replace_table(spark.range(3), name)
    replace_table(spark.range(2).withColumnRenamed("id", "other"), name)
    assert spark.table(name).columns == ["other"] and spark.table(name).count() == 2


def test_partition_overwrite_leaves_the_others(spark, tmp_path, rows):
    path = str(tmp_path / "p")
    write_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string"), path, ["k"])
    write_partitioned(spark.createDataFrame([(9, "b")], "v int, k string"), path, ["k"])
    assert rows(spark.read.parquet(path).select("v", "k")) == [(1, "a"), (9, "b")]


def test_rewrite_touches_only_its_partitions(spark, rows):
    name = f"{session.scratch_database(spark)}.t"
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "c")], "v int, k string")
    df.write.partitionBy("k").saveAsTable(name)
    untouched = [f for f in spark.table(name).where("k = 'a'").inputFiles()]
    rewrite_partitions(spark, name, "k", ["b", "c"], lambda d: d.where("v = 2"), session.scratch_dir(spark, "s"))
    assert rows(spark.table(name)) == [(1, "a"), (2, "b")]
    assert [f for f in spark.table(name).where("k = 'a'").inputFiles()] == untouched
    assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()} == {"k=a", "k=b"}


def test_rewrite_refuses_to_move_rows_and_may_empty_the_table(spark, rows):
    name = f"{session.scratch_database(spark)}.t"
    spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string").write.partitionBy("k").saveAsTable(name)
    with pytest.raises(ValueError, match="other partitions"):
        rewrite_partitions(spark, name, "k", ["b"], lambda d: d.withColumn("k", F.lit("a")), session.scratch_dir(spark, "s"))
    assert rows(spark.table(name)) == [(1, "a"), (2, "b")]
    rewrite_partitions(spark, name, "k", ["a", "b"], lambda d: d.where("false"), session.scratch_dir(spark, "s"))
    assert rows(spark.table(name)) == []


def test_a_failing_rewrite_leaves_the_table(spark, rows):
    name = f"{session.scratch_database(spark)}.t"
    spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string").write.partitionBy("k").saveAsTable(name)
    with pytest.raises(Exception, match="no good"):
        rewrite_partitions(
            spark, name, "k", ["b"], lambda d: d.where(F.raise_error(F.lit("no good")).cast("boolean")),
            session.scratch_dir(spark, "s"),
        )
    assert rows(spark.table(name)) == [(1, "a"), (2, "b")]


def test_scratch_is_below_the_shared_folder(spark):
    assert session.scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.scratch_dir(spark, "x") != session.scratch_dir(spark, "x")


def test_no_machine_local_scratch_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077", "applicationId": "a"})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Cluster(), "x")


def test_rewrite_of_quoted_and_null_partitions(spark, rows):
    name = f"{session.scratch_database(spark)}.t"
    df = spark.createDataFrame([(1, "it's"), (2, "a\\b"), (3, None), (4, "c")], "v int, k string")
    df.write.partitionBy("k").saveAsTable(name)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    rewrite_partitions(spark, name, "k", ["it's", "a\\b", None], lambda d: d.where("v = 2").withColumn("v", F.col("v") * 10), session.scratch_dir(spark, "s"))
    assert rows(spark.table(name)) == [(20, "a\\b"), (4, "c")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
