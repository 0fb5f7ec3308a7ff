"""Delimited lines by their own headers, and schemas that grow."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from lakeloom.sources.delimited import follow_loaded, load_csv, read_loaded, rescue_csv, with_headers
from lakeloom.sources.evolving import grown, ingest_evolving, read_evolving, rescued_entries, schema_versions
from lakeloom.sources.ingest import rescue_json
from lakeloom.streaming.run import run_to_table

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


@pytest.mark.parametrize("header, line, row, rescued", [
    ("a,b", "1,x", (1, "x"), None),
    ("a,b", "1,", (1, None), None),
    ("a,b", '1,""', (1, ""), None),
    ("a,b", '1,"x, ""y"""', (1, 'x, "y"'), None),
    ("b,a", "x,1", (1, "x"), None),
    ("a,b", "one,x", (None, "x"), {"a": "one"}),
    ("a,b", "1,x,more", (1, "x"), {"_extra_3": "more"}),
    ("a,b,c", "1", (1, None), {"_missing": "b,c"}),
    ("a,c", "1,2", (1, None), {"c": "2"}),
    ("a,,a", "1,2,3", (1, None), {"_extra_2": "2", "_extra_3": "3"}),
    ('"a"," b "', "1,x", (1, "x"), None),
    ("﻿a,b", "1,x", (1, "x"), None),
    ("a,b", '1,"x', (None, None), {"_line": '1,"x'}),
    ("a,b", '1,"x"y', (None, None), {"_line": '1,"x"y'}),
    ("a,b", '1,5" pipe', (1, '5" pipe'), None),
    (None, "1,x", (None, None), {"_line": "1,x"}),
])
def test_rescued_cells(spark, header, line, row, rescued):
    lines = spark.createDataFrame([("f", header, line)], "file string, _header string, value string")
    got = rescue_csv(lines, SCHEMA).first()
    assert got["file"] == "f" and (got["a"], got["b"]) == row
    assert (json.loads(got["_rescued_data"]) if got["_rescued_data"] else None) == rescued


def test_names_of_a_header_are_found_once_for_each_file(spark, rows):
    lines = spark.createDataFrame(
        [("f", 0, "a,b"), ("f", 0, "1,x"), ("f", 9, "one,y"), ("g", 0, "b,a,c"), ("g", 0, "z,2,3")],
        "source_file string, _start long, value string").coalesce(1)
    read = rescue_csv(with_headers(lines), SCHEMA)
    assert rows(read.select("a", "b", "_rescued_data")) == [(1, "x", None), (2, "z", '{"c":"3"}'), (None, "y", '{"a":"one"}')]
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    per_line = plan[:plan.index("Join")]
    assert per_line.count("regexp_extract_all(") == 1


def test_other_separator(spark):
    lines = spark.createDataFrame([("a|b", '1|"x|y"')], "_header string, value string")
    assert tuple(rescue_csv(lines, SCHEMA, sep="|").first())[:2] == (1, "x|y")


def test_files_by_their_own_headers(spark, tmp_path, rows):
    feed, out = tmp_path / "in", str(tmp_path / "out")
    feed.mkdir()
    (feed / "one.csv").write_text("a,b\n1,x\n\na,b\n2,y\n")  # a blank line, and a data line like the header
    (feed / "two.csv").write_text("b,new,a\ny,7,3\n")
    (feed / "header.csv").write_text("a,b\n")
    (feed / "empty.csv").write_text("")
    # the large file comes in several blocks, of which only the first has the header
    (feed / "large.csv").write_text("b,a\n" + "".join(f"z,{i}\n" for i in range(20_000)))
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        load_csv(spark, str(feed), SCHEMA, out, str(tmp_path / "check"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    got = read_loaded(spark, out)
    assert rows(got.where("b <> 'z' or b is null").select("a", "b", "_rescued_data")) == sorted(
        [(1, "x", None), (None, "b", '{"a":"a"}'), (2, "y", None), (3, "y", '{"new":"7"}')], key=repr)
    assert tuple(got.where("b = 'z'").agg(F.count("*"), F.sum("a")).first()) == (20_000, sum(range(20_000)))
    # nothing is read twice, a batch that comes again is not written again, and a stream may follow
    assert load_csv(spark, str(feed), SCHEMA, out, str(tmp_path / "check")) == 0
    again = str(tmp_path / "check_again")
    load_csv(spark, str(feed), SCHEMA, out, again)
    assert read_loaded(spark, out).count() == got.count() == 20_004
    run_to_table(follow_loaded(spark, out, "a bigint, b string"), str(tmp_path / "copy"), str(tmp_path / "copied"))
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 20_004


def test_schema_grows_and_widens(spark, tmp_path, rows):
    feed, out = tmp_path / "in", str(tmp_path / "out")
    feed.mkdir()

    def arrive(name, *lines):
        (feed / name).write_text("\n".join(map(json.dumps, lines)) + "\n")
        return ingest_evolving(spark, str(feed), out, "a int, b string").simpleString()

    assert arrive("1", {"a": 1, "b": "x"}) == "struct<a:int,b:string>"
    assert arrive("2", {"a": 2, "n": 5, "t": "z", "o": {"k": 1}}, {"a": 3, "n": 6, "f": True, "t": "5"}) == "struct<a:int,b:string,f:boolean,n:bigint,o:string,t:string>"
    assert arrive("3", {"a": 1 << 40, "n": 7}, {"a": 4, "n": "seven"}) == "struct<a:bigint,b:string,f:boolean,n:bigint,o:string,t:string>"
    assert arrive("4", {"a": 5}) == schema_versions(spark, out)[-1].simpleString()
    assert len(schema_versions(spark, out)) == 3
    got = read_evolving(spark, out).select("a", "b", "n", "t", "f", "o", "_rescued_data")
    assert rows(got) == sorted([
        (1, "x", None, None, None, None, None), (2, None, 5, "z", None, '{"k":1}', None), (3, None, 6, "5", True, None, None),
        (1 << 40, None, 7, None, None, None, None), (4, None, None, None, None, None, '{"n":"seven"}'), (5, None, None, None, None, None, None)], key=repr)


def test_a_line_that_is_no_object_makes_no_field(spark, tmp_path):
    feed, out = tmp_path / "in", str(tmp_path / "out")
    feed.mkdir()
    (feed / "1").write_text('broken\n{"a": 1}\n')
    assert ingest_evolving(spark, str(feed), out, "a int").simpleString() == "struct<a:int>"
    assert {(r.a, r._rescued_data) for r in read_evolving(spark, out).collect()} == {(None, '{"_line":"broken"}'), (1, None)}


def test_a_line_is_not_parsed_again_for_each_field(spark):
    lines = spark.range(3).select(F.to_json(F.struct(F.col("id").alias("a"), F.lit("x").alias("new"))).alias("value"))
    schema = T.StructType.fromDDL("a int, b string, c double, d long")
    seen = rescue_json(lines, schema)
    assert [tuple(r) for r in rescued_entries(seen).collect()] == [("new", "x")] * 3

    def parses(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("from_json(")

    assert parses(rescued_entries(seen)) <= parses(seen) + 1


@pytest.mark.parametrize("texts, kind", [
    (["1", "22"], "bigint"), (["1", "2.5", "NaN", "-Infinity", "1e3"], "double"), (["NaN"], "double"), (["1", "view"], "string"),
    (["true", "false"], "boolean"), (["true", "1"], "string"), (["2024-01-01", "2024-01-02 03:04:05"], "timestamp"), ([""], "string"), (["y"], "string")])
def test_first_type_that_takes_all_values(spark, texts, kind):
    rows = spark.createDataFrame([(json.dumps({"n": t}),) for t in texts], "_rescued_data string")
    assert grown(rows, T.StructType.fromDDL("a int"))["n"].dataType.simpleString() == kind
