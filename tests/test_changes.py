"""Table changes on small literal tables."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakeloom.operators import changes as ch


@pytest.fixture
def students(spark):
    return spark.createDataFrame(
        [(1, "Yve", 1.0), (2, "Omar", 2.5), (3, "Elia", 3.3), (4, "Ted", 4.7), (5, "Tiffany", 5.5), (6, "Vini", 6.3)],
        "id int, name string, value double",
    )


@pytest.fixture
def beans(spark):
    return spark.createDataFrame(
        [("black", "black", 500.0, True), ("lentils", "brown", 1000.0, True), ("jelly", "rainbow", 42.5, False),
         ("pinto", "brown", 1.5, True), ("green", "green", 178.3, True), ("beanbag chair", "white", 40000.0, False)],
        "name string, color string, grams float, delicious boolean",
    )


def test_students_script(spark, students, rows):
    raised = ch.update_where(students, "name LIKE 'T%'", {"value": "value + 1"})
    assert (5, "Tiffany", 6.5) in rows(raised) and (4, "Ted", 5.7) in rows(raised)
    kept = ch.delete_where(raised, "value > 6")
    assert [r[0] for r in rows(kept)] == [1, 2, 3, 4]
    updates = spark.createDataFrame(
        [(2, "Omar", 15.2, "update"), (3, "", None, "delete"), (7, "Blue", 7.7, "insert"), (11, "Diya", 8.8, "update")],
        "id int, name string, value double, type string",
    )
    merged = ch.merge(
        kept, updates, ["id"],
        matched=[ch.Update(when="s.type = 'update'"), ch.Delete(when="s.type = 'delete'")],
        not_matched=[ch.Insert(when="s.type = 'insert'")],
    )
    assert rows(merged) == [(1, "Yve", 1.0), (2, "Omar", 15.2), (4, "Ted", 5.7), (7, "Blue", 7.7)]
    assert rows(ch.delete_where(merged)) == []


def test_beans_script(spark, beans, rows):
    tasty = ch.update_where(beans, "name = 'jelly'", {"delicious": F.lit(True)})
    weighed = ch.update_where(tasty, "name = 'pinto'", {"grams": F.lit(1500)})
    assert round(weighed.agg(F.sum("grams")).first()[0], 1) == 43220.8
    kept = ch.delete_where(weighed, "delicious = false")
    assert kept.count() == 5
    new = spark.createDataFrame(
        [("black", "black", 60.5, True), ("lentils", "green", 500.0, True), ("kidney", "red", 387.2, True),
         ("castor", "brown", 25.0, False)],
        "name string, color string, grams float, delicious boolean",
    )
    merged = ch.merge(
        kept, new, ["name", "color"],
        matched=[ch.Update(set={"grams": "t.grams + s.grams"})],
        not_matched=[ch.Insert(when="s.delicious = true")],
    )
    names = {(r[0], r[1]): r[2] for r in rows(merged)}
    assert len(names) == 7 and names["black", "black"] == 560.5
    assert ("lentils", "green") in names and ("castor", "brown") not in names


def test_null_predicate_changes_nothing(students, rows):
    assert rows(ch.update_where(students, "CAST(NULL AS BOOLEAN)", {"value": F.lit(0)})) == rows(students)
    assert rows(ch.delete_where(students, "CAST(NULL AS BOOLEAN)")) == rows(students)


def test_updates_see_the_old_row(spark, rows):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(ch.update_where(df, "true", {"a": "b", "b": "a"})) == [(2, 1)]


def test_merge_refuses_two_source_rows_for_one_target_row(spark, students):
    source = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], students.schema)
    with pytest.raises(PySparkException, match="several source rows"):
        ch.merge(students, source, ["id"], matched=[ch.Update()]).collect()


def test_merge_keeps_duplicate_inserts_and_null_keys(spark, rows):
    target = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, v string")
    source = spark.createDataFrame([(1, "new"), (2, "a"), (2, "b"), (None, "c")], "k int, v string")
    merged = ch.merge(target, source, ["k"], matched=[ch.Update()], not_matched=[ch.Insert()])
    assert rows(merged) == sorted(
        [(1, "new"), (1, "new"), (None, "z"), (2, "a"), (2, "b"), (None, "c")], key=repr
    )


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_merge_without_and_with_broadcast(spark, rows, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        target = spark.range(100).select("id", F.lit(0).alias("v"))
        source = spark.range(50, 150).select("id", F.lit(1).alias("v"))
        merged = ch.merge(target, source, ["id"], matched=[ch.Update()], not_matched=[ch.Insert()])
        assert merged.count() == 150 and merged.agg(F.sum("v")).first()[0] == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_first_true_clause_wins_and_null_is_false(spark, students, rows):
    source = spark.createDataFrame([(1, None, 9.0), (2, "x", 9.0)], students.schema)
    merged = ch.merge(
        students, source, ["id"],
        matched=[ch.Update(set={"name": F.lit("first")}, when="s.name = 'x'"), ch.Update(set={"name": F.lit("second")})],
    )
    assert [r[1] for r in rows(merged)][:2] == ["second", "first"]


@pytest.fixture
def feed(spark):
    return spark.createDataFrame(
        [("a", 1, "INSERT", 10), ("a", 3, "UPDATE", 30), ("a", 2, "UPDATE", 20),
         ("b", 1, "INSERT", 1), ("b", 2, "DELETE", None), ("c", 1, "DELETE", None), ("c", 2, "INSERT", 7)],
        "k string, seq int, op string, v int",
    )


def test_apply_changes(feed, rows):
    state = ch.apply_changes(feed, ["k"], ["seq"], "op = 'DELETE'", drop=["op", "seq"])
    assert rows(state) == [("a", 30), ("c", 7)]


def test_apply_changes_ignores_row_order(feed, rows):
    one = ch.latest_by(feed.orderBy("seq"), ["k"], ["seq"])
    other = ch.latest_by(feed.orderBy(F.desc("seq")), ["k"], ["seq"])
    assert rows(one) == rows(other)


@pytest.fixture
def log(spark):
    return spark.createDataFrame(
        [(1, 1, "insert", "a"), (2, 1, "insert", "b"), (1, 2, "update", "a2"), (2, 3, "delete", "b"),
         (3, 3, "insert", "c"), (2, 4, "insert", "b4")],
        "id int, version int, op string, v string",
    )


def test_as_of_every_version(log, rows):
    states = [rows(ch.as_of(log, ["id"], n)) for n in range(5)]
    assert states == [[], [(1, "a"), (2, "b")], [(1, "a2"), (2, "b")], [(1, "a2"), (3, "c")],
                      [(1, "a2"), (2, "b4"), (3, "c")]]


@pytest.mark.parametrize("version", [0, 1, 2, 3, 4])
def test_restore_to_any_version(log, rows, version):
    restored = log.unionByName(ch.restore_changes(log, ["id"], version, 5))
    assert rows(ch.as_of(restored, ["id"], 5)) == rows(ch.as_of(log, ["id"], version))
    assert rows(ch.as_of(restored, ["id"], 4)) == rows(ch.as_of(log, ["id"], 4))


def test_purge_keeps_later_versions(log, rows):
    kept = ch.purge(log, ["id"], 3)
    for version in (3, 4):
        assert rows(ch.as_of(kept, ["id"], version)) == rows(ch.as_of(log, ["id"], version))
    assert rows(kept.union(ch.superseded(log, ["id"], 3))) == rows(log)
    assert kept.count() < log.count()


def test_history(log, rows):
    assert rows(ch.history(log)) == [(1, 2, 0, 0), (2, 0, 1, 0), (3, 1, 0, 1), (4, 1, 0, 0)]


def test_generated_column(spark, rows):
    df = spark.createDataFrame([(1, 2), (2, 4)], "a int, b int")
    assert rows(ch.with_generated(df, {"b": "a * 2"})) == [(1, 2), (2, 4)]
    assert rows(ch.with_generated(df.drop("b"), {"b": "a * 2"})) == [(1, 2), (2, 4)]
    with pytest.raises(PySparkException, match="given value differs"):
        ch.with_generated(df, {"b": "a * 3"}).collect()


def test_enforce_leaves_nothing_behind(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "id int, v int")
    assert rows(ch.violations(df, {"positive": "v > 0"}, ["v"])) == [("positive", 1), ("v not null", 1)]
    out = str(tmp_path / "checked")
    with pytest.raises(PySparkException, match="constraint violated"):
        ch.enforce(df, {"positive": "v > 0"}).write.parquet(out)
    # a task cancelled late may still leave an attempt file below _temporary, which no reader sees
    assert not list((tmp_path / "checked").glob("part-*.parquet"))
    assert spark.read.schema(df.schema).parquet(out).isEmpty()
    assert ch.enforce(df.where("id <> 2"), {"positive": "v > 0"}).count() == 2  # null passes a check


def test_match_schema(spark):
    target = spark.createDataFrame([], "a int, b string")
    assert ch.match_schema(spark.createDataFrame([("x", 1)], "b string, a int"), target).columns == ["a", "b"]
    wider = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, c double")
    with pytest.raises(ValueError, match="extra"):
        ch.match_schema(wider, target)
    assert ch.match_schema(wider, target, evolve=True).columns == ["a", "b", "c"]
    with pytest.raises(ValueError, match="a is bigint"):
        ch.match_schema(spark.createDataFrame([(1, "x")], "a bigint, b string"), target)


def test_sync_rows(log, rows):
    copy = log.where("version <= 2")
    assert rows(copy.union(ch.sync_rows(log, copy, ["id", "version"]))) == rows(log)
    assert ch.sync_rows(log, log, ["id", "version"]).isEmpty()


def test_merge_refuses_unknown_columns(spark):
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    for clauses in ({"matched": [ch.Update(set={"vv": "s.v"})]}, {"not_matched": [ch.Insert(values={"idd": "s.id"})]}):
        with pytest.raises(ValueError, match="no column"):
            ch.merge(target, target, ["id"], **clauses)


def test_schema_of_all_values(spark):
    from lakeloom.functions.nested import parse_like

    texts = spark.createDataFrame([('{"a": 1}',), ('{"b": {"c": "x"}, "a": 2.5}',), (None,), ("no json",), ('{"d": [1, 2]}',)], "t string")
    got = parse_like(texts, "t").select("json.a", "json.b.c", "json.d").collect()
    assert [r.c for r in got] == [None, "x", None, None, None] and [float(r.a) for r in got if r.a is not None] == [1.0, 2.5]
    assert got[4].d == [1, 2]
    assert parse_like(texts.where("t IS NULL"), "t").count() == 1
