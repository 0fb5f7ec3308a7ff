import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation, functions as F

from lakeloom.operators import quality as q


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "a@x.com"), (2, None), (None, "c@x.com"), (4, "bad")], "id int, email string"
    )


def test_warn_keeps_and_counts(people, tmp_path):
    seen = Observation()
    rules = [q.Rule("has_id", "id IS NOT NULL"), q.Rule("mail", "email LIKE '%@%'")]
    q.apply_rules(people, rules, seen).write.parquet(str(tmp_path / "out"))
    assert seen.get == {"rows": 4, "has_id": 1, "mail": 2}  # a null condition counts as broken


def test_drop(people, rows):
    assert q.apply_rules(people, [q.Rule("mail", "email LIKE '%@%'", "drop")]).count() == 2


@pytest.mark.parametrize("observed", [False, True])
def test_a_drop_does_not_hide_a_failure(spark, observed):
    both_broken = spark.createDataFrame([(None, None), (1, "x")], "id int, op string")
    rules = [q.Rule("op", "op IS NOT NULL", "drop"), q.Rule("id", "id IS NOT NULL", "fail")]
    with pytest.raises(PySparkException, match="rule id failed"):
        q.apply_rules(both_broken, rules, Observation() if observed else None).collect()


def test_observation_counts_dropped_rows_too(people, tmp_path):
    seen = Observation()
    q.apply_rules(people, [q.Rule("mail", "email LIKE '%@%'", "drop")], seen).write.parquet(str(tmp_path / "out"))
    assert seen.get == {"rows": 4, "mail": 2}


def test_report_and_event_log(people, rows):
    rules = [q.Rule("has_id", "id IS NOT NULL"), q.Rule("mail", "email LIKE '%@%'")]
    report = q.rule_report(people, rules, "people").withColumns({"u": F.lit("u1"), "at": F.lit("2024")})
    totals = q.expectation_totals(q.progress_events(report, "u", "at"))
    assert rows(totals) == [("people", "has_id", 3, 1), ("people", "mail", 2, 2)]


def test_contract(people, rows):
    checks = dict(rows(q.check_table(people, {"id": "int", "email": "bigint"}, rows=5)))
    assert checks == {"columns": True, "type of id": True, "type of email": False, "row count": False}


def test_contract_of_values_and_name(spark, people, rows):
    people.createOrReplaceTempView("contract_people")
    mails = spark.createDataFrame([("bad",), (None,), ("c@x.com",), ("a@x.com",)], "m string")
    kinds = dict(people.dtypes)
    checks = dict(rows(q.check_table(people, kinds, name="contract_people", values={"email": mails})))
    assert checks["table exists"] and checks["values of email"]
    checks = dict(rows(q.check_table(people, kinds, name="no_such_table", values={"email": mails.limit(3)})))
    assert not checks["table exists"] and not checks["values of email"]


def test_masks(spark, people, rows):
    members = spark.createDataFrame([("ann", "analysts"), ("bob", "others"), ("ann", "analysts")], "user string, group string")
    readers = spark.createDataFrame([("ann", 1), ("bob", 1), ("eve", 1), ("eve", 1), ("joe", 2)], "user string, team int")
    masks = {"email": q.partial_mask("email", 3)}
    people = people.withColumn("team", F.lit(1))
    seen = q.policy_view(people, readers, "team", masks, members, "analysts", "id IS NOT NULL").drop("team")
    assert dict(rows(seen.groupBy("user").count())) == {"ann": 4, "bob": 3, "eve": 3}
    assert q.policy_view(people, readers.limit(0), "team", masks, members, "analysts").count() == 0
    masked = seen.where("user = 'bob'")
    assert ("****com" in {r[1] for r in rows(masked)}) and ("bad" in {r[1] for r in rows(masked)})


def test_pairs_of_one_group_are_spread_over_tasks(spark, rows):
    readers = spark.range(60).select(F.concat(F.lit("r"), "id").alias("user"), F.lit(1).alias("team"))
    members = readers.where("user < 'r3'").select("user", F.lit("staff").alias("group"))
    table = spark.range(500).select("id", F.concat(F.lit("name"), "id").alias("name"), F.lit(1).alias("team"))
    seen = q.policy_view(table, readers, "team", {"name": F.lit("?")}, members, "staff", "id % 5 = 0", pairs_per_task=500)
    sizes = seen.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) > 10 and max(r["count"] for r in sizes) < 5000
    inside = {r.user for r in members.collect()}
    want = [(1, i, f"name{i}" if f"r{u}" in inside else "?", f"r{u}") for i in range(500) for u in range(60) if f"r{u}" in inside or i % 5 == 0]
    assert sorted(rows(seen)) == sorted(want)


def _dealt_rows(plan):
    """Rows that the exchanges of a plan that ran have written."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _dealt_rows(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _dealt_rows(plan.plan())
    own = plan.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(_dealt_rows(plan.children().apply(i)) for i in range(plan.children().size()))


def test_a_large_group_does_not_copy_the_readers_of_others(spark, rows):
    readers = spark.range(2100).select(F.when(F.col("id") != 7, F.concat(F.lit("r"), "id")).alias("user"), F.when(F.col("id") != 8, F.greatest(F.col("id") - 99, F.lit(0))).alias("team"))
    members = readers.where("user like '%5'").select("user", F.lit("staff").alias("group"))
    table = spark.range(900).select("id", F.concat(F.lit("name"), "id").alias("name"), F.greatest(F.col("id") - 499, F.lit(0)).alias("team"))
    seen = q.policy_view(table, readers, "team", {"name": F.lit("?")}, members, "staff", "id % 5 = 0", pairs_per_task=500)
    got = rows(seen)
    want = []
    for r in readers.collect():
        inside = (r.user or "").endswith("5")
        held = [] if r.team is None else range(500) if r.team == 0 else [r.team + 499] if r.team <= 400 else []
        want += [(r.team, i, f"name{i}" if inside else "?", r.user) for i in held if inside or i % 5 == 0]
    assert got == sorted(want, key=repr)
    assert _dealt_rows(seen._jdf.queryExecution().executedPlan()) < 40_000
