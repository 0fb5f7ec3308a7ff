"""Row rules with metrics, table contracts, and masked views."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from lakeloom.operators.joins import placed_anew


#: What counts as an e-mail address: one @, no spaces, and a dot before the last letters.
EMAIL_PATTERN = "^[^@ ]+@[^@ ]+[.][A-Za-z]{2,}$"


@dataclass(frozen=True)
class Rule:
    """A named condition; ``action`` is ``warn``, ``drop`` or ``fail``.

    A row whose condition is null breaks the rule.
    """

    name: str
    condition: str
    action: str = "warn"

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def apply_rules(df: DataFrame, rules: list[Rule], observation: Observation | str | None = None) -> DataFrame:
    """Apply all rules in one pass.

    ``fail`` stops the job at the first bad row, so its write is not committed;
    ``drop`` removes rows; ``warn`` only counts. With an observation, the counts
    of broken rules come out of the same job; a stream takes the observation's name.
    """
    kept = F.lit(True)
    for rule in rules:
        if rule.action == "drop":
            kept = kept & rule.holds()
    # the failing rules come first in one expression, so no drop can hide a failure
    passes = None
    for rule in rules:
        if rule.action == "fail":
            error = F.raise_error(F.lit(f"rule {rule.name} failed")).cast("boolean")
            passes = F.when(~rule.holds(), error) if passes is None else passes.when(~rule.holds(), error)
    if observation is not None:
        checked = df if passes is None else df.where(passes.otherwise(True))
        counts = [F.count_if(~r.holds()).alias(r.name) for r in rules]
        return checked.observe(observation, F.count(F.lit(1)).alias("rows"), *counts).where(kept)
    return df.where(kept if passes is None else passes.otherwise(kept))


def rule_report(df: DataFrame, rules: list[Rule], dataset: str, by: list[str] = ()) -> DataFrame:
    """Passed and failed rows per rule (and per group), from one aggregation."""
    counts = [F.count_if(r.holds()).alias(f"p{i}") for i, r in enumerate(rules)]
    totals = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *counts)
    entries = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("name"),
                F.lit(dataset).alias("dataset"),
                F.col(f"p{i}").alias("passed_records"),
                (F.col("_rows") - F.col(f"p{i}")).alias("failed_records"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return totals.select(*by, F.inline(entries))


EXPECTATION_SCHEMA = (
    "array<struct<name: string, dataset: string, passed_records: bigint, failed_records: bigint>>"
)


def progress_events(report: DataFrame, update_id: str, at: str) -> DataFrame:
    """Event-log rows for a report: one per update, with the counts as JSON details.

    An update has one entry per rule and dataset, so the array is as long as the rule list.
    """
    entry = F.struct("name", "dataset", "passed_records", "failed_records")
    return (
        report.groupBy(F.col(update_id).alias("update_id"))
        .agg(F.max(at).alias("timestamp"), F.array_sort(F.collect_list(entry)).alias("expectations"))
        .select(
            F.lit("flow_progress").alias("event_type"),
            "timestamp",
            F.struct("update_id").alias("origin"),
            F.to_json(
                F.struct(F.struct(F.struct("expectations").alias("data_quality")).alias("flow_progress"))
            ).alias("details"),
        )
    )


def record_counts(spark: SparkSession, log: str, dataset: str, rules: list[Rule], counts: dict[str, int], update_id: str) -> None:
    """Add to the event log in folder ``log`` what an update of a dataset observed: rows, and broken rows per rule."""
    rows = counts.get("rows", 0)
    entries = [{"name": r.name, "dataset": dataset, "passed_records": rows - counts.get(r.name, 0), "failed_records": counts.get(r.name, 0)} for r in rules]
    counted = F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in e.items())) for e in sorted(entries, key=lambda e: e["name"])))
    progress = F.struct(F.struct(F.struct(counted.alias("expectations")).alias("data_quality")).alias("flow_progress"))
    log_events(spark, log, update_id, {"flow_progress": F.to_json(progress)})


def log_events(spark: SparkSession, log: str, update_id: str, details: dict[str, Column]) -> None:
    """Add events of an update (kind: JSON details) to the event log in folder ``log``."""
    kinds = F.inline(F.array(*(F.struct(F.lit(kind).alias("event_type"), detail.alias("details")) for kind, detail in details.items())))
    rows = spark.range(1).select(kinds).select(
        "event_type", F.current_timestamp().alias("timestamp"), F.struct(F.lit(update_id).alias("update_id")).alias("origin"), "details")
    rows.coalesce(1).write.mode("append").parquet(log)


def record_start(spark: SparkSession, log: str, dataset: str, inputs: list[str], update_id: str) -> None:
    """Add to the event log who has started an update, and what the dataset is made of."""
    action = F.struct(F.struct(F.lit("START").alias("action"), F.current_user().alias("user_name")).alias("user_action"))
    lineage = F.struct(F.struct(F.lit(dataset).alias("output_dataset"), F.array(*map(F.lit, inputs)).alias("input_datasets")).alias("flow_definition"))
    log_events(spark, log, update_id, {"user_action": F.to_json(action), "flow_definition": F.to_json(lineage)})


def latest_update(log: DataFrame) -> DataFrame:
    """The rows of the update that was logged last."""
    last = log.agg(F.max_by("origin.update_id", "timestamp").alias("update_id"))
    return log.join(last, F.col("origin.update_id") == F.col("update_id")).drop("update_id")


def expectation_totals(log: DataFrame) -> DataFrame:
    """Passed and failed rows per dataset and rule over an event log (see ``latest_update`` for one update)."""
    raw = F.get_json_object("details", "$.flow_progress.data_quality.expectations")
    entries = log.where("event_type = 'flow_progress'").select(
        F.inline(F.from_json(raw, EXPECTATION_SCHEMA))
    )
    return entries.groupBy("dataset", "name").agg(
        F.sum("passed_records").alias("passing_records"), F.sum("failed_records").alias("failing_records")
    )


def check_table(
    df: DataFrame, types: dict[str, str], rows: int | None = None, name: str | None = None,
    values: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """A table contract: one row per expectation with ``ok``.

    Names and types come from the schema; the row count is one aggregate.
    ``name`` must be a table or view of the catalog. ``values`` gives the values
    a column must hold, in any order, as a frame of one column: both sets are
    aggregated together, so neither leaves the executors.
    """
    actual = dict(df.dtypes)
    tests = [("columns", F.lit(set(actual) == set(types)))]
    tests += [(f"type of {c}", F.lit(actual.get(c) == t)) for c, t in types.items()]
    if name is not None:
        tests.append(("table exists", F.lit(df.sparkSession.catalog.tableExists(name))))
    if rows is not None:
        tests.append(("row count", F.col("_rows") == rows))
    totals = df.agg(F.count(F.lit(1)).alias("_rows"))
    for i, (c, wanted) in enumerate((values or {}).items()):
        sides = df.select(F.col(c).alias("v"), F.lit(1).alias("side")).unionByName(
            wanted.select(F.col(wanted.columns[0]).alias("v"), F.lit(2).alias("side")))
        met = sides.groupBy("v").agg(F.min("side").alias("low"), F.max("side").alias("high"))
        totals = totals.join(met.agg(F.count_if(F.col("low") == F.col("high")).alias(f"_unlike{i}")))  # one row beside one row
        tests.append((f"values of {c}", F.col(f"_unlike{i}") == 0))
    return totals.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("expectation"), ok.alias("ok")) for n, ok in tests]))
    )


def policy_view(
    df: DataFrame, readers: DataFrame, on: str, masks: dict[str, Column], members: DataFrame, group: str, row_filter: str | None = None,
    pairs_per_task: int = 10_000_000,
) -> DataFrame:
    """What each reader gets of the rows that share its value of ``on``: all of them if the membership table has the
    reader in the group, else the permitted ones with masked columns.

    ``readers`` has the columns user and ``on``, ``members`` user and group. Membership is looked up inside the
    plan, once per reader, and no reader reaches the driver. A row is masked once and not for each of its readers.
    The answer has a row for each pair, many times the input. The pairs of one value of ``on`` are cut into blocks of
    ``side`` rows by ``side`` readers, and tasks are dealt by blocks: what is copied for that is the pairs divided by half
    the ``side``, and only the number of pairs reaches the driver. A block's readers are one array, so a row meets them all by one lookup.
    """
    inside = members.where(F.col("group") == group).select("user").distinct().withColumn("_inside", F.lit(True))
    known = readers.select("user", on).distinct().join(placed_anew(inside, ["user"]), "user", "left").withColumn("_inside", F.coalesce("_inside", F.lit(False)))
    permitted = F.coalesce(F.expr(row_filter), F.lit(False)) if row_filter else F.lit(True)
    forms = df.withColumn("_inside", F.explode(F.array(F.lit(True), F.lit(False)))).where(F.col("_inside") | permitted)
    forms = forms.withColumns({c: F.when(F.col("_inside"), F.col(c)).otherwise(mask) for c, mask in masks.items()})

    seen_by = known.groupBy(on, "_inside").agg(F.count(F.lit(1)).alias("readers"))
    sizes = forms.groupBy(on, "_inside").agg(F.count(F.lit(1)).alias("rows")).join(seen_by, [on, "_inside"])
    pairs = sizes.agg(F.sum(F.col("rows").cast("double") * F.col("readers"))).first()[0]
    tasks = max(1, math.ceil((pairs or 0) / pairs_per_task))
    side = max(1, math.isqrt(pairs_per_task) // 2)  # a task has four blocks, as the most even ones still fall on some tasks twice
    parts = placed_anew(sizes, [on, "_inside"]).select(on, "_inside", F.ceil(F.col("rows") / side).alias("_high"), F.ceil(F.col("readers") / side).alias("_wide")).hint("shuffle_hash")
    def spread(number: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(number) - 1))

    dealt = forms.join(parts, [on, "_inside"]).withColumn("_row", F.pmod(F.xxhash64(*df.columns), "_high")).withColumn("_column", spread("_wide"))
    packs = known.join(parts, [on, "_inside"]).withColumn("_column", F.pmod(F.xxhash64("user"), "_wide"))
    packs = packs.groupBy(on, "_inside", "_column", "_high").agg(F.collect_list(F.struct("user"))["user"].alias("_users")).withColumn("_row", spread("_high"))

    def placed(side: DataFrame, *columns: str) -> DataFrame:
        at = side.select(F.struct(on, "_inside", "_row", "_column").alias("_at"), *columns)
        return at.withColumn("_block", F.xxhash64("_at")).repartition(tasks, "_block")

    # joined by the column that deals the tasks, else a constant ``on`` would have the blocks dealt anew; two places of one hash don't meet
    rows, packed = placed(dealt, *df.columns).alias("rows"), placed(packs, "_users").alias("packed")
    same = (F.col("rows._block") == F.col("packed._block")) & (F.col("rows._at") <= F.col("packed._at")) & (F.col("rows._at") >= F.col("packed._at"))
    met = rows.join(packed.hint("shuffle_hash"), same)
    return met.select(on, *(c for c in df.columns if c != on), F.explode("_users").alias("user"))


def partial_mask(column: str, shown: int = 2) -> Column:
    """All but the last characters replaced by ``*``."""
    c = F.col(column)
    hidden = F.greatest(F.length(c) - shown, F.lit(0))
    return F.concat(F.repeat(F.lit("*"), hidden), F.right(c, F.lit(shown)))
