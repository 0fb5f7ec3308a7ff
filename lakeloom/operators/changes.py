"""Row changes on plain tables: each operator returns the changed table.

Parquet tables take no UPDATE, DELETE or MERGE, so the caller writes the
result to a new folder (or partition) and points readers at it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.operators.joins import placed_anew


def _col(expr: str | Column) -> Column:
    return F.expr(expr) if isinstance(expr, str) else expr


def update_where(target: DataFrame, predicate, assignments: dict[str, str | Column]) -> DataFrame:
    """Set columns where the predicate holds; a null predicate changes nothing."""
    hit = _col(predicate)
    types = {f.name: f.dataType for f in target.schema}
    return target.withColumns(
        {
            name: F.when(hit, _col(value).cast(types[name])).otherwise(F.col(name))
            for name, value in assignments.items()
        }
    )


def delete_where(target: DataFrame, predicate=None) -> DataFrame:
    """Drop rows where the predicate holds; without one, empty the table."""
    if predicate is None:
        return target.where(F.lit(False))
    return target.where(~F.coalesce(_col(predicate), F.lit(False)))


@dataclass(frozen=True)
class Update:
    """Matched clause. ``set`` None takes every column from the source."""

    set: dict[str, str | Column] | None = None
    when: str | Column | None = None


@dataclass(frozen=True)
class Delete:
    """Matched clause that removes the target row."""

    when: str | Column | None = None


@dataclass(frozen=True)
class Insert:
    """Not-matched clause. ``values`` None inserts every column by name."""

    values: dict[str, str | Column] | None = None
    when: str | Column | None = None


def _holds(when) -> Column:
    return F.lit(True) if when is None else F.coalesce(_col(when), F.lit(False))


def _choose(conditions: list[Column]) -> Column:
    """Index of the first condition that holds, or -1."""
    pairs = list(enumerate(conditions))
    return reduce(lambda rest, p: F.when(p[1], F.lit(p[0])).otherwise(rest), reversed(pairs), F.lit(-1))


def merge(
    target: DataFrame,
    source: DataFrame,
    on: list[str],
    matched: list[Update | Delete] = (),
    not_matched: list[Insert] = (),
) -> DataFrame:
    """Merge a source into a target on equal key columns.

    Conditions and values may name ``t.x`` and ``s.x``. The first clause whose
    condition holds wins, a null condition counts as false, and a target row
    that meets several source rows fails the query.

    The target is joined on its left side only: AQE can split a hot target key
    there, which a full outer join would not allow.
    """
    named = {c for clause in [*matched, *not_matched] for c in (getattr(clause, "set", None) or getattr(clause, "values", None) or {})}
    if unknown := sorted(named - set(target.columns)):
        raise ValueError(f"merge: the target has no column {', '.join(unknown)}")
    result = target
    if matched:
        result = _apply_matched(target, source, on, list(matched))
    if not_matched:
        result = result.unionByName(_new_rows(target, source, on, list(not_matched)))
    return result


def _apply_matched(target, source, on, clauses) -> DataFrame:
    payload = [c for c in source.columns if c not in on]
    per_key = (
        source.dropna(subset=on)
        .groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_matches"), *[F.any_value(c).alias(c) for c in payload])
    )
    same_key = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in on])
    joined = target.alias("t").join(placed_anew(per_key, on).alias("s"), same_key, "left")
    clause = _choose([_holds(c.when) for c in clauses])
    joined = joined.withColumn(
        "_clause",
        F.when(F.col("s._matches").isNull(), F.lit(-1))
        .when(F.col("s._matches") > 1, F.raise_error(F.lit("merge: several source rows match one target row")).cast("int"))
        .otherwise(clause),
    )
    removed = [i for i, c in enumerate(clauses) if isinstance(c, Delete)]
    kept = joined.where(~F.col("_clause").isin(removed)) if removed else joined.where(F.col("_clause") >= -1)

    def changed(field) -> Column:
        value = F.col(f"t.{field.name}")
        for i, c in enumerate(clauses):
            if isinstance(c, Delete):
                continue
            if c.set is None:
                if field.name not in source.columns:
                    continue
                new = F.col(f"s.{field.name}")
            elif field.name in c.set:
                new = _col(c.set[field.name])
            else:
                continue
            value = F.when(F.col("_clause") == i, new.cast(field.dataType)).otherwise(value)
        return value.alias(field.name)

    return kept.select(*[changed(f) for f in target.schema])


def _new_rows(target, source, on, clauses) -> DataFrame:
    # only keys the source has matter, and distinct ones: a hot target key then costs one row, not its whole group
    keys = target.select(*on).join(placed_anew(source.select(*on).distinct(), on), on, "left_semi")
    known = placed_anew(keys.distinct(), on).alias("t")
    same_key = reduce(lambda a, b: a & b, [F.col(f"s.{k}") == F.col(f"t.{k}") for k in on])
    unmatched = source.alias("s").join(known, same_key, "left_anti")
    clause = _choose([_holds(c.when) for c in clauses])
    unmatched = unmatched.withColumn("_clause", clause).where("_clause >= 0")

    def value(field) -> Column:
        result = F.lit(None).cast(field.dataType)
        for i, c in enumerate(clauses):
            if c.values is None:
                if field.name not in source.columns:
                    continue
                new = F.col(f"s.{field.name}")
            elif field.name in c.values:
                new = _col(c.values[field.name])
            else:
                continue
            result = F.when(F.col("_clause") == i, new.cast(field.dataType)).otherwise(result)
        return result.alias(field.name)

    return unmatched.select(*[value(f) for f in target.schema])


def insert_missing(target: DataFrame, source: DataFrame, on: list[str], when=None) -> DataFrame:
    """Insert-only merge: add source rows whose key the target lacks."""
    return merge(target, source, on, not_matched=[Insert(when=when)])


def latest_by(df: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """The row with the greatest sequence per key, as a partial aggregate.

    Equal sequences are decided by the other columns, so the answer does not
    depend on the order rows arrive in. A hot key shrinks to one row per task
    before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in sequence]
    last = df.groupBy(*keys).agg(F.max(F.struct(*sequence, *rest)).alias("_last"))
    return last.select(*[F.col(c) if c in keys else F.col("_last")[c].alias(c) for c in df.columns])


def apply_changes(
    changes: DataFrame,
    keys: list[str],
    sequence: list[str],
    delete_when: str | Column,
    drop: list[str] = (),
) -> DataFrame:
    """Current state of a change feed: last change per key, deleted keys left out."""
    last = latest_by(changes, keys, sequence)
    return delete_where(last, delete_when).drop(*drop)


# -- versions: a change log holds one row per changed key and version ---------


def as_of(
    log: DataFrame, keys: list[str], version: int, version_col: str = "version", op_col: str = "op"
) -> DataFrame:
    """The table as it stood after a version."""
    return apply_changes(
        log.where(F.col(version_col) <= version), keys, [version_col], F.col(op_col) == "delete",
        drop=[version_col, op_col],
    )


def history(log: DataFrame, version_col: str = "version", op_col: str = "op") -> DataFrame:
    """Rows inserted, updated and deleted by each version."""
    return log.groupBy(version_col).agg(
        F.count_if(F.col(op_col) == "insert").alias("inserted"),
        F.count_if(F.col(op_col) == "update").alias("updated"),
        F.count_if(F.col(op_col) == "delete").alias("deleted"),
    )


def restore_changes(
    log: DataFrame,
    keys: list[str],
    to_version: int,
    new_version: int,
    version_col: str = "version",
    op_col: str = "op",
) -> DataFrame:
    """Log rows that bring the table back to an older version.

    Append them to the log; the history stays. One shuffle: old and current
    row of a key come from the same aggregation.
    """
    rest = [c for c in log.columns if c not in keys and c not in (version_col, op_col)]
    row = F.struct(version_col, op_col, F.struct(*rest).alias("data"))
    both = log.groupBy(*keys).agg(
        F.max(F.when(F.col(version_col) <= to_version, row)).alias("old"), F.max(row).alias("cur")
    )
    old_live = F.coalesce(F.col("old")[op_col] != "delete", F.lit(False))
    cur_live = F.col("cur")[op_col] != "delete"
    op = (
        F.when(old_live & ~cur_live, "insert")
        .when(old_live & ~F.col("old.data").eqNullSafe(F.col("cur.data")), "update")
        .when(~old_live & cur_live, "delete")
    )
    return (
        both.withColumn("_op", op)
        .where(F.col("_op").isNotNull())
        .withColumn("_data", F.when(F.col("_op") == "delete", F.col("cur.data")).otherwise(F.col("old.data")))
        .select(
            *[
                F.lit(new_version).cast(log.schema[c].dataType).alias(c) if c == version_col
                else F.col("_op").alias(c) if c == op_col
                else F.col(c) if c in keys
                else F.col("_data")[c].alias(c)
                for c in log.columns
            ]
        )
    )


def superseded(log: DataFrame, keys: list[str], before_version: int, version_col: str = "version") -> DataFrame:
    """Log rows no version from ``before_version`` on can see (what a purge drops)."""
    return _with_horizon(log, keys, before_version, version_col).where(
        F.col(version_col) < F.col("_horizon")
    ).drop("_horizon")


def purge(log: DataFrame, keys: list[str], before_version: int, version_col: str = "version") -> DataFrame:
    """The log without its superseded rows."""
    return _with_horizon(log, keys, before_version, version_col).where(
        F.col("_horizon").isNull() | (F.col(version_col) >= F.col("_horizon"))
    ).drop("_horizon")


def _with_horizon(log, keys, before_version, version_col):
    horizon = (
        log.where(F.col(version_col) <= before_version)
        .groupBy(*keys)
        .agg(F.max(version_col).alias("_horizon"))
    )
    return log.join(placed_anew(horizon, keys), keys, "left").select(*log.columns, "_horizon")


def sync_rows(source_log: DataFrame, clone: DataFrame, on: list[str]) -> DataFrame:
    """Source rows a clone lacks; append them to bring the clone up to date."""
    return source_log.join(clone.select(*on).distinct(), on, "left_anti").select(*source_log.columns)


# -- rules on write -----------------------------------------------------------


def with_generated(df: DataFrame, generated: dict[str, str | Column]) -> DataFrame:
    """Add computed columns; a value the caller gives must equal the computed one."""
    columns = {}
    for name, value in generated.items():
        expr = _col(value)
        if name in df.columns:
            wrong = F.raise_error(F.lit(f"generated column {name}: given value differs"))
            expr = F.when(F.col(name).eqNullSafe(expr), expr).otherwise(
                wrong.cast(df.schema[name].dataType)
            )
        columns[name] = expr
    return df.withColumns(columns)


def violations(df: DataFrame, checks: dict[str, str] | None = None, not_null: list[str] = ()) -> DataFrame:
    """Violating rows per constraint, in one pass. A check that gives null passes."""
    tests = {name: ~F.coalesce(F.expr(c), F.lit(True)) for name, c in (checks or {}).items()}
    tests |= {f"{c} not null": F.col(c).isNull() for c in not_null}
    # count_if over no rows is 0, so every constraint has a row in the report
    names = list(tests)
    one_row = df.agg(*[F.count_if(tests[n]).alias(f"v{i}") for i, n in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(n).alias("constraint_name"), F.col(f"v{i}").alias("violations"))
                      for i, n in enumerate(names)])
    return one_row.select(F.inline(pairs))


def enforce(df: DataFrame, checks: dict[str, str] | None = None, not_null: list[str] = ()) -> DataFrame:
    """Fail the writing job at the first violating row, so that nothing is committed.

    The test runs inside the plan: no second pass over the data.
    """
    result = df
    tests = {name: F.coalesce(F.expr(c), F.lit(True)) for name, c in (checks or {}).items()}
    tests |= {f"{c} not null": F.col(c).isNotNull() for c in not_null}
    for name, ok in tests.items():
        result = result.where(
            F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit(f"constraint violated: {name}")).cast("boolean"))
        )
    return result


def match_schema(df: DataFrame, target: DataFrame, evolve: bool = False) -> DataFrame:
    """Columns in the target's order and type; unknown or missing ones fail unless ``evolve``."""
    extra = [c for c in df.columns if c not in target.columns]
    missing = [c for c in target.columns if c not in df.columns]
    if (extra or missing) and not evolve:
        raise ValueError(f"schema mismatch: extra {extra}, missing {missing}")
    for f in target.schema:
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType:
            raise ValueError(f"schema mismatch: {f.name} is {df.schema[f.name].dataType.simpleString()}, "
                             f"not {f.dataType.simpleString()}")
    known = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
             for f in target.schema]
    return df.select(*known, *extra)
