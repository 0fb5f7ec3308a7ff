"""Counts per group kept up from a change feed, without a look at the rows that did not change."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from lakeloom.streaming.run import run_to_table

_FIRST = -(1 << 63)


def group_moves(changes: DataFrame, keys: list[str], sequence: list[str], group: str, deleted: str) -> DataFrame:
    """A stream of (group, moved): -1 for the group a row has left, +1 for the one it has come to.

    The state holds one row per key: the sequence of its last change, its group,
    and whether it is deleted, so a late older change moves nothing. ``sequence``
    are whole numbers, a missing one counts as the first; a change that repeats
    the last one's sequence is passed over. Keys may be hot: a key's changes come in pieces.
    """
    order = [f"_s{i}" for i in range(len(sequence))]
    fields = {c: F.coalesce(F.col(s).cast("bigint"), F.lit(_FIRST)) for c, s in zip(order, sequence)}
    rows = changes.select(
        *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), *(c.alias(n) for n, c in fields.items()),
        F.col(group).cast("string").alias("_group"), F.coalesce(F.expr(deleted), F.lit(False)).alias("_gone"))

    def move(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        old = new = state.get if state.exists else None
        for frame in frames:
            at = np.lexsort([frame[c].to_numpy() for c in reversed(order)])[-1]
            last = frame.iloc[at]
            row = (*(int(last[c]) for c in order), last["_group"], bool(last["_gone"]))
            if new is None or row[:-2] > tuple(new)[:-2]:
                new = row
        if new is old:
            return
        state.update(tuple(new))
        before = [] if old is None or old[-1] else [old[-2]]
        after = [] if new[-1] else [new[-2]]
        if before != after:
            yield pd.DataFrame({group: pd.Series([*before, *after], dtype=object), "moved": np.array([-1] * len(before) + [1] * len(after), np.int64)})

    kept = ", ".join(f"{c} bigint" for c in order)
    return rows.groupBy(*(f"_k{i}" for i in range(len(keys)))).applyInPandasWithState(
        move, f"`{group}` string, moved bigint", f"{kept}, grp string, gone boolean", "append", GroupStateTimeout.NoTimeout)


def run_group_counts(
    changes: DataFrame, keys: list[str], sequence: list[str], group: str, deleted: str, target: str, checkpoint: str,
    timeout: float | None = None, state_partitions: int | None = None,
) -> int:
    """Append what moved to the table ``target``, once; rows read."""
    moves = group_moves(changes, keys, sequence, group, deleted)
    return run_to_table(moves, target, checkpoint, timeout=timeout, state_partitions=state_partitions)


def group_counts(spark: SparkSession, target: str, group: str, count: str = "n") -> DataFrame:
    """Rows per group as the feed leaves them: the sum of all moves."""
    moves = spark.read.parquet(target)
    return moves.groupBy(group).agg(F.sum("moved").alias(count)).where(F.col(count) != 0)


def compact_moves(spark: SparkSession, target: str, compacted: str, group: str) -> None:
    """Write one row per group to a new table, which says the same."""
    group_counts(spark, target, group, "moved").write.mode("errorifexists").parquet(compacted)
