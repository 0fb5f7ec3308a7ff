"""Joins that stay even when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def salted_join(
    facts: DataFrame, entities: DataFrame, on: Column, spread_on: list[str], how: str = "inner", salt: int = 8
) -> DataFrame:
    """Join facts to entities with each key spread over ``salt`` partitions.

    Fact rows are dealt by the hash of ``spread_on`` (columns that tell rows of
    one key apart); entity rows, few per key, are repeated once per salt. For
    ``inner`` and ``left`` the answer is that of the plain join. Meant for
    streams, where AQE splits nothing; a batch join leaves it to AQE.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a salted join can be inner or left, not {how}")
    salted = facts.withColumn("_salt_f", F.pmod(F.xxhash64(*spread_on), F.lit(salt)).cast("int"))
    copies = entities.withColumn("_salt_e", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return salted.join(copies, on & (F.col("_salt_f") == F.col("_salt_e")), how).drop("_salt_f", "_salt_e")


def placed_anew(df: DataFrame, keys: list[str]) -> DataFrame:
    """An aggregated side made ready for a join in which the other side may have a hot key.

    AQE splits a hot key only where both sides are shuffled for the join. A
    side that comes out of an aggregation by the same key is already in place
    and would be joined without a shuffle, and the hot key left whole. A key
    column that is an expression is placed anew; the side is small by then,
    with one row per key.
    """
    return df.withColumns({k: F.coalesce(k, k) for k in keys})


def outer_join_unique(facts: DataFrame, entities: DataFrame, on: str) -> DataFrame:
    """Full outer join to a side with one row per key.

    AQE cannot split a hot key of a full outer join. Written as a left join,
    which it can, plus the entities no fact has, found among distinct keys.
    """
    matched = facts.join(placed_anew(entities, [on]), on, "left")
    alone = entities.join(facts.select(on).distinct(), on, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def sort_rows(df: DataFrame, *order: str | Column) -> DataFrame:
    """Global sort in which equal rows, too, are divided over the range partitions."""
    placed = df.withColumn("_pos", F.monotonically_increasing_id())
    return placed.orderBy(*order, "_pos").drop("_pos")
