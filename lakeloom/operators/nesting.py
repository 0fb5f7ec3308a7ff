"""Rows packed into arrays of bounded length."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeloom.operators.joins import placed_anew


def pack_rows(
    df: DataFrame, keys: list[str], fields: list[str], name: str, max_items: int = 10_000
) -> DataFrame:
    """Rows packed into ``array<struct<fields>>``, sorted; one row per (keys, pack).

    A key of n rows has ``ceil(n / max_items)`` packs, so no array grows with the
    data, and rows are dealt to them by a hash of their fields and their place
    in the scan, so that copies spread too. The number of the key's rows goes
    along as ``n_<name>``: what is said of a key must come from there, since a
    pack may hold a part of it only. Rows that lack a key are left out.

    Only keys of more than one pack need the join. Where there are none AQE drops it,
    and each row is moved and sorted once; a merge join, so that AQE can split a hot key.
    """
    total, kept = f"n_{name}", df.dropna(subset=keys)
    large = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias(total)).where(F.col(total) > max_items)
    placed = kept.withColumn("_at", F.monotonically_increasing_id()).join(placed_anew(large, keys).hint("merge"), keys, "left")
    pack = F.coalesce(F.pmod(F.xxhash64(*fields, "_at"), F.ceil(F.col(total) / max_items)), F.lit(0))
    return placed.withColumn("pack", pack).groupBy(*keys, "pack").agg(
        F.coalesce(F.any_value(total), F.count(F.lit(1))).alias(total), F.sort_array(F.collect_list(F.struct(*fields))).alias(name)
    )


def collect_distinct(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The distinct values per key as a sorted array; for values from a bounded domain.

    A set is built per key on each task and merged after the shuffle, so copies
    cost nothing, but every distinct value of a key ends in one array. Keep
    values as rows (``distinct``) where their number may grow with the data.
    """
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(value)).alias(name))
