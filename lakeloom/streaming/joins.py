"""Joins of two streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.operators.joins import salted_join


def within_time(fact_time: str, entity_time: str, within: str) -> Column:
    """A fact lies in the time ``within`` after the entity, both ends included."""
    return (F.col(fact_time) >= F.col(entity_time)) & (F.col(fact_time) <= F.col(entity_time) + F.expr(f"INTERVAL {within}"))


def join_streams(
    facts: DataFrame, entities: DataFrame, on: Column, spread_on: list[str], salt: int = 8,
    times: tuple[str, str] | None = None, within: str = "1 hour", lateness: str = "10 minutes",
) -> DataFrame:
    """Inner join of two streams; a hot key is spread over ``salt`` state partitions (1: not spread).

    With ``times`` (the time columns of facts and entities, of unlike names) a
    fact meets the entities of the time ``within`` before it, rows may come
    ``lateness`` late, and state that no later row can meet is dropped. Without
    it both sides are kept for ever, in RocksDB as ``session.build_session`` sets it.
    """
    if times:
        fact_time, entity_time = times
        facts, entities = facts.withWatermark(fact_time, lateness), entities.withWatermark(entity_time, lateness)
        on = on & within_time(fact_time, entity_time, within)
    return salted_join(facts, entities, on, spread_on, "inner", salt) if salt > 1 else facts.join(entities, on)
