"""A copy of a table that is brought back in line with its source by digests of hash buckets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeloom.sources.sinks import rewrite_partitions

BUCKET = "_bucket"


def _hash(columns: list[str]) -> Column:
    """A hash in which nulls count: Spark's own passes over them."""
    return F.xxhash64(*(x for c in columns for x in (F.col(c), F.col(c).isNull())))


def bucketed(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return rows.withColumn(BUCKET, F.pmod(_hash(keys), F.lit(buckets)).cast("int"))


def clone_table(source: DataFrame, keys: list[str], name: str, buckets: int = 256) -> None:
    """Copy a table to the catalog table ``name``, one partition for each hash bucket of the keys."""
    bucketed(source, keys, buckets).hint("rebalance", BUCKET).write.partitionBy(BUCKET).mode("errorifexists").format("parquet").saveAsTable(name)


def digests(rows: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Rows and the digest of all of them, in any order, per ``by``."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(_hash(columns).cast("decimal(38,0)")).alias("digest"))


def _beside(source: DataFrame, clone: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Digests of both sides per ``by``, from one aggregation: ``ours`` and ``theirs``, null where a side has no row."""
    both = [digests(side, columns, by).withColumn("side", F.lit(i)) for i, side in enumerate((source, clone))]
    value = F.struct("n", "digest")
    one = reduce(DataFrame.unionByName, both).groupBy(*by)
    return one.agg(F.max(F.when(F.col("side") == 0, value)).alias("ours"), F.max(F.when(F.col("side") == 1, value)).alias("theirs"))


def unlike_buckets(source: DataFrame, clone: DataFrame, keys: list[str], buckets: int) -> list[int]:
    """The buckets whose digests differ; ``buckets`` numbers at most."""
    columns = [c for c in clone.columns if c != BUCKET]
    sides = _beside(bucketed(source.select(*columns), keys, buckets), clone, columns, [BUCKET])
    return sorted(r[0] for r in sides.where(~F.col("ours").eqNullSafe(F.col("theirs"))).select(BUCKET).collect())


def differences(source: DataFrame, clone: DataFrame, keys: list[str]) -> DataFrame:
    """Per key that differs: ``missing`` in the clone, ``changed``, or ``vanished`` from the source. A key's rows count as one whole."""
    columns = [c for c in clone.columns if c != BUCKET]
    sides = _beside(source.select(*columns), clone.select(*columns), columns, keys)
    kind = F.when(F.col("theirs").isNull(), "missing").when(F.col("ours").isNull(), "vanished").otherwise("changed")
    return sides.where(~F.col("ours").eqNullSafe(F.col("theirs"))).select(*keys, kind.alias("difference"))


def resync_clone(spark: SparkSession, source: DataFrame, name: str, keys: list[str], staging: str, buckets: int = 256) -> tuple[list[int], DataFrame]:
    """Repair a clone; the buckets that differed, and what was repaired per key.

    One aggregation over both sides finds the buckets; only those of the clone are
    read again and rewritten. ``staging`` is a fresh folder: it takes the report,
    which is made before the repair, and the new rows, before they replace the old.
    """
    clone = spark.table(name)
    unlike = unlike_buckets(source, clone, keys, buckets)
    columns = [c for c in clone.columns if c != BUCKET]
    wanted = bucketed(source.select(*columns), keys, buckets).where(F.col(BUCKET).isin(unlike))
    found = differences(wanted, clone.where(F.col(BUCKET).isin(unlike)), keys)
    found.write.parquet(f"{staging}/report")
    if unlike:
        rewrite_partitions(spark, name, BUCKET, unlike, lambda _: wanted, f"{staging}/rows")
    return unlike, spark.read.parquet(f"{staging}/report")
