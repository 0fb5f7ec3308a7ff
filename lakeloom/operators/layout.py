"""File layout jobs: compaction with clustering on several columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def z_value(codes: list[Column], bits: int) -> Column:
    """Bits of the codes interleaved into one long."""
    parts = [
        F.shiftleft(F.shiftright(code, bit).bitwiseAND(F.lit(1)), bit * len(codes) + j)
        for bit in range(bits)
        for j, code in enumerate(codes)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def range_code(value: Column, cuts: list) -> Column:
    """Number of sorted cut points at or below a value, found by halving."""
    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(value < cuts[mid], within(low, mid)).otherwise(within(mid + 1, high))

    return F.coalesce(F.when(value.isNotNull(), within(0, len(cuts))), F.lit(0)).cast("bigint")


def ordered_number(df: DataFrame, column: str) -> Column:
    """A number, time or truth value as a number in its own order."""
    kind = df.schema[column].dataType.simpleString()
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return (F.col(column).cast("int") if kind == "boolean" else F.col(column)).cast("double")


def text_cuts(df: DataFrame, column: str, steps: int) -> list[str]:
    """Whole values that divide a text column into about equal ranges: the least of each but the first."""
    dealt = df.select(column).where(F.col(column).isNotNull()).repartitionByRange(steps, column)
    starts = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(column).alias("start")).collect()  # one row per range
    return sorted({r["start"] for r in starts})[1:]


def with_z_order(df: DataFrame, columns: list[str], bits: int = 6, name: str = "_z") -> DataFrame:
    """Add the z-value of number, time or text columns; null counts as the lowest value.

    Each column is cut at approximate quantiles into ``2**bits`` ranges, so the
    codes are evenly filled whatever the distribution. Numbers and times take
    one partial aggregate together, each text column a range partitioning of its
    own, whose bounds are whole values. Only cut points (63 per column) reach
    the driver.
    """
    steps = 2**bits
    shares = [i / steps for i in range(1, steps)]
    texts = {c for c in columns if df.schema[c].dataType.simpleString() == "string"}
    values = {c: F.col(c) if c in texts else ordered_number(df, c) for c in columns}
    numbers = [c for c in columns if c not in texts]
    found = df.agg(*[F.percentile_approx(values[c], shares, 4 * steps).alias(c) for c in numbers]).first() if numbers else {}
    coded = df.withColumns({f"_n_{c}": v for c, v in values.items()})
    # a column of few values gets few cuts; its codes are drawn apart to weigh as much in the z-value
    for c in columns:
        cuts = text_cuts(df, c, steps) if c in texts else sorted(set(found[c] or []))
        code = range_code(F.col(f"_n_{c}"), cuts)
        coded = coded.withColumn(f"_code_{c}", F.floor(code * steps / (len(cuts) + 1)))
    # each code is a column of its own: its bits are taken from one value
    z = z_value([F.col(f"_code_{c}") for c in columns], bits)
    return coded.withColumn(name, z).drop(*[f"{p}{c}" for c in columns for p in ("_n_", "_code_")])


def optimize(
    df: DataFrame, path: str, columns: list[str], files: int | None = None, rows_per_file: int = 1_000_000
) -> None:
    """Rewrite a table clustered on the columns, in ``files`` files or by rows per file.

    Range partitioning on the z-value and the scan position: rows with equal
    values can still be split over files, so a hot value does not fill one task.
    A task sorts the rows of one file, so ``rows_per_file`` bounds its memory.
    """
    if files is None:
        files = max(1, -(-df.count() // rows_per_file))
    placed = with_z_order(df, columns).withColumn("_pos", F.monotonically_increasing_id())
    (
        placed.repartitionByRange(files, "_z", "_pos")
        .sortWithinPartitions("_z")
        .drop("_z", "_pos")
        .write.mode("errorifexists")
        .parquet(path)
    )


def file_spans(df: DataFrame, column: str) -> DataFrame:
    """Rows and value range per data file, for judging how much a scan can skip."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(column).alias("low"), F.max(column).alias("high")
    )
