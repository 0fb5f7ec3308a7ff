"""Reading files in place, and the readers that need more than one option."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def query_files(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    """``SELECT * FROM fmt.`path` `` with the format's default options."""
    quoted = path.replace("`", "``")
    return spark.sql(f"SELECT * FROM {fmt}.`{quoted}`")


def file_listing(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """Whole files as rows. The bytes are read only when ``content`` is asked for."""
    files = spark.read.format("binaryFile").load(path)
    return files if content else files.drop("content")


def with_provenance(df: DataFrame) -> DataFrame:
    """Add the source file and the time of ingest."""
    return df.select("*", F.col("_metadata.file_path").alias("source_file")).withColumn(
        "processing_time", F.current_timestamp()
    )


def decode_message(df: DataFrame, schema: str, key: str = "key", value: str = "value") -> DataFrame:
    """Binary key and value of a queue message to text, the value parsed as JSON."""
    text = df.withColumns({key: F.col(key).cast("string"), value: F.col(value).cast("string")})
    return text.withColumn("json", F.from_json(value, schema))


def encode_message(df: DataFrame, key: str) -> DataFrame:
    """Rows as queue messages: the key and the whole row as JSON, both as text.

    Feed it to a broker sink with ``write.format("kafka")`` or to a file sink.
    """
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def jdbc_table(spark: SparkSession, url: str, dbtable: str, **options: str) -> DataFrame:
    """A table of an external database through one connection."""
    return spark.read.format("jdbc").options(url=url, dbtable=dbtable, **options).load()


def jdbc_table_partitioned(
    spark: SparkSession, url: str, dbtable: str, column: str, lower: int, upper: int, partitions: int,
    **options: str,
) -> DataFrame:
    """A table of an external database read by ranges of a numeric column.

    The bounds place the ranges only; rows outside them fall in the first and last.
    """
    return spark.read.jdbc(
        url, dbtable, column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions,
        properties=options,
    )
