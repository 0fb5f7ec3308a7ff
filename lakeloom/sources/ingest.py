"""Incremental ingest of files: schema choice, rescued data, load-once."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeloom.sources.files import with_provenance
from lakeloom.streaming.run import run_to_table


def ingest_schema(
    spark: SparkSession, path: str, fmt: str, infer: bool = False, hints: dict[str, str] | None = None,
    location: str | None = None, **options,
) -> T.StructType:
    """Schema for an ingest: all strings, or inferred types, with hints for single columns.

    Inference reads the files there are; with ``infer`` off only the names are
    taken from it. A ``location`` keeps the schema, so that later runs read nothing.
    """
    if location:
        try:
            kept = spark.read.schema("schema string").json(location).first()
            return T.StructType.fromJson(json.loads(kept["schema"]))
        except AnalysisException:  # first run: no such folder yet
            schema = ingest_schema(spark, path, fmt, infer, hints, **options)
            spark.createDataFrame([(schema.json(),)], "schema string").write.mode("overwrite").json(location)
            return schema
    found = spark.read.format(fmt).options(**options, inferSchema=infer).load(path).schema
    hints = hints or {}
    hinted = {c: T._parse_datatype_string(t) for c, t in hints.items()}
    return T.StructType(
        [
            T.StructField(f.name, hinted.get(f.name, f.dataType if infer else T.StringType()), True)
            for f in found if f.name != "_corrupt_record"
        ]
    )


def file_stream(
    spark: SparkSession, path: str, fmt: str, schema, max_files: int = 10_000, max_age: str = "100000000000d", **options
) -> DataFrame:
    """A stream over the files of a folder; each file is read once per checkpoint.

    Spark passes over files much older than the newest one (7 days by its own
    default); the age here is as wide as it can be, so that no file is lost; give
    a smaller one to pass over old files.
    """
    return (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", max_age)
        .options(**options)
        .load(path)
    )


def rescue_json(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Parse JSON lines to a schema and keep what does not fit in ``_rescued_data``.

    Rescued are fields the schema lacks, fields whose value does not convert,
    and, under ``_line``, a line that is no JSON object at all.
    """
    parsed = lines.withColumn("_row", F.from_json(column, schema)).withColumn("_keys", F.json_object_keys(column))
    held = F.array_compact(F.array(*(F.when(F.col("_row")[f.name].isNotNull(), F.lit(f.name)) for f in schema)))
    parsed = parsed.withColumn("_held", held)
    # a line whose every field is held needs no second look
    plain = F.coalesce(F.size(F.array_except("_keys", "_held")) == 0, F.lit(False))
    parsed = parsed.withColumn("_plain", plain).withColumn("_raw", F.when(~F.col("_plain"), F.from_json(column, "map<string,string>")))
    known = F.array(*(F.lit(f.name) for f in schema))
    # made in a step of its own, or each of its uses below would make it again
    parsed = parsed.withColumn("_left", F.map_filter(
        "_raw", lambda k, v: ~F.array_contains("_held", k) & (v.isNotNull() | ~F.array_contains(known, k))
    ))
    rescued = F.when(
        F.col("_raw").isNull() & ~F.col("_plain") & F.col(column).isNotNull(),
        F.to_json(F.create_map(F.lit("_line"), F.col(column))),
    ).when(F.size("_left") > 0, F.to_json("_left"))
    others = [c for c in lines.columns if c != column]
    return parsed.select(*others, "_row.*", rescued.alias("_rescued_data"))


def json_stream(spark: SparkSession, path: str, schema: str | T.StructType, **options) -> DataFrame:
    """A stream over JSON lines: the schema's fields, ``source_file``, ``processing_time``, and ``_rescued_data``
    with all that the schema doesn't take, so that a raw table loses nothing."""
    lines = with_provenance(file_stream(spark, path, "text", "value string", **options))
    return rescue_json(lines, raw_schema(schema))


def raw_schema(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def parsed_rows(raw: DataFrame) -> DataFrame:
    """The rows of a raw table; lines that were no JSON, and what tells of the ingest, stay behind in it."""
    whole = F.get_json_object("_rescued_data", "$._line").isNull()
    return raw.where(whole).drop("_rescued_data", "source_file", "processing_time")


def load_new_files(
    spark: SparkSession, source: str, fmt: str, schema, target: str, checkpoint: str, **options
) -> int:
    """Append the files not loaded before to a parquet table; rows added.

    Running it again without new files adds nothing.
    """
    return run_to_table(file_stream(spark, source, fmt, schema, **options), target, checkpoint)
