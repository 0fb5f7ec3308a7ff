"""Incremental ingest of JSON lines under a schema that grows with its fields."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeloom.sources.files import with_provenance
from lakeloom.sources.ingest import file_stream, rescue_json
from lakeloom.streaming.run import run_batches

#: For a new field: the first type that takes all its values. Text takes any.
NEW = ["bigint", "double", "boolean", "timestamp"]
#: Types a field may be widened to without loss, narrowest first.
WIDER = {
    "tinyint": ["smallint", "int", "bigint"], "smallint": ["int", "bigint"], "int": ["bigint", "double"], "float": ["double"],
    "bigint": ["decimal(38,9)"], "date": ["timestamp"],
}
#: New fields taken up from one batch; more stay in ``_rescued_data``, where nothing is lost.
MOST_NEW = 1000


def schema_versions(spark: SparkSession, out: str) -> list[T.StructType]:
    """The schemas of an ingest, oldest first."""
    try:
        kept = spark.read.schema("version int, schema string").json(f"{out}/_schemas").orderBy("version").collect()
    except AnalysisException:  # nothing ingested yet
        return []
    # a repeated batch may have noted its version twice, with one schema
    return [T.StructType.fromJson(json.loads(s)) for _, s in sorted({r.version: r.schema for r in kept}.items())]


def _note(spark: SparkSession, out: str, version: int, schema: T.StructType) -> None:
    row = spark.range(1).select(F.lit(version).alias("version"), F.lit(schema.json()).alias("schema"))
    row.coalesce(1).write.mode("append").json(f"{out}/_schemas")


def rescued_entries(rows: DataFrame) -> DataFrame:
    """Name and text of what ``_rescued_data`` holds, broken lines and nulls apart.

    Nothing is asked of ``_rescued_data`` before it is taken apart: Spark would push that down to the scan, where a line is parsed
    again for each field and key. From the outer form it infers no such condition.
    """
    entries = rows.select(F.explode_outer(F.from_json("_rescued_data", "map<string,string>")).alias("name", "text"))
    return entries.where("name <> '_line' and text is not null")


def grown(rows: DataFrame, schema: T.StructType, most: int = MOST_NEW) -> T.StructType:
    """``schema`` with the fields that ``_rescued_data`` names, and with fields widened where all values they left out fit a wider type."""
    known = {f.name: f.dataType.simpleString() for f in schema}
    types = sorted({t for name in known.values() for t in WIDER.get(name, [])} | set(NEW))
    entries = rescued_entries(rows)
    # text without a digit is no number and no time, which a cast would find out by an exception
    plain, digits = F.col("text").rlike("^(true|false)$"), F.col("text").rlike(r"\p{Nd}|(?i:nan|inf)")
    fits = {t: (plain if t == "boolean" else digits) & F.col("text").try_cast(t).isNotNull() for t in types}
    found = entries.groupBy("name").agg(*(F.bool_and(f).alias(f"f{i}") for i, f in enumerate(fits.values())))
    new, wider = [], {}
    for row in found.orderBy("name").limit(most).collect():
        takes = {t for i, t in enumerate(fits) if row[f"f{i}"]}
        if row["name"] not in known:
            new.append(T.StructField(row["name"], T._parse_datatype_string(next((t for t in NEW if t in takes), "string"))))
        elif wide := next((t for t in WIDER.get(known[row["name"]], []) if t in takes), None):
            wider[row["name"]] = T._parse_datatype_string(wide)
    return T.StructType([*(T.StructField(f.name, wider.get(f.name, f.dataType)) for f in schema), *new])


def ingest_evolving(spark: SparkSession, feed: str, out: str, schema: str | T.StructType, timeout: float | None = None) -> T.StructType:
    """Take in what has arrived and return the schema as it now stands; ``schema`` is the first run's.

    A batch with fields the schema lacks, or with values that a wider type takes,
    makes a new version of the schema and is parsed by it, so a field is a column
    from its first batch on. Only values that fit no type stay in
    ``_rescued_data``. Every version's rows lie in a folder of their own.
    """
    if not schema_versions(spark, out):
        _note(spark, out, 0, T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def land(batch: DataFrame, batch_id: int) -> None:
        versions = schema_versions(batch.sparkSession, out)
        now = versions[-1]
        rows = rescue_json(batch, now)
        after = grown(rows, now)
        if after != now:
            versions.append(after)
            _note(batch.sparkSession, out, len(versions) - 1, after)
            rows = rescue_json(batch, after)
        rows.write.mode("overwrite").parquet(f"{out}/rows/version={len(versions) - 1}/batch={batch_id}")

    lines = with_provenance(file_stream(spark, feed, "text", "value string"))
    run_batches(lines, land, f"{out}/_checkpoints/rows", timeout)
    return schema_versions(spark, out)[-1]


def read_evolving(spark: SparkSession, out: str) -> DataFrame:
    """All rows under the newest schema: fields that came later are null in older rows, widened ones are cast."""
    versions, whole = schema_versions(spark, out), None
    for version, schema in enumerate(versions):
        folder = f"{out}/rows/version={version}"
        stored = T.StructType([T.StructField("source_file", T.StringType()), T.StructField("processing_time", T.TimestampType()), *schema, T.StructField("_rescued_data", T.StringType())])
        try:
            rows = spark.read.schema(stored).option("recursiveFileLookup", "true").parquet(folder)
        except AnalysisException:  # a version that no batch was written under
            continue
        held = set(schema.names)
        columns = [(F.col(f.name) if f.name in held else F.lit(None)).cast(f.dataType).alias(f.name) for f in versions[-1]]
        rows = rows.select("source_file", "processing_time", *columns, "_rescued_data")
        whole = rows if whole is None else whole.unionByName(rows)
    return whole
