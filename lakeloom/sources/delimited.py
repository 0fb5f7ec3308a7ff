"""Delimited lines, read by the header of the file they stand in, with all that does not fit kept."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakeloom.sources.files import with_provenance
from lakeloom.sources.ingest import file_stream
from lakeloom.streaming.run import run_batches

#: Names of rescued leftovers that no header names.
LINE, MISSING, EXTRA = "_line", "_missing", "_extra_"


def _cells(line: Column, sep: str) -> Column:
    """The cells of a line as they stand, quotes and all: from a quote to its end, or up to the separator."""
    s = re.escape(sep)
    return F.regexp_extract_all(F.concat(line, F.lit(sep)), F.lit(f'("[^"]*(?:""[^"]*)*"|(?!")[^{s}]*){s}'), F.lit(1))


def _plain(cell: Column) -> Column:
    """A cell without its quotes; null if it is empty and has none."""
    quoted = cell.startswith('"')
    return F.when(quoted, F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))).when(cell != "", cell)


def _names(line: Column, sep: str) -> Column:
    """The names a header line gives; one without a name, or with that of another before it, is named by its place."""
    found = F.transform(_cells(F.regexp_replace(line, "^﻿", ""), sep), lambda c: F.trim(F.coalesce(_plain(c), F.lit(""))))
    return F.transform(found, lambda n, i: F.when((n != "") & (F.array_position(found, n) == i + 1), n).otherwise(F.concat(F.lit(EXTRA), i + 1)))


def rescue_csv(lines: DataFrame, schema: T.StructType, header: str = "_header", column: str = "value", sep: str = ",") -> DataFrame:
    """Parse lines to a schema, by name, and keep what does not fit in ``_rescued_data`` (JSON).

    ``header`` holds the header line of the file a line comes from. Rescued are
    fields the schema lacks, fields whose text does not convert, cells beyond the
    header (``_extra_5``: the fifth cell), the names of the cells a short line
    lacks (``_missing``), and, under ``_line``, a whole line whose quotes don't
    match or whose file's header isn't known. The header's names are taken from
    ``_named`` where ``with_headers`` has found them, once for each file. An empty cell is null, an empty pair
    of quotes is empty text. A line is a record: quoted line breaks aren't read.
    """
    raw = lines.withColumn("_raw", _cells(F.col(column), sep))
    if "_named" not in lines.columns:
        raw = raw.withColumn("_named", _names(F.col(header), sep))
    whole = F.col(header).isNotNull() & (F.length(F.array_join("_raw", sep)) == F.length(column))
    raw = raw.withColumn("_whole", F.coalesce(whole, F.lit(False))).withColumn("_cell", F.transform("_raw", _plain))

    def cell(name: str) -> Column:
        at = F.array_position("_named", F.lit(name)).cast("int")
        return F.when(F.col("_whole") & (at > 0), F.try_element_at("_cell", F.greatest(at, F.lit(1))))

    fields = {f.name: cell(f.name).try_cast(f.dataType) for f in schema}
    parsed = raw.withColumn("_row", F.struct(*(value.alias(name) for name, value in fields.items())))
    entries = F.transform(F.arrays_zip("_named", "_cell"), lambda z, i: F.struct(F.coalesce(z["_named"], F.concat(F.lit(EXTRA), i + 1)).alias("name"), z["_cell"].alias("text")))

    def left_over(e: Column) -> Column:
        fits = F.lit(False)
        for f in schema:
            fits = fits | ((e["name"] == f.name) & F.col("_row")[f.name].isNotNull())
        return e["text"].isNotNull() & ~fits

    lacking = F.slice("_named", F.size("_cell") + 1, F.greatest(F.size("_named") - F.size("_cell"), F.lit(0)))
    short = F.when(F.size("_cell") < F.size("_named"), F.array(F.struct(F.lit(MISSING).alias("name"), F.concat_ws(sep, lacking).alias("text"))))
    kept = F.concat(F.filter(entries, left_over), F.coalesce(short, F.array().cast("array<struct<name: string, text: string>>")))
    # each field has a cell of its own, so where as many of both hold something nothing is left over
    held = sum((F.col("_row")[f.name].isNotNull().cast("int") for f in schema), F.lit(0))
    plain = (F.size("_cell") == F.size("_named")) & (F.size(F.array_compact("_cell")) == held)
    rescued = F.when(~F.col("_whole"), F.to_json(F.create_map(F.lit(LINE), F.col(column)))).when(
        ~plain & (F.size(kept) > 0), F.to_json(F.map_from_entries(kept))
    )
    others = [c for c in lines.columns if c not in (column, header, "_named")]
    return parsed.select(*others, "_row.*", rescued.alias("_rescued_data"))


def with_headers(lines: DataFrame, column: str = "value", file: str = "source_file", start: str = "_start", sep: str = ",") -> DataFrame:
    """Lines of files (with the path and the start of the block each comes from) less headers and blank lines, plus ``_header`` and its names, ``_named``.

    A file's header is the first line of its first block. It takes a pass over the
    lines, of which one row for each file is left. Those go to the lines and not the
    lines to them, which would bring a large file to one task: a batch has
    ``maxFilesPerTrigger`` files at most, so as many rows.
    """
    placed = lines.withColumn("_at", F.monotonically_increasing_id())
    first = placed.groupBy(F.col(file).alias("_file")).agg(F.min(F.when(F.col(start) == 0, F.struct("_at", column))).alias("_first"))
    first = first.withColumn("_named", _names(F.col("_first")[column], sep))
    met = placed.join(F.broadcast(first), F.col(file) == F.col("_file"), "left")
    data = F.col("_first").isNull() | (F.col("_at") != F.col("_first._at"))
    return met.where(data & (F.col(column) != "")).select(*(c for c in lines.columns if c != start), F.col("_first")[column].alias("_header"), "_named")


def load_csv(
    spark: SparkSession, path: str, schema: str | T.StructType, target: str, checkpoint: str, sep: str = ",", timeout: float | None = None
) -> int:
    """Append the files that have arrived to a raw table of the schema's fields, ``source_file``, ``processing_time`` and ``_rescued_data``; lines read.

    A batch lies under its id. A note that is written when it is whole keeps a
    repeated batch from being written again, so a stream may follow the table.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def land(batch: DataFrame, batch_id: int) -> None:
        note = f"{target}-whole/batch={batch_id}"
        try:
            if batch.sparkSession.read.schema("batch long").parquet(note).limit(1).count():
                return
        except AnalysisException:  # not written yet
            pass
        rescue_csv(with_headers(batch, sep=sep), kind, sep=sep).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        batch.sparkSession.range(1).select(F.lit(batch_id).cast("long").alias("batch")).coalesce(1).write.mode("overwrite").parquet(note)

    lines = with_provenance(file_stream(spark, path, "text", "value string").select("*", F.col("_metadata.file_block_start").alias("_start")))
    return run_batches(lines, land, checkpoint, timeout)


def loaded_schema(schema: str) -> str:
    """The schema of the table that ``load_csv`` writes, for a stream that follows it."""
    return f"source_file string, processing_time timestamp, {schema}, _rescued_data string"


def read_loaded(spark: SparkSession, target: str) -> DataFrame:
    """The rows of all batches."""
    return spark.read.option("basePath", target).parquet(target).drop("batch")


def follow_loaded(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """A stream over the rows of all batches."""
    return spark.readStream.schema(loaded_schema(schema)).option("recursiveFileLookup", "true").parquet(target)
