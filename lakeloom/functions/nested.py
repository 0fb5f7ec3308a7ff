"""Functions of nested and JSON columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F


def json_field(column: str, *path: str) -> Column:
    """A field of a JSON text by path, as text."""
    return F.get_json_object(column, "$." + ".".join(path))


def words(column: str) -> Column:
    """The text cut at single spaces."""
    return F.split(column, " ")


def lines(column: str) -> Column:
    """The text cut at line ends."""
    return F.split(column, "\n")


def parse_like(df: DataFrame, column: str, name: str = "json") -> DataFrame:
    """Parse a JSON column with the schema that holds the fields of all its values.

    The schema is one aggregate. Values that differ in type where they share a
    field are kept as text there.
    """
    merged = df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("s")).first()["s"] or "VOID"
    kinds = {"OBJECT<": "STRUCT<", "VARIANT": "STRING", "VOID": "STRING"}
    schema = re.sub(r"OBJECT<|\bVARIANT\b|\bVOID\b", lambda m: kinds[m[0]], merged)
    if not schema.startswith(("STRUCT", "ARRAY")):  # no value is an object or a list
        return df.withColumn(name, F.lit(None).cast("string"))
    return df.withColumn(name, F.from_json(column, schema))
