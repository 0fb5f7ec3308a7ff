"""The function surface: SQL functions, Python row functions, vectorised functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F


def create_sql_function(spark: SparkSession, signature: str, returns: str, body: str) -> None:
    """A temporary SQL function; Catalyst inlines its body, so it costs what the expression costs."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {returns} RETURN {body}")


def describe_function(spark: SparkSession, name: str):
    return spark.sql(f"DESCRIBE FUNCTION EXTENDED {name}")


def function_facts(spark: SparkSession, name: str) -> DataFrame:
    """name, input (parameters and types) and returns of a SQL function, from its description."""
    text = F.col("function_desc")
    said = {k: F.max(F.when(text.startswith(f"{k}: "), F.substring(text, F.lit(len(k) + 3), F.length(text)))) for k in ("Function", "Usage")}
    one = describe_function(spark, name).agg(said["Function"].alias("name"), said["Usage"].alias("usage"))
    # the usage is a JSON object whose keys have dots
    told = F.from_json("usage", "map<string,string>")
    return one.select(F.element_at(F.split("name", "[.]"), -1).alias("name"), told["sqlFunction.inputParam"].alias("input"), told["sqlFunction.returnType"].alias("returns"))


# Python functions are made on call: a function made here travels to the workers
# whole, so they need not have this package installed.


def first_letter_by_row():
    """Row at a time, over Arrow batches; ``substring(text, 1, 1)`` does the same inside the JVM."""

    @F.udf("string", useArrow=True)
    def first_letter(text):
        return text[:1] if text is not None else None

    return first_letter


def first_letter_by_batch():
    """The same over Arrow batches."""

    def first_letter(text: pd.Series) -> pd.Series:
        return text.str[:1]

    first_letter.__annotations__ = {"text": pd.Series, "return": pd.Series}
    return F.pandas_udf(first_letter, "string")
