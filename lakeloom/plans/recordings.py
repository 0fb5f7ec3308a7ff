"""Heart-rate recordings and patients as two streams → daily mean per patient."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.operators.quality import Rule, apply_rules
from lakeloom.sources.delimited import follow_loaded, load_csv
from lakeloom.sources.ingest import ingest_schema, json_stream, parsed_rows
from lakeloom.streaming.joins import join_streams, within_time
from lakeloom.streaming.run import run_to_table
from lakeloom.streaming.updates import read_updates, run_updates

DAY = ["mrn", "name", "date"]


def enriched(recordings: DataFrame, patients: DataFrame, within: str | None = None, lateness: str = "10 minutes") -> DataFrame:
    """Recordings with the patient's name; a heart rate that is not positive is dropped.

    With ``within``, patients are admissions with the time ``admitted`` (epoch
    seconds), and a recording meets the admissions of that time before it. As
    streams both sides then keep only what a row still to come may meet.
    """
    a = recordings.withColumnRenamed("mrn", "mrn_a").withColumn("time", F.timestamp_seconds("time"))
    same = F.col("mrn_a").cast("bigint") == F.col("mrn")
    if within:
        patients = patients.withColumn("admitted", F.timestamp_seconds("admitted"))
    # a batch join leaves a hot patient to AQE, which a stream does not have
    if a.isStreaming:
        joined = join_streams(a, patients, same, ["reading_id"], times=("time", "admitted") if within else None, within=within or "", lateness=lateness)
    else:
        joined = a.join(patients, same & within_time("time", "admitted", within) if within else same)
    typed = joined.select(
        F.col("device_id").cast("int"),
        F.col("mrn_a").cast("bigint").alias("mrn"),
        F.col("heartrate").cast("double"),
        "time",
        "name",
    )
    return apply_rules(typed, [Rule("positive_heartrate", "heartrate > 0", "drop")])


def daily_mean(recordings: DataFrame) -> DataFrame:
    return recordings.groupBy("mrn", "name", F.to_date("time").alias("date")).agg(
        F.mean("heartrate").alias("avg_heartrate")
    )


def update(
    spark: SparkSession, recording_feed: str, patient_feed: str, out: str, timeout: float | None = None,
    state_partitions: int | None = None, within: str | None = None, lateness: str = "10 minutes", state: dict[str, int] | None = None,
) -> DataFrame:
    """Take in both feeds and publish the daily means that changed.

    ``state`` takes the rows that the join of the two feeds holds in the end.
    """
    # recordings come as text fields, but the time is read as a number
    recording_schema = ingest_schema(
        spark, recording_feed, "json", hints={"time": "double"}, location=f"{out}/_schema/recordings"
    )
    raw = json_stream(spark, recording_feed, recording_schema)
    run_to_table(raw, f"{out}/bronze", f"{out}/_checkpoints/bronze", timeout=timeout)
    recordings = parsed_rows(spark.readStream.schema(raw.schema).parquet(f"{out}/bronze"))
    columns = "mrn bigint, name string" + (", admitted double" if within else "")
    load_csv(spark, patient_feed, columns, f"{out}/patients", f"{out}/_checkpoints/patients", timeout=timeout)
    patients = parsed_rows(follow_loaded(spark, f"{out}/patients", columns))
    run_to_table(
        enriched(recordings, patients, within, lateness), f"{out}/enriched", f"{out}/_checkpoints/enriched",
        timeout=timeout, state_partitions=state_partitions, state=state,
    )
    stored = spark.readStream.schema(spark.read.parquet(f"{out}/enriched").schema).parquet(f"{out}/enriched")
    run_updates(daily_mean(stored), f"{out}/daily", f"{out}/_checkpoints/daily", timeout, state_partitions)
    return read_updates(spark, f"{out}/daily", DAY)
