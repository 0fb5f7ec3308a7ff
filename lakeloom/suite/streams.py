"""Streams over files in two arrivals; each must give what the batch query gives."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F, types as T

from lakeloom.operators.layout import file_spans, optimize
from lakeloom.operators.quality import Rule, apply_rules
from lakeloom.session import scratch_dir, view_name
from lakeloom.sources.files import with_provenance
from lakeloom.sources.delimited import load_csv, read_loaded
from lakeloom.sources.evolving import ingest_evolving, read_evolving
from lakeloom.sources.ingest import file_stream, ingest_schema, load_new_files, rescue_json
from lakeloom.streaming import run
from lakeloom.streaming.changes import apply_changes_stream, compact_log, current_state
from lakeloom.streaming.joins import join_streams
from lakeloom.streaming.updates import compact_updates, read_updates, rows_per_batch, run_updates
from lakeloom.streaming.windows import closed_windows, window_report
from lakeloom.suite.base import query, settled, table
from lakeloom.suite.standins import CHANGE_FEED, EMAIL, change_feed, users
from lakeloom.suite.table_changes import STATE
from lakeloom.streaming.views import compact_moves, group_counts, run_group_counts

HALF = "time_us < 1705363200000000"  # 2024-01-16, the middle of the events
EVENT_SCHEMA = "event_id bigint, event_name string, user_id bigint, value double, time_us bigint"
STAMP = "yyyy-MM-dd HH:mm:ss"


def event_rows(spark, sf):
    """Events as they travel: the time as epoch microseconds."""
    return table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("event_name"), "user_id", "value",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("time_us"),
    )


def timed(events):
    return events.withColumn("event_time", F.timestamp_micros("time_us"))


def arrivals(spark, df, first, step, fmt="json", odd=False, once=False, **options):
    """Write the rows in two arrivals and call ``step(folder)`` after each; the last result.

    With ``odd`` the second arrival also has a field no schema knows and a line that is no JSON.
    With ``once`` the rows, which are costly to make, are made once, as JSON lines, and each arrival takes its own.
    """
    folder = scratch_dir(spark, "feed")
    result = None
    if once:
        made, early = scratch_dir(spark, "lines"), F.coalesce(F.expr(first), F.lit(False))
        late = [F.when(~early, "kept").alias("unheard_of")] if odd else []
        df.select(early.alias("early"), F.to_json(F.struct("*", *late)).alias("value")).write.parquet(made)
        df, first, fmt = spark.read.parquet(made), "early", "text"
    for k, part in enumerate((df.where(first), df.where(f"NOT coalesce({first}, false)"))):
        if odd and k:
            part = part if once else part.withColumn("unheard_of", F.lit("kept"))
            spark.createDataFrame([('{"order_id": 1, ',)], "value string").coalesce(1).write.mode("append").text(folder)
        part = part.select("value") if once else part
        part.write.mode("append").format(fmt).options(**options).save(folder)
        result = step(folder)
    return result


class Job:
    """Fresh output and checkpoint folders of one job, and one state partition per core."""

    def __init__(self, spark, name):
        self.base = scratch_dir(spark, name)
        self.states = spark.sparkContext.defaultParallelism

    def out(self, name="out"):
        return f"{self.base}/{name}"

    def checkpoint(self, name="out"):
        return f"{self.base}/_checkpoints/{name}"


# -- sources ------------------------------------------------------------------

_RAW = "SELECT event_id, event_type AS event_name, user_id, value, epoch_us(ts) AS time_us FROM events"


@query("S17_json_stream", _RAW)
def json_stream(spark, sf):
    job = Job(spark, "json_stream")

    def step(folder):
        run.run_to_table(file_stream(spark, folder, "json", EVENT_SCHEMA, max_files=1), job.out(), job.checkpoint())
        return spark.read.parquet(job.out())

    return arrivals(spark, event_rows(spark, sf), HALF, step)


@query("S18_incremental_ingest", """SELECT 'json' AS source, event_type AS event_name, count(*) AS n FROM events GROUP BY 2
    UNION ALL SELECT 'csv', event_type, count(*) FROM events GROUP BY 2""")
def incremental_ingest(spark, sf):
    job = Job(spark, "ingest")

    def ingest(fmt, **options):
        def step(folder):
            stream = with_provenance(file_stream(spark, folder, fmt, EVENT_SCHEMA, **options))
            run.run_to_table(stream, job.out(fmt), job.checkpoint(fmt))
            return spark.read.parquet(job.out(fmt))

        rows = arrivals(spark, event_rows(spark, sf), HALF, step, fmt, **options)
        counts = rows.where("source_file IS NOT NULL").groupBy("event_name").agg(F.count("*").alias("n"))
        return counts.select(F.lit(fmt).alias("source"), "event_name", "n")

    return ingest("json").union(ingest("csv", header=True))


@query("S19_ingest_schema", """SELECT event_type AS event_name, count(*) AS n, TRUE AS hinted, TRUE AS text_by_default, TRUE AS inferred
    FROM events GROUP BY 1""")
def schema_of_ingest(spark, sf):
    job = Job(spark, "schema")

    def step(folder):
        text = ingest_schema(spark, folder, "json", hints={"value": "double"})
        inferred = ingest_schema(spark, folder, "json", infer=True)
        run.run_to_table(file_stream(spark, folder, "json", text), job.out(), job.checkpoint())
        return spark.read.parquet(job.out()).groupBy("event_name").agg(
            F.count("*").alias("n"),
            F.lit(text["value"].dataType == T.DoubleType()).alias("hinted"),
            F.lit(text["event_id"].dataType == T.StringType()).alias("text_by_default"),
            F.lit(inferred["event_id"].dataType == T.LongType()).alias("inferred"),
        )

    return arrivals(spark, event_rows(spark, sf), HALF, step)


@query("S20_rescued_data", """SELECT event_id, value, CASE event_type WHEN 'error' THEN '{"note":"late"}' WHEN 'view' THEN '{"value":"n/a"}' END AS _rescued_data
      FROM (SELECT event_id, event_type, CASE WHEN event_type <> 'view' THEN value END AS value FROM events WHERE event_type <> 'signup')
    UNION ALL SELECT NULL, NULL, '{"_line":"broken ' || CAST(event_id AS VARCHAR) || '"}' FROM events WHERE event_type = 'signup'""")
def rescued_data(spark, sf):
    name = F.col("event_name")
    good = F.to_json(F.struct("event_id", "value"))
    line = (
        F.when(name == "error", F.to_json(F.struct("event_id", "value", F.lit("late").alias("note"))))
        .when(name == "view", F.to_json(F.struct("event_id", F.lit("n/a").alias("value"))))
        .when(name == "signup", F.concat(F.lit("broken "), F.col("event_id").cast("string")))
        .otherwise(good)
    )
    lines = event_rows(spark, sf).select(line.alias("value"), "time_us")
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    job = Job(spark, "rescue")
    folder = scratch_dir(spark, "lines")
    for part in (HALF, f"NOT ({HALF})"):
        lines.where(part).select("value").write.mode("append").text(folder)
        stream = rescue_json(file_stream(spark, folder, "text", "value string"), schema)
        run.run_to_table(stream, job.out(), job.checkpoint())
    return spark.read.parquet(job.out())


_CSV_FIRST, _CSV_SECOND = ["event_id", "event_name", "value"], ["value", "event_id", "note", "event_name"]


@query("S20_rescued_csv", """WITH e AS (SELECT *, ts < TIMESTAMP '2024-01-16' AS first, event_type AS kind FROM events)
    SELECT CASE WHEN kind <> 'error' OR NOT first THEN event_id END AS event_id, CASE WHEN kind <> 'error' OR NOT first THEN kind END AS event_name,
      CASE WHEN first AND kind IN ('view', 'signup', 'error') THEN NULL ELSE value END AS value,
      CASE WHEN NOT first THEN CASE WHEN kind = 'purchase' THEN '{"note":"a \\"b\\", c"}' END
        WHEN kind = 'view' THEN '{"value":"n/a"}' WHEN kind = 'signup' THEN '{"_missing":"value"}' WHEN kind = 'click' THEN '{"_extra_4":"late"}'
        WHEN kind = 'error' THEN '{"_line":"' || CAST(event_id AS VARCHAR) || ',\\"error"}' END AS _rescued_data FROM e""")
def rescued_csv(spark, sf):
    # the first files have unfit, short, long and broken lines, the second another order of columns and a new one
    name, ident, value = F.col("event_name"), F.col("event_id").cast("string"), F.col("value").cast("string")
    first = (
        F.when(name == "view", F.concat_ws(",", ident, name, F.lit("n/a"))).when(name == "signup", F.concat_ws(",", ident, name))
        .when(name == "click", F.concat_ws(",", ident, name, value, F.lit("late"))).when(name == "error", F.concat(ident, F.lit(',"error')))
        .otherwise(F.concat_ws(",", ident, F.concat(F.lit('"'), name, F.lit('"')), value)))
    second = F.concat_ws(",", value, ident, F.when(name == "purchase", '"a ""b"", c"').otherwise(""), name)
    job, folder = Job(spark, "rescued_csv"), scratch_dir(spark, "csv_lines")
    rows = event_rows(spark, sf)
    for part, line, header in ((HALF, first, _CSV_FIRST), (f"NOT ({HALF})", second, _CSV_SECOND)):
        # every file begins with its own header
        lines = rows.where(part).select(line.alias("value")).mapInPandas(_headed(",".join(header)), "value string")
        lines.write.mode("append").text(folder)
        load_csv(spark, folder, "event_id bigint, event_name string, value double", job.out(), job.checkpoint())
    return read_loaded(spark, job.out()).drop("source_file", "processing_time")


def _headed(header):
    def headed(frames):
        import pandas as pd

        yield pd.DataFrame({"value": [header]})
        yield from frames

    return headed


@query("S19_schema_evolution", """WITH e AS (SELECT *, ts < TIMESTAMP '2024-01-11' AS first, ts < TIMESTAMP '2024-01-21' AS early FROM events)
    SELECT event_id, CASE WHEN early THEN user_id ELSE user_id + 3000000000 END AS user_id,
      CASE WHEN early OR event_type <> 'view' THEN value END AS value, CASE WHEN NOT first THEN event_type END AS note,
      CASE WHEN NOT first THEN event_id END AS points, CASE WHEN NOT early AND event_type = 'view' THEN '{"value":"n/a"}' END AS _rescued_data FROM e""")
def schema_evolution(spark, sf):
    # the second arrival brings two fields, the third numbers too large for the type and text in place of a number
    folder, out = scratch_dir(spark, "evolving_feed"), scratch_dir(spark, "evolving")
    cut = [1704931200000000, 1705795200000000]  # 2024-01-11, 2024-01-21
    rows, kind = event_rows(spark, sf), F.col("event_name")
    new = [kind.alias("note"), F.col("event_id").alias("points")]
    large = (F.col("user_id") + 3_000_000_000).alias("user_id")
    third = rows.where(F.col("time_us") >= cut[1])
    arrived = [
        rows.where(F.col("time_us") < cut[0]).select("event_id", "user_id", "value"),
        rows.where((F.col("time_us") >= cut[0]) & (F.col("time_us") < cut[1])).select("event_id", "user_id", "value", *new),
        third.where("event_name <> 'view'").select("event_id", large, "value", *new),
        third.where("event_name = 'view'").select("event_id", large, F.lit("n/a").alias("value"), *new),
    ]
    for i, part in enumerate(arrived):
        part.write.mode("append").json(folder)
        if i != 2:
            ingest_evolving(spark, folder, out, "event_id bigint, user_id int, value double")
    return read_evolving(spark, out).drop("source_file", "processing_time")


# -- sinks ----------------------------------------------------------------------


@query("K10_load_once", _RAW)
def load_once(spark, sf):
    job = Job(spark, "load_once")

    def step(folder):
        for _ in range(2):  # the second call finds no new file
            load_new_files(spark, folder, "parquet", EVENT_SCHEMA, job.out(), job.checkpoint())
        return spark.read.parquet(job.out())

    return arrivals(spark, event_rows(spark, sf), HALF, step, "parquet")


@query("K11_named_view", "SELECT event_type AS event_name, count(*) AS n FROM events GROUP BY 1")
def named_view(spark, sf):
    job, view = Job(spark, "view"), view_name("read")

    def step(folder):
        run.run_to_view(spark, file_stream(spark, folder, "json", EVENT_SCHEMA), view, job.out(), job.checkpoint())
        return spark.sql(f"SELECT event_name, count(*) AS n FROM {view} GROUP BY event_name")

    return arrivals(spark, event_rows(spark, sf), HALF, step)


@query("K12_complete_mode", "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY user_id")
def complete_mode(spark, sf):
    job = Job(spark, "complete")

    def step(folder):
        totals = file_stream(spark, folder, "json", EVENT_SCHEMA).groupBy("user_id").agg(
            F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")
        )
        run.run_complete(totals, job.out(), job.checkpoint(), state_partitions=job.states)
        return run.read_complete(spark, job.out())

    return arrivals(spark, event_rows(spark, sf), HALF, step)


def _updated_totals(spark, sf, job):
    def step(folder):
        totals = file_stream(spark, folder, "json", EVENT_SCHEMA).groupBy("user_id").agg(
            F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")
        )
        run_updates(totals, job.out(), job.checkpoint(), state_partitions=job.states)

    arrivals(spark, event_rows(spark, sf), HALF, step)


@query("K12_update_mode", "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY user_id")
def update_mode(spark, sf):
    # only changed groups are written; the log and its compacted form, read together, say the same
    job = Job(spark, "updated")
    _updated_totals(spark, sf, job)
    compact_updates(spark, job.out(), job.out("compacted"), ["user_id"])
    return read_updates(spark, [job.out("compacted"), job.out()], ["user_id"])


@query("K12_update_rows", """SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS batch, count(DISTINCT user_id) AS rows_written
    FROM events GROUP BY 1""")
def update_rows(spark, sf):
    job = Job(spark, "update_rows")
    _updated_totals(spark, sf, job)
    return rows_per_batch(spark, job.out())


@query("K13_append_sink", "SELECT event_type AS event_name, event_id FROM events")
def append_sink(spark, sf):
    job = Job(spark, "append")

    def step(folder):
        stream = file_stream(spark, folder, "json", EVENT_SCHEMA).select("event_name", "event_id")
        run.run_to_table(stream, job.out(), job.checkpoint(), partition_by=["event_name"])
        return spark.read.parquet(job.out())

    return arrivals(spark, event_rows(spark, sf), HALF, step)


@query("K14_scheduled_batch", "SELECT count(*) AS n, count(DISTINCT event_id) AS ids, 0 AS rows_without_new_files FROM events")
def scheduled_batch(spark, sf):
    job = Job(spark, "scheduled")
    folders = []

    def step(folder):
        folders.append(folder)
        return run.run_to_table(file_stream(spark, folder, "json", EVENT_SCHEMA), job.out(), job.checkpoint())

    arrivals(spark, event_rows(spark, sf), HALF, step)
    again = step(folders[-1])
    return spark.read.parquet(job.out()).agg(
        F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"), F.lit(again).alias("rows_without_new_files")
    )


# -- stream operators -------------------------------------------------------------


@query("W01_stream_window", f"""SELECT event_type AS event_name, strftime(time_bucket(INTERVAL '1 minute', ts), '%Y-%m-%d %H:%M:%S') AS start_time,
    count(*) AS n FROM events GROUP BY 1, 2""")
def stream_window(spark, sf):
    job = Job(spark, "windows")

    def step(folder):
        events = timed(file_stream(spark, folder, "json", EVENT_SCHEMA))
        counts = events.groupBy("event_name", F.window("event_time", "1 minute").alias("w")).count()
        run.run_complete(counts, job.out(), job.checkpoint(), state_partitions=job.states)
        return run.read_complete(spark, job.out())

    counts = arrivals(spark, event_rows(spark, sf), HALF, step)
    return counts.select("event_name", F.date_format("w.start", STAMP).alias("start_time"), F.col("count").alias("n"))


# one early event in twenty comes with the second arrival, when most of its windows are closed
_ON_TIME = f"{HALF} AND event_id % 20 <> 0"


def _windows_sql(width):
    """timed: each event with its window and whether it came too late for it; bounds: the watermark after each arrival."""
    return f"""arrived AS (SELECT *, ts < TIMESTAMP '2024-01-16' AND event_id % 20 <> 0 AS on_time, time_bucket(INTERVAL '{width}', ts) AS start,
          time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}' AS finish FROM events),
        bounds AS (SELECT max(ts) FILTER (WHERE on_time) - INTERVAL '1 day' AS first, max(ts) - INTERVAL '1 day' AS last FROM arrived),
        timed AS (SELECT arrived.*, NOT on_time AND finish <= first AS late, finish <= last AS closed FROM arrived, bounds)"""


def _closed(spark, sf, job, width, keys, aggregates):
    arrived = []

    def step(folder):
        events = timed(file_stream(spark, folder, "json", EVENT_SCHEMA))
        windows = closed_windows(events, "event_time", keys, width, aggregates, lateness="1 day")
        arrived.append(run.run_to_table(windows, job.out(), job.checkpoint(), state_partitions=job.states))

    arrivals(spark, event_rows(spark, sf), _ON_TIME, step)
    return sum(arrived)


@query("W01_closed_windows", f"""WITH {_windows_sql("1 minute")} SELECT event_type AS event_name, strftime(start, '%Y-%m-%d %H:%M:%S') AS start_time,
    count(*) AS n FROM timed WHERE closed AND NOT late GROUP BY 1, 2""")
def closed_minutes(spark, sf):
    job = Job(spark, "closed_minutes")
    _closed(spark, sf, job, "1 minute", ["event_name"], [])
    return spark.read.parquet(job.out()).select("event_name", F.date_format("window.start", STAMP).alias("start_time"), F.col("rows").alias("n"))


@query("W01_window_report", f"""WITH {_windows_sql("6 hours")} SELECT count(*) AS arrived, count(*) FILTER (WHERE closed AND NOT late) AS published,
    count(*) FILTER (WHERE NOT closed) AS waiting, count(*) FILTER (WHERE late) AS late,
    count(DISTINCT (event_type, start)) FILTER (WHERE closed AND NOT late) AS closed_windows,
    count(DISTINCT (event_type, start)) FILTER (WHERE NOT closed) AS open_windows FROM timed""")
def report_of_windows(spark, sf):
    job = Job(spark, "window_report")
    arrived = _closed(spark, sf, job, "6 hours", ["event_name"], [])
    return window_report(spark, job.out(), job.checkpoint(), arrived)


@query("W03_raw_stream_sql", "SELECT event_id, event_type AS event_name, strftime(ts, '%b-%d %H:%M') AS at FROM events")
def raw_stream_sql(spark, sf):
    job, view = Job(spark, "raw"), view_name("raw")

    def step(folder):
        stream = timed(file_stream(spark, folder, "json", EVENT_SCHEMA))
        run.run_to_view(spark, stream, view, job.out(), job.checkpoint())
        return spark.sql(f"SELECT event_id, event_name, date_format(event_time, 'MMM-dd HH:mm') AS at FROM {view}")

    return arrivals(spark, event_rows(spark, sf), HALF, step)


@query("W04_several_sinks", """SELECT event_type AS event_name, count(*) AS n, count(*) AS n_raw FROM events GROUP BY 1""")
def several_sinks(spark, sf):
    job = Job(spark, "sinks")

    def step(folder):
        source = file_stream(spark, folder, "json", EVENT_SCHEMA)
        run.run_to_table(source, job.out("raw"), job.checkpoint("raw"))
        run.run_complete(source.groupBy("event_name").agg(F.count("*").alias("n")), job.out("counts"), job.checkpoint("counts"), state_partitions=job.states)
        raw = spark.read.parquet(job.out("raw")).groupBy("event_name").agg(F.count("*").alias("n_raw"))
        return run.read_complete(spark, job.out("counts")).join(raw, "event_name")

    return arrivals(spark, event_rows(spark, sf), HALF, step)


@query("W05_stop_all", "SELECT count(*) AS n, FALSE AS any_left FROM events")
def stop_all(spark, sf):
    job = Job(spark, "stopped")
    folder = scratch_dir(spark, "feed")
    event_rows(spark, sf).write.json(folder)

    def start(name):
        stream = file_stream(spark, folder, "json", EVENT_SCHEMA).select("event_id")
        return (
            stream.writeStream.format("parquet").option("path", job.out(name))
            .option("checkpointLocation", job.checkpoint(name)).trigger(processingTime="1 second").start()
        )

    queries = [start("a"), start("b")]
    for q in queries:
        q.processAllAvailable()
    run.stop_all(spark, queries=queries)
    left = any(q.isActive for q in queries)
    a, b = (spark.read.parquet(job.out(n)) for n in "ab")
    return a.join(b, "event_id").agg(F.count("*").alias("n"), F.lit(left).alias("any_left"))


@query("W06_only_new_files", """SELECT count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-16') AS first_run,
    count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-16') AS second_run, count(*) AS n FROM events""")
def only_new_files(spark, sf):
    job, read = Job(spark, "new_files"), []

    def step(folder):
        read.append(run.run_to_table(file_stream(spark, folder, "json", EVENT_SCHEMA), job.out(), job.checkpoint()))
        return spark.read.parquet(job.out())

    rows = arrivals(spark, event_rows(spark, sf), HALF, step)
    return rows.agg(
        F.lit(read[0]).cast("bigint").alias("first_run"), F.lit(read[1]).cast("bigint").alias("second_run"),
        F.count("*").alias("n"),
    )


@query("W07_stream_then_compact", """SELECT event_type AS event_name, count(*) AS n, TRUE AS fewer_files FROM events GROUP BY 1""")
def stream_then_compact(spark, sf):
    job = Job(spark, "compacted")

    def step(folder):
        run.run_to_table(file_stream(spark, folder, "json", EVENT_SCHEMA, max_files=1), job.out(), job.checkpoint())

    arrivals(spark, event_rows(spark, sf), HALF, step)
    streamed = spark.read.parquet(job.out())
    optimize(streamed, job.out("compacted"), ["event_name", "time_us"])
    compacted = spark.read.parquet(job.out("compacted"))
    fewer = file_spans(compacted, "value").count() < file_spans(streamed, "value").count()
    return compacted.groupBy("event_name").agg(F.count("*").alias("n"), F.lit(fewer).alias("fewer_files"))


@query("W08_drop_null_rows", """SELECT event_type AS event_name, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1""")
def drop_null_rows(spark, sf):
    job = Job(spark, "not_null")
    gappy = event_rows(spark, sf).withColumn("event_name", F.when(F.col("event_name") != "error", F.col("event_name")))

    def step(folder):
        whole = file_stream(spark, folder, "json", EVENT_SCHEMA).dropna()
        run.run_complete(whole.groupBy("event_name").agg(F.count("*").alias("n")), job.out(), job.checkpoint(), state_partitions=job.states)
        return run.read_complete(spark, job.out())

    return arrivals(spark, gappy, HALF, step)


@query("W09_stream_daily_mean", """SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, round(avg(value) + 1e-9, 4) AS mean_value FROM events GROUP BY 1, 2""")
def stream_daily_mean(spark, sf):
    job = Job(spark, "daily")

    def step(folder):
        events = timed(file_stream(spark, folder, "json", EVENT_SCHEMA))
        daily = events.groupBy("user_id", F.to_date("event_time").alias("day")).agg(F.avg("value").alias("mean_value"))
        run.run_complete(daily, job.out(), job.checkpoint(), state_partitions=job.states)
        return run.read_complete(spark, job.out())

    means = arrivals(spark, event_rows(spark, sf), HALF, step)
    return means.select("user_id", F.col("day").cast("string").alias("day"), settled(F.col("mean_value")).alias("mean_value"))


@query("W09_closed_days", f"""WITH {_windows_sql("1 day")} SELECT user_id, strftime(start, '%Y-%m-%d') AS day, round(avg(value) + 1e-9, 4) AS mean_value
    FROM timed WHERE closed AND NOT late GROUP BY 1, 2""")
def closed_days(spark, sf):
    job = Job(spark, "closed_days")
    _closed(spark, sf, job, "1 day", ["user_id"], [F.avg("value").alias("mean_value")])
    return spark.read.parquet(job.out()).select(
        "user_id", F.date_format("window.start", "yyyy-MM-dd").alias("day"), settled(F.col("mean_value")).alias("mean_value"))


def _updated_days(spark, sf, job, state):
    def step(folder):
        events = timed(file_stream(spark, folder, "json", EVENT_SCHEMA))
        daily = closed_windows(events, "event_time", ["user_id"], "1 day", [F.avg("value").alias("mean_value")], lateness="1 day")
        run_updates(daily, job.out(), job.checkpoint(), state_partitions=job.states, state=state)

    arrivals(spark, event_rows(spark, sf), HALF, step)


@query("W09_updated_days", """SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, round(avg(value) + 1e-9, 4) AS mean_value FROM events GROUP BY 1, 2""")
def updated_days(spark, sf):
    # open days are shown too, as they stand
    job = Job(spark, "updated_days")
    _updated_days(spark, sf, job, {})
    return read_updates(spark, job.out(), ["user_id", "window"]).select(
        "user_id", F.date_format("window.start", "yyyy-MM-dd").alias("day"), settled(F.col("mean_value")).alias("mean_value"))


@query("W09_update_cost", """WITH days AS (SELECT DISTINCT user_id, date_trunc('day', ts) AS day, ts < TIMESTAMP '2024-01-16' AS early FROM events)
    SELECT count(*) AS rows_written, count(DISTINCT (user_id, day)) AS groups, count(DISTINCT (user_id, day)) FILTER
      (WHERE day + INTERVAL '1 day' > (SELECT max(ts) - INTERVAL '1 day' FROM events)) AS groups_in_state FROM days""")
def update_cost(spark, sf):
    job, state = Job(spark, "update_cost"), {}
    _updated_days(spark, sf, job, state)
    written = rows_per_batch(spark, job.out()).select("rows_written", F.lit(0).alias("groups"))
    groups = read_updates(spark, job.out(), ["user_id", "window"]).select(F.lit(0).alias("rows_written"), F.lit(1).alias("groups"))
    return written.unionByName(groups).agg(
        F.sum("rows_written").alias("rows_written"), F.sum("groups").alias("groups"), F.lit(state["rows"]).cast("bigint").alias("groups_in_state"))


CDC_SCHEMA = "customer_id bigint, name string, email string, state string, operation string, seq_us bigint, seq_id bigint"


def _applied(spark, sf, first):
    job = Job(spark, "applied")
    keys, sequence = ["customer_id"], ["seq_us", "seq_id"]

    def step(folder):
        feed = file_stream(spark, folder, "json", CDC_SCHEMA).where("operation IS NOT NULL")
        apply_changes_stream(feed, keys, sequence, job.out(), job.checkpoint())

    arrivals(spark, change_feed(spark, sf), first, step)
    return job, keys, sequence


@query("T07_apply_changes_stream", f"WITH {STATE} SELECT * FROM state")
def apply_changes_in_order(spark, sf):
    job, keys, sequence = _applied(spark, sf, HALF.replace("time_us", "seq_us"))
    return current_state(spark, job.out(), keys, sequence, "operation = 'DELETE'", drop=["operation"])


@query("W10_late_records", f"WITH {STATE} SELECT * FROM state")
def late_records(spark, sf):
    # the later half arrives first; the log and its compacted form, read together, must still say the same
    job, keys, sequence = _applied(spark, sf, f"NOT ({HALF.replace('time_us', 'seq_us')})")
    compact_log(spark, job.out(), job.out("compacted"), keys, sequence)
    both = [job.out("compacted"), job.out()]
    return current_state(spark, both, keys, sequence, "operation = 'DELETE'", drop=["operation"])


def _maintained(spark, sf, job, first):
    def step(folder):
        feed = file_stream(spark, folder, "json", CDC_SCHEMA).where("operation IS NOT NULL")
        run_group_counts(feed, ["customer_id"], ["seq_us", "seq_id"], "state", "operation = 'DELETE'", job.out(), job.checkpoint(), state_partitions=job.states)

    arrivals(spark, change_feed(spark, sf), first, step)


@query("A20_maintained_counts", f"WITH {STATE} SELECT state, count(*) AS n FROM state GROUP BY state")
def maintained_counts(spark, sf):
    # the later half arrives first; the moves and their compacted form say the same
    job = Job(spark, "maintained")
    _maintained(spark, sf, job, f"NOT ({HALF.replace('time_us', 'seq_us')})")
    compact_moves(spark, job.out(), job.out("compacted"), "state")
    return group_counts(spark, job.out("compacted"), "state")


@query("A20_maintained_moves", f"""WITH {CHANGE_FEED}, known AS (SELECT * FROM change_feed WHERE operation IS NOT NULL),
    images AS (SELECT customer_id, arg_max(CASE operation WHEN 'DELETE' THEN '' ELSE state END, (seq_us, seq_id)) FILTER (WHERE {HALF.replace('time_us', 'seq_us')}) AS before,
      arg_max(CASE operation WHEN 'DELETE' THEN '' ELSE state END, (seq_us, seq_id)) AS after FROM known GROUP BY 1)
    SELECT CAST(sum(CASE WHEN before <> '' THEN 1 ELSE 0 END) + sum(CASE WHEN after <> coalesce(before, '') THEN CASE WHEN before <> '' THEN 1 ELSE 0 END
      + CASE WHEN after <> '' THEN 1 ELSE 0 END ELSE 0 END) AS BIGINT) AS moves FROM images""")
def maintained_moves(spark, sf):
    # what two updates have written: a row for each group a changed customer has left or come to
    job = Job(spark, "moves")
    _maintained(spark, sf, job, HALF.replace("time_us", "seq_us"))
    return spark.read.parquet(job.out()).agg(F.count("*").alias("moves"))


@query("J05_stream_static_left", f"""SELECT event_id, user_id, {EMAIL} AS email FROM events
    LEFT JOIN customer ON user_id = c_custkey AND c_acctbal >= value""")
def stream_static_left(spark, sf):
    job = Job(spark, "static")
    people = users(spark, sf).alias("c")

    def step(folder):
        f = file_stream(spark, folder, "json", EVENT_SCHEMA).alias("f")
        same = (F.col("f.user_id") == F.col("c.user_id")) & (F.col("c.balance") >= F.col("f.value"))
        joined = f.join(people, same, "left").select("f.event_id", "f.user_id", "c.email")
        run.run_to_table(joined, job.out(), job.checkpoint())
        return spark.read.parquet(job.out())

    return arrivals(spark, event_rows(spark, sf), HALF, step)


@query("J07_stream_stream", f"""SELECT event_id, user_id, {EMAIL} AS email FROM events JOIN customer ON user_id = c_custkey""")
def stream_stream(spark, sf):
    job = Job(spark, "two_streams")
    people = scratch_dir(spark, "people")
    users(spark, sf).select(F.col("user_id").alias("customer_id"), "email").write.json(people)

    def step(folder):
        facts = file_stream(spark, folder, "json", EVENT_SCHEMA)
        entities = file_stream(spark, people, "json", "customer_id bigint, email string")
        joined = join_streams(facts, entities, F.col("user_id") == F.col("customer_id"), spread_on=["event_id"])
        named = joined.select("event_id", "user_id", "email")
        run.run_to_table(named, job.out(), job.checkpoint(), state_partitions=job.states)
        return spark.read.parquet(job.out())

    return arrivals(spark, event_rows(spark, sf), HALF, step)


# an event and the sign-ups of its user in the two days before it
_PAIRS = """SELECT a.event_id, b.event_id AS signup_id, a.user_id FROM events AS a JOIN events AS b
    ON a.user_id = b.user_id AND a.event_type <> 'signup' AND b.event_type = 'signup' AND a.ts >= b.ts AND a.ts <= b.ts + INTERVAL '2 days'"""


def _in_time(spark, sf, job, state):
    def step(folder):
        facts = timed(file_stream(spark, folder, "json", EVENT_SCHEMA)).where("event_name <> 'signup'")
        signups = timed(file_stream(spark, folder, "json", EVENT_SCHEMA)).where("event_name = 'signup'").select(
            F.col("event_id").alias("signup_id"), F.col("user_id").alias("member"), F.col("event_time").alias("seen_at"))
        pairs = join_streams(
            facts, signups, F.col("user_id") == F.col("member"), ["event_id"], times=("event_time", "seen_at"), within="2 days", lateness="1 hour")
        run.run_to_table(pairs.select("event_id", "signup_id", "user_id"), job.out(), job.checkpoint(), state_partitions=job.states, state=state)

    arrivals(spark, event_rows(spark, sf), HALF, step)
    return spark.read.parquet(job.out())


@query("J07_in_time", _PAIRS)
def streams_in_time(spark, sf):
    return _in_time(spark, sf, Job(spark, "in_time"), {})


@query("J07_in_time_state", f"""WITH pairs AS ({_PAIRS}) SELECT count(*) AS pairs, (SELECT count(*) FROM events) AS arrived, TRUE AS state_is_bounded FROM pairs""")
def state_in_time(spark, sf):
    # facts of the last hour and sign-ups of the last two days and an hour, each in eight copies, can still meet
    job, state = Job(spark, "in_time_state"), {}
    pairs = _in_time(spark, sf, job, state)
    last = F.max(F.when(F.col("event_name") != "signup", F.col("time_us"))), F.max(F.when(F.col("event_name") == "signup", F.col("time_us")))
    rows = event_rows(spark, sf)
    bound = rows.agg((F.least(*last) - 3_600_000_000).alias("bound")).first()["bound"]
    can_meet = (
        F.when(F.col("event_name") != "signup", (F.col("time_us") >= bound).cast("int"))
        .otherwise(8 * (F.col("time_us") >= bound - 2 * 86_400_000_000).cast("int")))
    seen = rows.select(can_meet.alias("can_meet"), F.lit(1).alias("arrived"), F.lit(0).alias("pair"))
    both = seen.unionByName(pairs.select(F.lit(0).alias("can_meet"), F.lit(0).alias("arrived"), F.lit(1).alias("pair")))
    return both.agg(F.sum("pair").alias("pairs"), F.sum("arrived").alias("arrived"), (F.lit(state["rows"]) <= F.sum("can_meet")).alias("state_is_bounded"))


@query("E03_fail_update", "SELECT TRUE AS stopped, 0 AS committed_by_failure, count(*) AS committed_after_fix FROM events")
def fail_update(spark, sf):
    job = Job(spark, "failed")
    folder = scratch_dir(spark, "feed")
    event_rows(spark, sf).write.json(folder)

    def checked(condition):
        return apply_rules(file_stream(spark, folder, "json", EVENT_SCHEMA), [Rule("valid", condition, "fail")])

    stopped = False
    try:
        run.run_to_table(checked("value < 100"), job.out(), job.checkpoint())
    except StreamingQueryException:
        stopped = True
    before = spark.read.schema(EVENT_SCHEMA).parquet(job.out()).count()
    run.run_to_table(checked("value >= 0"), job.out(), job.checkpoint())
    return spark.read.parquet(job.out()).agg(
        F.lit(stopped).alias("stopped"), F.lit(before).alias("committed_by_failure"),
        F.count("*").alias("committed_after_fix"),
    )
