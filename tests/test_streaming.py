"""Streams on small literal feeds: only new files, order, retries, failures."""

import json
import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lakeloom.operators.quality import Rule, apply_rules
from lakeloom.plans import customers, event_windows, orders, recordings, retail, status
from lakeloom.sources.ingest import file_stream, load_new_files
from lakeloom.streaming import run
from lakeloom.streaming.changes import apply_changes_stream, compact_log, current_state
from lakeloom.suite.streams import arrivals


class Feed:
    """A folder that JSON files arrive in."""

    def __init__(self, folder):
        self.folder, self.files = folder, 0
        folder.mkdir(parents=True)

    def add(self, *records, text=None):
        self.files += 1
        body = text if text is not None else "\n".join(json.dumps(r) for r in records)
        (self.folder / f"{self.files:03d}.json").write_text(body + "\n")

    def __str__(self):
        return str(self.folder)


@pytest.fixture
def feed(tmp_path):
    return Feed(tmp_path / "feed")


def test_load_new_files_is_idempotent(spark, feed, tmp_path, rows):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    feed.add({"a": 1}, {"a": 2})
    assert load_new_files(spark, str(feed), "json", "a int", out, checkpoint) == 2
    assert load_new_files(spark, str(feed), "json", "a int", out, checkpoint) == 0
    feed.add({"a": 3})
    assert load_new_files(spark, str(feed), "json", "a int", out, checkpoint) == 1
    assert rows(spark.read.parquet(out)) == [(1,), (2,), (3,)]


def test_a_late_file_with_an_old_date_is_read(spark, feed, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    feed.add({"a": 1})
    load_new_files(spark, str(feed), "json", "a int", out, checkpoint)
    feed.add({"a": 2})
    month_ago = time.time() - 30 * 86_400
    os.utime(feed.folder / "002.json", (month_ago, month_ago))
    assert load_new_files(spark, str(feed), "json", "a int", out, checkpoint) == 1


def test_rows_are_counted_past_the_kept_reports(spark, feed, tmp_path):
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for i in range(5):
            feed.add({"a": i})
        stream = file_stream(spark, str(feed), "json", "a int", max_files=1)

        def slow(df, n):
            df.count()
            time.sleep(1.5)

        assert run.run_batches(stream, slow, str(tmp_path / "cp")) == 5
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


def test_one_file_per_trigger_makes_one_batch_per_file(spark, feed, tmp_path):
    for i in range(3):
        feed.add({"a": i})
    batches = []
    run.run_batches(
        file_stream(spark, str(feed), "json", "a int", max_files=1),
        lambda df, n: batches.append((n, df.count())), str(tmp_path / "cp"),
    )
    assert batches == [(0, 1), (1, 1), (2, 1)]


def test_complete_output_follows_the_state(spark, feed, tmp_path, rows):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def update():
        counts = file_stream(spark, str(feed), "json", "name string").groupBy("name").count()
        run.run_complete(counts, out, checkpoint)
        return rows(run.read_complete(spark, out))

    feed.add({"name": "Open"}, {"name": "Fail"})
    assert update() == [("Fail", 1), ("Open", 1)]
    feed.add({"name": "Open"})
    assert update() == [("Fail", 1), ("Open", 2)]
    assert update() == [("Fail", 1), ("Open", 2)]
    feed.add({"name": "Late"})
    assert update() == [("Fail", 1), ("Late", 1), ("Open", 2)]
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["slot=0", "slot=1"]


CHANGES = [
    {"k": "a", "seq": 1, "op": "INSERT", "v": 1}, {"k": "a", "seq": 4, "op": "UPDATE", "v": 4},
    {"k": "b", "seq": 1, "op": "INSERT", "v": 1}, {"k": "b", "seq": 3, "op": "DELETE"},
    {"k": "b", "seq": 2, "op": "UPDATE", "v": 2}, {"k": "c", "seq": 2, "op": "DELETE"},
    {"k": "c", "seq": 5, "op": "INSERT", "v": 5}, {"k": "a", "seq": 4, "op": "UPDATE", "v": 4},
]


@pytest.mark.parametrize("order", ["given", "reversed", "one batch"])
def test_changes_in_any_order_give_one_state(spark, feed, tmp_path, rows, order):
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "cp")

    def apply():
        changes = file_stream(spark, str(feed), "json", "k string, seq int, op string, v int", max_files=1)
        apply_changes_stream(changes, ["k"], ["seq"], log, checkpoint)
        return rows(current_state(spark, log, ["k"], ["seq"], "op = 'DELETE'", drop=["op"]))

    if order == "one batch":
        feed.add(*CHANGES)
    else:
        for c in CHANGES if order == "given" else CHANGES[::-1]:
            feed.add(c)
    want = [("a", 4, 4), ("c", 5, 5)]
    assert apply() == want
    feed.add({"k": "b", "seq": 1, "op": "UPDATE", "v": 9})  # late, and older than the delete
    assert apply() == want
    compact_log(spark, log, str(tmp_path / "compact"), ["k"], ["seq"])
    assert rows(current_state(spark, str(tmp_path / "compact"), ["k"], ["seq"], "op = 'DELETE'", ["op"])) == want


def test_a_repeated_batch_leaves_no_duplicates(spark, feed, tmp_path):
    """The sink writes, then the job dies before its commit; the rerun must replace the batch."""
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    feed.add({"a": 1}, {"a": 2})
    died = []

    def write(df, n):
        df.write.mode("overwrite").parquet(f"{out}/batch={n}")
        if not died:
            died.append(n)
            raise RuntimeError("lost")

    stream = file_stream(spark, str(feed), "json", "a int")
    with pytest.raises(StreamingQueryException):
        run.run_batches(stream, write, checkpoint)
    run.run_batches(stream, write, checkpoint)
    assert spark.read.parquet(out).count() == 2


def test_failed_rule_commits_nothing(spark, feed, tmp_path):
    out, checkpoint = tmp_path / "out", str(tmp_path / "cp")
    feed.add({"a": 1}, {"a": -1})
    checked = apply_rules(file_stream(spark, str(feed), "json", "a int"), [Rule("positive", "a > 0", "fail")])
    with pytest.raises(StreamingQueryException):
        run.run_to_table(checked, str(out), checkpoint)
    assert not list(out.glob("part-*.parquet")) or spark.read.schema("a int").parquet(str(out)).isEmpty()


def test_a_stream_over_its_time_is_stopped(spark, feed, tmp_path):
    feed.add({"a": 1})
    with pytest.raises(TimeoutError):
        run.run_batches(
            file_stream(spark, str(feed), "json", "a int"), lambda df, n: time.sleep(8), str(tmp_path / "cp"), timeout=1
        )
    assert not spark.streams.active


def test_stop_all(spark, feed, tmp_path):
    feed.add({"a": 1})
    for name in "xy":
        (file_stream(spark, str(feed), "json", "a int").writeStream.format("parquet")
         .option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"cp{name}")).start())
    assert len(spark.streams.active) == 2
    run.stop_all(spark)
    assert not spark.streams.active


def test_named_view(spark, feed, tmp_path):
    feed.add({"a": 1})
    run.run_to_view(spark, file_stream(spark, str(feed), "json", "a int"), "arrived", str(tmp_path / "o"), str(tmp_path / "c"))
    assert spark.sql("SELECT sum(a) FROM arrived").first()[0] == 1


# -- whole flows: two arrivals, then one without news ------------------------------


def test_orders_flow(spark, feed, tmp_path, rows):
    out = str(tmp_path / "out")
    day = 86_400
    feed.add({"order_id": 1, "customer_id": 1, "order_timestamp": 1640995200, "notifications": "Y"})
    orders.update(spark, str(feed), out)
    feed.add({"order_id": 2, "customer_id": 1, "order_timestamp": 1640995200 + day, "notifications": "N"},
             {"order_id": 3, "customer_id": 2, "order_timestamp": 1640995300 + day, "notifications": "N"})
    for _ in range(2):
        daily = rows(orders.update(spark, str(feed), out).withColumn("order_date", F.col("order_date").cast("string")))
        assert daily == [("2022-01-01", 1), ("2022-01-02", 2)]
    feed.add({"order_id": 4, "customer_id": 2, "order_timestamp": 5, "notifications": "N"})
    with pytest.raises(StreamingQueryException):  # dated before the shop opened
        orders.update(spark, str(feed), out)
    assert spark.read.parquet(f"{out}/silver").count() == 3


def test_customers_flow(spark, feed, tmp_path, rows):
    out = str(tmp_path / "out")
    base = {"name": "N", "state": "S1", "seq_id": 1}
    feed.add({**base, "customer_id": 1, "email": "a@x.com", "operation": "INSERT", "seq_us": 1},
             {**base, "customer_id": 2, "email": "b@x.com", "operation": "INSERT", "seq_us": 1},
             {**base, "customer_id": 3, "email": "broken", "operation": "INSERT", "seq_us": 1},
             {**base, "customer_id": 4, "email": "d@x.com", "seq_us": 1})
    assert customers.update(spark, str(feed), out).count() == 2
    feed.add({"customer_id": 2, "operation": "DELETE", "seq_us": 9, "seq_id": 2},
             {**base, "customer_id": 1, "email": "new@x.com", "state": "S2", "operation": "UPDATE", "seq_us": 5})
    state = customers.update(spark, str(feed), out)
    assert rows(state.select("customer_id", "email", "state")) == [(1, "new@x.com", "S2")]
    assert rows(customers.counts_by_state(state).drop("last_change")) == [("S2", 1)]


def test_status_flow(spark, feed, tmp_path, rows):
    feed.add({"order_id": 1, "order_status": "placed", "status_timestamp": 50},
             {"order_id": 1, "order_status": "shipped", "status_timestamp": 150},
             {"order_id": 2, "order_status": "shipped", "status_timestamp": 160})
    silver = status.update(spark, str(feed), str(tmp_path / "out"), since=100)
    emails = spark.createDataFrame([(1, "a@x.com")], "order_id bigint, email string")
    got = status.email_updates(silver, emails).select("order_id", "order_status", "email")
    assert rows(got) == [(1, "shipped", "a@x.com")]


def test_retail_flow_keeps_orders_without_a_customer(spark, feed, tmp_path, rows):
    people = tmp_path / "people"
    people.mkdir()
    (people / "a.csv").write_text("customer_id,customer_name,state,city,units_purchased,loyalty_segment\n1,A,CA,Los Angeles,1.0,x\n\"broken\n")
    (people / "b.csv").write_text("phone,customer_id,customer_name,units_purchased\n555,3,C,many\n")
    product = {"id": 1, "price": 2.5, "qty": 2, "curr": "USD"}
    head = {"customer_name": "A", "number_of_line_items": 1, "order_datetime": "1640995200"}
    feed.add({**head, "customer_id": 1, "order_number": 1, "ordered_products": [product, {**product, "curr": "EUR"}]},
             {**head, "customer_id": 2, "order_number": 2, "ordered_products": [product]},
             {**head, "customer_id": 1, "ordered_products": [product]})
    stored = retail.update(spark, str(feed), str(people), str(tmp_path / "out"))
    assert rows(stored.select("order_number", "city")) == [(1, "Los Angeles"), (2, None)]
    sold = retail.sales_in(["Los Angeles"], stored).select("curr", "month", "revenue", "units", "dearest_line", "mean_unit_price")
    assert rows(sold) == [("EUR", "2022-01", 2.5, 2.0, 2.5, 1.25), ("USD", "2022-01", 2.5, 2.0, 2.5, 1.25)]
    # what the customer files held beside the schema is still there
    kept = spark.read.parquet(str(tmp_path / "out" / "customers")).where("_rescued_data IS NOT NULL")
    assert [r[0] for r in rows(kept.select("_rescued_data"))] == ['{"_line":"\\"broken"}', '{"phone":"555","units_purchased":"many"}']


def test_arrivals_made_once_hold_the_same_lines(spark, rows):
    made = spark.sparkContext.accumulator(0)

    def count(x):
        made.add(1)
        return x

    df = spark.range(10).select("id", F.udf(count, "double")(F.when(F.col("id") != 3, F.col("id") * 1.5)).alias("v"))

    def lines(**how):
        seen = []
        arrivals(spark, df, "v < 6", lambda folder: seen.append(rows(spark.read.text(folder))), odd=True, **how)
        return seen

    assert lines(once=True) == lines() and len(lines(once=True)[0]) == 3
    made.value = 0
    lines(once=True)
    assert made.value == 10


def test_recordings_flow_reads_its_schema_once(spark, feed, tmp_path, rows):
    people = tmp_path / "people"
    people.mkdir()
    (people / "a.csv").write_text("mrn,name\n7,Ann\n8,Bob\n")
    base = {"device_id": 1, "time": 1640995200.5}
    feed.add({**base, "reading_id": 1, "mrn": 7, "heartrate": 60}, {**base, "reading_id": 2, "mrn": 7, "heartrate": -1},
             {**base, "reading_id": 3, "mrn": 9, "heartrate": 70})

    def update():
        daily = recordings.update(spark, str(feed), str(people), str(tmp_path / "out"))
        return rows(daily.withColumn("date", F.col("date").cast("string")))

    assert update() == [(7, "Ann", "2022-01-01", 60.0)]
    feed.add({**base, "reading_id": 4, "mrn": 7, "heartrate": 80, "unknown": 1}, {**base, "reading_id": 5, "mrn": 8, "heartrate": 50})
    assert update() == [(7, "Ann", "2022-01-01", 70.0), (8, "Bob", "2022-01-01", 50.0)]


def test_event_windows_count_eight_of_ten(spark, feed, tmp_path, rows):
    start = 1640995200
    feed.add(*[{**({} if i in (3, 7) else {"event_name": "Open"}), "event_time": start + 10 * i} for i in range(10)])
    counts = event_windows.update(spark, str(feed), str(tmp_path / "out"))
    assert counts.agg(F.sum("count")).first()[0] == 8
    assert sorted(r["count"] for r in counts.collect()) == [3, 5]


def test_a_torn_result_is_not_shown(spark, tmp_path):
    from lakeloom.streaming import run as runs

    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    for k in range(3):
        spark.range(k * 10, k * 10 + 10).write.mode("append").parquet(feed)
        stream = spark.readStream.schema("id long").parquet(feed).groupBy((F.col("id") % 4).alias("g")).count()
        runs.run_complete(stream, out, str(tmp_path / "cp"))
    whole = sorted(tuple(r) for r in runs.read_complete(spark, out).collect())
    # the next batch's job died after one file: its folder holds a part, and no note says it is whole
    spark.createDataFrame([(99, 1)], "g long, count long").write.mode("overwrite").parquet(f"{out}/slot=1")
    assert sorted(tuple(r) for r in runs.read_complete(spark, out).collect()) == whole


def test_state_of_joined_streams_is_dropped(spark, tmp_path):
    from lakeloom.streaming.joins import join_streams

    held = []
    for k in range(4):  # an hour apart, so that earlier rows can meet nothing more
        at = F.timestamp_seconds(F.lit(1_700_000_000 + k * 36_000) + F.col("id"))
        spark.range(100).select("id", at.alias("at")).write.mode("append").parquet(str(tmp_path / "a"))
        spark.range(100).select(F.col("id").alias("key"), at.alias("since")).write.mode("append").parquet(str(tmp_path / "b"))
        a = spark.readStream.schema("id long, at timestamp").parquet(str(tmp_path / "a"))
        b = spark.readStream.schema("key long, since timestamp").parquet(str(tmp_path / "b"))
        joined = join_streams(a, b, F.col("id") == F.col("key"), ["at"], salt=2, times=("at", "since"))
        query = joined.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 400
    assert max(held) <= 2 * 300  # two batches' rows at most, the entities twice: older state went


def test_raw_tables_lose_nothing(spark, tmp_path):
    from lakeloom.plans import event_windows, orders

    feed, out = tmp_path / "feed", str(tmp_path / "out")
    feed.mkdir()
    (feed / "a.json").write_text('{"order_id": 1, "customer_id": 2, "order_timestamp": 1700000000, "gift": "yes"}\n{"order_id": 7, \n')
    (feed / "b.json").write_text('{"order_id": 2, "customer_id": "many", "order_timestamp": 1700000001}\n')
    assert [r[1] for r in orders.update(spark, str(feed), out).collect()] == [2]
    kept = {r._rescued_data for r in spark.read.parquet(f"{out}/bronze").collect()}
    assert kept == {'{"gift":"yes"}', '{"_line":"{\\"order_id\\": 7, "}', '{"customer_id":"many"}'}
    (tmp_path / "events").mkdir()
    (tmp_path / "events" / "a.json").write_text('{"event_name": "Open", "event_time": "2024-01-01 10:00:00", "x": 1}\nbroken\n{"event_name": "Fail"}\n')
    counts = event_windows.update(spark, str(tmp_path / "events"), str(tmp_path / "windows"))
    assert [(r.event_name, r["count"]) for r in counts.collect()] == [("Open", 1)]
    assert spark.read.parquet(str(tmp_path / "windows" / "raw")).where("_rescued_data IS NOT NULL").count() == 2
