"""Exact deduplication as a stream with state on disk.

Texts are equal when their bytes are, after each run of white space became one
space; a null text is an empty one. The stream's state keeps, per digest of the
normalised text and without expiry, the smallest identifier seen, the place of
its row and the number of rows. A digest that was met more than once is only a
hit: the full texts of its rows are compared before any is called a copy.

Of equal texts the row with the smallest identifier stays; null identifiers
come last, and rows that repeat an identifier are told apart by their place.
An empty table gives an empty result. Extra columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.llm.common import SPACE, fields, filled, located, query, saved, table, whole
from lakeloom.session import scratch_dir

#: State on disk; its files take the room they need and reserve none, since each state partition has its own.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(filled(text), SPACE, " ")


def _first_row(key: str) -> Column:
    """Orders rows as candidates to stay."""
    return F.struct(F.col(key).isNull().alias("no_id"), F.col(key).alias("id"), "_path", "_row")


def seen_digests(feed: DataFrame, folder: str, key: str, bytes_per_trigger: int) -> DataFrame:
    """Stream the rows of ``folder`` (written from ``feed``) through keyed state; per digest: first row and count."""
    spark = feed.sparkSession
    out, checkpoint = scratch_dir(spark, "seen"), scratch_dir(spark, "seen-checkpoint")

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    state = (
        spark.readStream.schema(feed.schema).option("maxBytesPerTrigger", bytes_per_trigger).parquet(folder)
        .groupBy("digest").agg(F.min(_first_row(key)).alias("first"), F.count(F.lit(1)).alias("n"))
    )
    before = {k: spark.conf.get(k, None) for k in STATE}
    try:  # the stream takes its settings when it starts
        for k, v in STATE.items():
            spark.conf.set(k, v)
        stream = (
            state.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).foreachBatch(publish).start()
        )
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    stream.awaitTermination()
    # a digest comes again in each batch that meets it: its first row only gets smaller, its count only larger
    updates = spark.createDataFrame([], state.schema) if feed.isEmpty() else spark.read.schema(state.schema).parquet(out)
    return updates.groupBy("digest").agg(F.min("first").alias("first"), F.max("n").alias("n"))


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", digest_chars: int = 64,
                 bytes_per_trigger: int = 64 << 30) -> DataFrame:
    """Per row of ``docs``: key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` and its place.

    ``digest_chars`` shortens the digest (hex digits of SHA-256) the state is
    keyed by. The answer doesn't depend on it, since hits are checked.
    """
    rows = located(docs.select(key, text))
    sha = F.sha2(normalised(text), 256)
    feed = rows.select(key, sha.alias("text_sha256"), "_path", "_row").withColumn("digest", F.substring("text_sha256", 1, digest_chars))
    folder = scratch_dir(docs.sparkSession, "digests")
    feed.write.parquet(folder)
    feed = docs.sparkSession.read.schema(feed.schema).parquet(folder)
    seen = saved(seen_digests(feed, folder, key, bytes_per_trigger), "keepers")
    matched = feed.join(seen, "digest")

    # full bytes of the hits: the places are spread evenly, and a group shrinks to two texts before it is shuffled
    hits = saved(matched.where("n > 1").select("_path", "_row", "digest", F.pmod(F.xxhash64("_path", "_row"), F.lit(64)).alias("salt")), "hits")
    texts = rows.select("_path", "_row", normalised(text).alias("whole")).join(hits.hint("shuffle_hash"), ["_path", "_row"])
    compared = (
        texts.groupBy("digest", "salt").agg(F.min("whole").alias("low"), F.max("whole").alias("high"))
        .groupBy("digest").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    )
    unlike = saved(compared.where("low <> high").select("digest"), "unlike")
    result = matched
    if not unlike.isEmpty():  # one digest, several texts: group these rows by the text itself
        apart = rows.select(key, "_path", "_row", sha.alias("text_sha256"), normalised(text).alias("whole")).withColumn(
            "digest", F.substring("text_sha256", 1, digest_chars)).join(unlike, "digest")
        groups = apart.groupBy("whole").agg(F.min(_first_row(key)).alias("first"), F.count(F.lit(1)).alias("n"))
        mended = apart.join(groups, "whole").drop("whole")
        result = matched.join(unlike, "digest", "left_anti").unionByName(mended.select(matched.columns))
    return result.select(
        key, F.col("first.id").alias("keep_id"), F.col("n").alias("group_size"),
        ((F.col("_path") == F.col("first._path")) & (F.col("_row") == F.col("first._row"))).alias("kept"),
        "text_sha256", "_path", "_row",
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they came."""
    rows = whole(docs)
    gone = exact_groups(fields(rows, key, text), key, text).where(~F.col("kept")).select("_path", "_row")
    return rows.join(gone.hint("shuffle_hash"), ["_path", "_row"], "left_anti").select("_all.*")


@query("op8_exact_dedup", r"""WITH d AS (SELECT doc_id,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
        doc_id = min(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)""")
def op8_exact_dedup(spark, sf):
    return exact_groups(table(spark, sf, "documents")).drop("_path", "_row")
