"""Mixing sources to target weights.

The words of each source form one stream (rows in the order of a hash), packed
into blocks of a fixed number of words; only a source's last block is shorter.
A source's target is its share, by weight, of all words, stopped at ``ceiling``
times its size. For every output shard the slots are dealt to the sources by a
multinomial draw from the targets; the draws are then settled so that a source
gets the slots its target needs, no more and no less. A source's k-th slot takes
the block that a pseudorandom permutation of its block numbers (another one for
every round through the source) puts at place k. Blocks and slots meet in a join
on (source, block). The last slot of a source is cut where the target is met.

Defined results: null text: size zero; empty source: target zero; a null source
is a source; null keys and repeated rows are rows like any other (ties go by
text); an empty table gives an empty result. Extra columns are not read. Nothing
depends on how the rows lie in files, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from lakeloom.llm.common import SPACE, filled, located, query, saved, table

#: Rows of a source that are numbered together; larger sources have more such runs.
RUN_ROWS = 20_000


def size_of(text: str = "text"):
    """Words of the text."""
    spaced = F.trim(F.regexp_replace(filled(text), SPACE, " "))
    return F.when(spaced == "", 0).otherwise(F.length(spaced) - F.length(F.replace(spaced, F.lit(" "))) + 1).cast("long")


def source_targets(sizes: DataFrame, weights=(1, 2, 3), ceiling: float = 3.0) -> DataFrame:
    """Per source: source, source_size, target. ``sizes`` has one row per source.

    Where shares above the ceiling are dealt again until none is above, every
    target ends as ``min(ceiling * size, level * weight)`` with one level for all.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("weight", F.get(cycle, F.pmod(number, F.lit(len(weights))))).withColumn("top", F.col("source_size") * ceiling)
    by_ratio = Window.orderBy(F.col("top") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    below = F.sum("top").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1))
    above = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(below, F.lit(0.0))) / above)
    # the first source, from the one that stops lowest, which that level doesn't stop
    open_at = F.when(F.col("level") * F.col("weight") <= F.col("top"), F.struct(F.row_number().over(by_ratio).alias("at"), "level"))
    s = s.withColumn("open_at", open_at).withColumn("final", F.min("open_at").over(every)["level"])
    return s.select("source", "source_size", F.coalesce(F.least("top", F.col("final") * F.col("weight")), "top").alias("target"))


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's place in its source's stream: _path, _row, key, source, size, start."""
    content = F.xxhash64(filled(text))
    sized = saved(located(docs.select(key, "source", text)).select(
        "_path", "_row", key, "source", size_of(text).alias("size"), content.alias("content"),
        F.xxhash64(key, content).alias("spread")), "sizes")
    runs = saved(sized.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / RUN_ROWS).alias("runs")), "runs").alias("n")
    placed = sized.alias("d").join(runs, F.col("d.source").eqNullSafe(F.col("n.source"))).select(
        "d.*", F.pmod("spread", "runs").alias("run"))
    inside = Window.partitionBy("source", "run").orderBy("spread", key, "content").rowsBetween(Window.unboundedPreceding, -1)
    placed = saved(placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))), "placed")
    ahead = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = saved(
        placed.groupBy("source", "run").agg(F.sum("size").alias("run_size"))
        .select("source", "run", F.coalesce(F.sum("run_size").over(ahead), F.lit(0)).alias("ahead")), "run-starts").alias("r")
    return placed.alias("d").join(starts, F.col("d.source").eqNullSafe(F.col("r.source")) & (F.col("d.run") == F.col("r.run"))).select(
        "_path", "_row", key, "d.source", "size", (F.col("inside") + F.col("ahead")).alias("start"))


def pieces(places: DataFrame, block_words: int) -> DataFrame:
    """The part of each row in each block it touches: block, at (its place there), skip (words of the row before it), words."""
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    each = places.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    return each.select("_path", "_row", "source", "block", (low - F.col("block") * block_words).alias("at"),
                       (low - F.col("start")).alias("skip"), (high - low).alias("words"))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, n: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """The place of ``index`` in a pseudorandom permutation of 0..n-1 chosen by ``seed``, elementwise.

    A four-round Feistel network on the smallest even number of bits that holds
    n; a value outside 0..n-1 goes through again until it falls inside.
    """
    index, n, seed = index.astype(np.uint64), n.astype(np.uint64), seed.astype(np.uint64)
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n.astype(float), 2)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.copy(), np.arange(len(index))
    while len(todo):
        h, m, s = half[todo], mask[todo], seed[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in range(4):
            left, right = right, left ^ (_mixed(right + s * np.uint64(0x9E3779B97F4A7C15) + np.uint64(r + 1)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def shard_counts(shares: list[tuple[str | None, float]], shard_slots: int, seed: int):
    """A batch function: shard numbers to (shard, source, drawn), one multinomial draw per shard."""

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [name for name, _ in shares]
        p = np.array([share for _, share in shares])
        for frame in frames:
            for shard in frame["id"]:
                counts = np.random.default_rng([seed, int(shard)]).multinomial(shard_slots, p)
                yield pd.DataFrame({"shard": int(shard), "source": names, "drawn": counts})

    return draw


def slots(targets: DataFrame, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """Every output slot: shard, slot (orders a shard), source, block, cut (words taken of the block; null: all)."""
    spark = targets.sparkSession
    plan = targets.where("source_size > 0").select(
        "source", "source_size", F.ceil(F.col("source_size") / block_words).alias("blocks"), F.round("target").cast("long").alias("wanted"))
    # a round takes all blocks once; what is left after whole rounds may meet the short block, so it plans one slot more
    rounds, rest = F.floor(F.col("wanted") / F.col("source_size")), F.col("wanted") % F.col("source_size")
    part = F.when(rest > 0, F.least(F.col("blocks"), F.ceil(rest / block_words) + 1)).otherwise(F.lit(0))
    plan = saved(plan.withColumns({"rounds": rounds, "rest": rest, "n_slots": rounds * F.col("blocks") + part}), "plan")
    wanted = [(r["source"], r["n_slots"]) for r in plan.select("source", "n_slots").collect()]  # one row per source
    total = sum(n for _, n in wanted)
    shards = -(-total // shard_slots)
    drawn = spark.range(shards).mapInPandas(
        shard_counts([(s, n / total) for s, n in wanted if total], shard_slots, seed), "shard long, source string, drawn long").alias("d")
    # settle: a source's cumulated draws, stretched to end at the slots it needs
    so_far, all_shards = Window.partitionBy("source").orderBy("shard"), Window.partitionBy("source")
    drawn = drawn.select("shard", "source", F.sum("drawn").over(so_far).alias("upto"), F.sum("drawn").over(all_shards).alias("every"),
                         F.row_number().over(so_far).alias("nth")).alias("d")
    share = F.when(F.col("every") > 0, F.col("upto") / F.col("every")).otherwise(F.col("nth") / F.lit(max(shards, 1)))
    dealt = drawn.join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source"))).select(
        "shard", "p.*", F.round(share * F.col("n_slots")).cast("long").alias("upto"))
    dealt = dealt.withColumn("after", F.coalesce(F.lag("upto").over(so_far), F.lit(0))).where("upto > after")

    @F.pandas_udf("long")
    def block_at(place: pd.Series, n: pd.Series, chosen: pd.Series) -> pd.Series:
        return pd.Series(permuted(place.to_numpy(), n.to_numpy(), chosen.to_numpy()))

    each = dealt.withColumn("k", F.explode(F.sequence(F.col("after"), F.col("upto") - 1)))
    each = each.withColumn("round", F.floor(F.col("k") / F.col("blocks"))).withColumn("place", F.col("k") % F.col("blocks"))
    each = saved(each.select(
        "shard", "source", "k", "round", "place", "rounds", "rest", (F.col("blocks") * block_words - F.col("source_size")).alias("lacks"),
        (F.col("blocks") - 1).alias("last"), block_at("place", "blocks", F.xxhash64(F.lit(seed), "source", "round")).alias("block")), "slots")
    # the last round stops when it has its words: count those before each slot, the short block's shortness off
    short = saved(each.where("block = last AND round = rounds").select("source", F.col("place").alias("short_place")), "short").alias("s")
    before = F.col("place") * block_words - F.when(F.col("short_place") < F.col("place"), F.col("lacks")).otherwise(0)
    cut = F.when(F.col("round") == F.col("rounds"), F.greatest(F.lit(0), F.col("rest") - before))
    return each.alias("e").join(short, F.col("e.source").eqNullSafe(F.col("s.source")), "left").select(
        "shard", F.xxhash64(F.lit(seed), "shard", "e.source", "k").alias("slot"), "e.source", "block", cut.alias("cut")).where(
        "cut IS NULL OR cut > 0")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", weights=(1, 2, 3), ceiling: float = 3.0,
        block_words: int = 512, shard_slots: int = 1024, seed: int = 17) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix of ``docs``: (rows with their place, targets, what the slots take).

    The last has a row per slot and piece: shard, slot, source, block, at, _path,
    _row, skip, words.
    """
    places = saved(packed(docs, key, text), "places")
    targets = saved(source_targets(places.groupBy("source").agg(F.sum("size").alias("source_size")), weights, ceiling), "targets")
    p, s = pieces(places, block_words).alias("p"), saved(slots(targets, block_words, shard_slots, seed), "dealt").alias("s")
    words = F.least("words", F.coalesce(F.col("cut") - F.col("at"), "words"))
    taken = p.join(s, F.col("p.source").eqNullSafe(F.col("s.source")) & (F.col("p.block") == F.col("s.block"))).select(
        "shard", "slot", "p.source", "p.block", "at", "_path", "_row", "skip", words.alias("words")).where("words > 0")
    return places, targets, taken


def mixed_blocks(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The mix itself: shard, slot, source, block, n_words, text (the block's words, joined by one space)."""
    docs = located(docs.select(key, "source", text))
    _, _, taken = mix(docs, key, text, **options)
    part = F.struct("shard", "slot", "source", "block", "at", "skip", "words")
    parts = taken.groupBy("_path", "_row").agg(F.collect_list(part).alias("parts"))  # at most `ceiling` times a row's blocks
    words = F.filter(F.split(filled(text), SPACE), lambda w: w != "")
    cut = F.transform("parts", lambda p: p.withField("text", F.array_join(F.slice("all_words", p["skip"] + 1, p["words"]), " ")))
    split = docs.select("_path", "_row", text).join(parts.hint("shuffle_hash"), ["_path", "_row"]).select("parts", words.alias("all_words"))
    each = split.select(F.inline(cut))
    return each.groupBy("shard", "slot", "source", "block").agg(
        F.sum("words").alias("n_words"), F.sort_array(F.collect_list(F.struct("at", "text"))).alias("texts")).select(
        "shard", "slot", "source", "block", "n_words", F.array_join("texts.text", " ").alias("text"))


@query("op3_source_mixing")
def op3_source_mixing(spark, sf):
    places, targets, taken = mix(table(spark, sf, "documents"))
    used = taken.groupBy("_path", "_row").agg(F.sum("words").alias("taken"))
    t = targets.alias("t")
    return places.join(used, ["_path", "_row"], "left").alias("d").join(t, F.col("d.source").eqNullSafe(F.col("t.source"))).select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
