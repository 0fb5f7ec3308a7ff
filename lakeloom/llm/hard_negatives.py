"""Hard negatives for anchors: unlike rows nearly as close as the anchor's nearest like rows.

Scores are inner products of integer vectors. The search is exact: anchors are
clustered by direction (``CLUSTERS`` centres, fitted on a bounded sample of anchors;
the fit steers the order of work only, never a result). For a cluster, every candidate
of a batch gets one upper bound of its score with any member of length one: its
length times the cosine of its angle to the centre less the cluster's widest angle.
The candidates are sorted by it once, and every member walks that one list from the
top, a stretch at a time, until the bound of what follows, times its own length, can
no longer reach its list of best: then the walk's end is certified.

Anchors come in blocks of at most ``BLOCK`` numbers (a bounded part of the given query
set), each against all rows, which stay where they are: a task keeps the best of the
rows it has seen and gives a few rows for each anchor, and the best of all tasks are
taken by a window. Like rows are searched first; their scores then bound the range in
which unlike rows are searched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeloom.llm.common import query, saved, table
from lakeloom.llm.part_codes import integers

POSITIVES, NEGATIVES, SCALE = 5, 3, 256
CLUSTERS, SAMPLE, STRETCH = 32, 4096, 512
#: Vector components of one block of anchors.
BLOCK = 1 << 20
#: Sums of products of doubles are exact below this.
_EXACT = 1 << 53
_NONE = np.iinfo(np.int64).min
_FOUND = ["anchor", "slot", "score", "id", "spot"]
_FOUND_TYPE = ", ".join(f"{c} long" for c in _FOUND)


class Best:
    """The ``k`` best (score, then smaller id, then smaller place) of each of some lists."""

    def __init__(self, lists: int, k: int):
        self.k = k
        self.rows = np.empty((0, 4), np.int64)  # list, score, id, spot
        self.least = np.full(lists, _NONE)  # the k-th score of a full list

    def offer(self, lists: np.ndarray, scores: np.ndarray, fits: np.ndarray, ids: np.ndarray, spots: np.ndarray) -> None:
        """``scores``, ``fits``: one row per list named, one column per candidate."""
        held = np.where(fits, scores, _NONE)
        bar = self.least[lists]
        if held.shape[1] > self.k:
            bar = np.maximum(bar, np.partition(held, -self.k, axis=1)[:, -self.k])
        row, col = np.nonzero((held >= bar[:, None]) & fits)
        if not len(row):
            return
        new = np.stack([lists[row], held[row, col], ids[col], spots[col]], axis=1)
        rows = np.concatenate([self.rows, new])
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        first = np.searchsorted(rows[:, 0], rows[:, 0])
        self.rows = rows = rows[np.arange(len(rows)) - first < self.k]
        last = np.flatnonzero(np.arange(len(rows)) - np.searchsorted(rows[:, 0], rows[:, 0]) == self.k - 1)
        self.least[rows[last, 0]] = rows[last, 1]


def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    return vectors / np.maximum(lengths, 1e-300)[:, None], lengths


def centres_of(sample: np.ndarray, clusters: int = CLUSTERS, turns: int = 8) -> np.ndarray:
    """Unit centres by spherical k-means, from a bounded sample."""
    units, _ = _unit(sample.astype(np.float64))
    centres = units[np.linspace(0, len(units) - 1, min(clusters, len(units))).astype(int)]
    for _ in range(turns):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        moved, lengths = _unit(sums)
        centres = np.where(lengths[:, None] > 0, moved, centres)
    return centres


def _products(members: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Exact inner products."""
    largest = max(1, int(np.abs(members).max())) * max(1, int(np.abs(items).max())) * members.shape[1]
    if largest < _EXACT:
        return (members.astype(np.float64) @ items.T.astype(np.float64)).astype(np.int64)
    if largest < 1 << 63:
        return members @ items.T
    raise ArithmeticError("a score may not fit a long")


class Cluster:
    """The anchors of one block that have one centre."""

    def __init__(self, at: np.ndarray, vectors: np.ndarray, centre: np.ndarray):
        units, self.lengths = _unit(vectors.astype(np.float64))
        self.at, self.vectors, self.centre = at, vectors, centre
        self.widest = float(np.arccos(np.clip(units @ centre, -1, 1)).max()) + 1e-7

    def walk(self, items: np.ndarray, seen: Callable, bars: Callable) -> None:
        """``seen(members, columns, scores)`` takes stretches of the shared list; ``bars(members)`` is what a member still needs."""
        units, lengths = _unit(items.astype(np.float64))
        angle = np.arccos(np.clip(units @ self.centre, -1, 1))
        bound = lengths * np.cos(np.clip(angle - self.widest, 0, np.pi)) + 1e-6 * (1 + lengths)
        order = np.argsort(-bound, kind="stable")
        bound = bound[order]
        active = np.arange(len(self.at))
        for a in range(0, len(order), STRETCH):
            # a zero anchor scores zero with all; bounds below zero are least for the shortest anchor
            reach = bound[a] * self.lengths[active] + 1e-6
            active = active[reach >= bars(self.at[active])]
            if not len(active):
                return
            columns = order[a:a + STRETCH]
            seen(self.at[active], columns, _products(self.vectors[active], items[columns]))


def _rows_of(best: Best, anchors: np.ndarray) -> pa.RecordBatch:
    """What was found, for each anchor and slot (lists of one anchor follow one another)."""
    slots = len(best.least) // len(anchors)
    lists, score, ids, spot = best.rows.T
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (anchors[lists // slots], lists % slots, score, ids, spot)], names=_FOUND)


def _batch(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    items = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return items.reshape(batch.num_rows, -1), *(batch.column(c).to_numpy() for c in ("spot", "id", "label"))


def _like(clusters: list[Cluster], spots: np.ndarray, labels: np.ndarray, k: int):
    """A batch function: rows to the best like rows of each anchor, of those a task has."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(spots), k)
        for items, spot, ids, label in map(_batch, batches):
            def seen(members, columns, scores):
                fits = (labels[members][:, None] == label[columns]) & (spots[members][:, None] != spot[columns])
                best.offer(members, scores, fits, ids[columns], spot[columns])

            for cluster in clusters:
                cluster.walk(items, seen, lambda members: best.least[members])
        yield _rows_of(best, spots)

    return search


def _unlike(clusters: list[Cluster], spots: np.ndarray, labels: np.ndarray, scores_of: np.ndarray, low: int, high: int, k: int):
    """A batch function: rows to the best unlike rows of each anchor and positive. ``scores_of``: per anchor, its positives' scores."""
    slots = scores_of.shape[1]
    # 100 * score must lie between low and high times the positive's; no positive: nothing fits
    least = np.where(scores_of == _NONE, 1, -(-low * scores_of // 100))
    most = np.where(scores_of == _NONE, 0, high * scores_of // 100)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(spots) * slots, k)

        def bars(members):
            kept = np.maximum(best.least.reshape(-1, slots)[members], least[members])
            return np.where(least[members] > most[members], np.inf, kept.astype(np.float64)).min(axis=1)

        for items, spot, ids, label in map(_batch, batches):
            def seen(members, columns, scores):
                unlike = labels[members][:, None] != label[columns]
                for s in range(slots):
                    fits = unlike & (scores >= least[members, s, None]) & (scores <= most[members, s, None])
                    if fits.any():
                        best.offer(members * slots + s, scores, fits, ids[columns], spot[columns])

            for cluster in clusters:
                cluster.walk(items, seen, bars)
        yield _rows_of(best, spots)

    return search


def _top(found: DataFrame, k: int) -> DataFrame:
    """The best of all tasks, with their rank from 1."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "spot")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _assigned(centres: np.ndarray):
    """A batch function: anchors to (spot, cluster)."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _batch(batch)[0].astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("spot"), pa.array((vectors @ centres.T).argmax(axis=1).astype(np.int32))], names=["spot", "cluster"])

    return assign


def hard_negatives(
    vectors: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: Column | None = None,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = 50, high: int = 95, scale: int = SCALE, block: int = BLOCK,
) -> DataFrame:
    """Per anchor and positive, its first hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors``: condition on the columns ``id`` and ``label`` of an anchor; ``label``: the label by
    the columns of ``vectors``, the column ``label`` if left out. A component x counts as
    ``floor(scale * x)``. An anchor's positives are its best ``positives`` other rows of its
    label, the negatives the best rows of another label whose score is ``low`` to ``high``
    hundredths of the positive's.

    Defined results: rows with a null label, a null vector, or a null or non-finite component
    take no part, nor do rows without a key, which no result could name, nor vectors not as
    long as the first row's (by key, then by vector). Equal scores go by the smaller key, then by place; rows that
    repeat a key are rows of their own, as anchors too. An anchor without positives, or a
    positive without negatives in its range, gives no row, nor does an empty table. Scores
    that may not fit a long are an error. Columns may have any name.
    """
    spark = vectors.sparkSession
    label = vectors["label"] if label is None else label
    rows = vectors.select(vectors[f"`{key}`"].cast("long").alias("id"), label.cast("long").alias("label"), integers(vectors[f"`{vector}`"], scale).alias("vector"))
    rows = saved(rows.dropna().withColumn("spot", F.monotonically_increasing_id()), "vectors")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    start = rows.orderBy("id", "vector").select(F.size("vector").alias("n")).limit(1).collect()
    if not start or not start[0].n:
        return spark.createDataFrame([], schema)
    width = start[0].n
    rows = rows.where(F.size("vector") == width)
    asked = rows.where(anchors)
    sample = asked.orderBy(F.xxhash64("spot"), "spot").select("vector").limit(SAMPLE).collect()
    if not sample:
        return spark.createDataFrame([], schema)
    centres = centres_of(np.array([r.vector for r in sample], np.int64))
    placed = saved(asked.mapInArrow(_assigned(centres), "spot long, cluster int"), "clusters")
    # each cluster is dealt into pieces that `block` allows, and a block takes pieces up to that size
    size = max(1, block // width)
    counts = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).orderBy("cluster").collect()  # a row per centre
    pieces = [-(-r.n // size) for r in counts]
    first = np.cumsum([0, *pieces]).tolist()
    dealt = F.create_map(*(F.lit(x) for r, a, n in zip(counts, first, pieces) for x in (r.cluster, F.struct(F.lit(a).alias("first"), F.lit(n).alias("n")))))[F.col("cluster")]
    placed = placed.withColumn("piece", (dealt["first"] + F.pmod(F.xxhash64("spot"), dealt["n"])).cast("int"))
    chosen = saved(asked.join(placed, "spot").select("spot", "id", "label", "vector", "cluster", "piece"), "anchors")
    sizes = {r.piece: r.n for r in chosen.groupBy("piece").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks, held = [], size
    for piece, n in sorted(sizes.items()):
        if held + n > size:
            blocks.append([])
            held = 0
        blocks[-1].append(piece)
        held += n

    out = []
    for block_pieces in blocks:
        here = chosen.where(F.col("piece").isin(block_pieces))
        members = sorted(here.collect(), key=lambda r: r.spot)  # about `size` anchors
        spots, labels = (np.array([r[c] for r in members], np.int64) for c in ("spot", "label"))
        given, own = np.array([r.vector for r in members], np.int64), np.array([r.cluster for r in members])
        clusters = [Cluster(np.flatnonzero(own == c), given[own == c], centres[c]) for c in np.unique(own)]
        like = saved(_top(rows.mapInArrow(_like(clusters, spots, labels, positives), _FOUND_TYPE), positives), "positives")
        scores_of = np.full((len(spots), positives), _NONE)
        for r in like.select("anchor", "rank", "score").collect():  # `positives` rows for each anchor of the block
            scores_of[np.searchsorted(spots, r.anchor), r["rank"] - 1] = r.score
        unlike = _top(rows.mapInArrow(_unlike(clusters, spots, labels, scores_of, low, high, negatives), _FOUND_TYPE), negatives)
        paired = like.select("anchor", (F.col("rank") - 1).cast("long").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        named = unlike.select("anchor", "slot", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        ids = here.select(F.col("spot").alias("anchor"), F.col("id").alias("anchor_id"))
        out.append(saved(
            named.join(paired, ["anchor", "slot"]).join(ids, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives"))
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


_SQL = """
    WITH kept AS (
        SELECT row_number() OVER () AS spot, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.spot AS anchor, a.vec_id AS anchor_id, b.spot, b.vec_id, a.label = b.label AS alike, list_inner_product(a.v::DOUBLE[], b.v::DOUBLE[])::BIGINT AS score
        FROM kept AS a JOIN kept AS b ON a.vec_id % 50 = 0 AND a.spot <> b.spot),
    positives AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, spot) AS place FROM scored WHERE alike) WHERE place <= 5),
    negatives AS (
        SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
            row_number() OVER (PARTITION BY p.anchor, p.spot ORDER BY n.score DESC, n.vec_id, n.spot)::INTEGER AS rank
        FROM positives AS p JOIN scored AS n ON p.anchor = n.anchor AND NOT n.alike AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3"""


@query("op12_hard_negatives", _SQL)
def op12_hard_negatives(spark, sf):
    vectors = table(spark, sf, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, F.col("id") % 50 == 0, label=label)
