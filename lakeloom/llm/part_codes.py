"""Compression of vectors into one code a part, with a codebook learned for each part.

Vectors of integers are cut into equal parts. The entries of a part's codebook are
moved to the mean of their parts a few times, and each part is written as the index
of its nearest entry.

Distances go through a lexicographic trie of the distinct parts, each with the number
of its rows: sorted parts are the trie's leaves in depth-first order, and a node is a run
of leaves with one prefix. The walk carries a vector of distances, one for each entry,
down from a node to its children and adds one dimension's squares for each child, so
that a prefix that many parts share is worked out once (numpy takes all nodes of a
batch that have one depth in a step). A leaf takes the least of its
vector; sums for the entries count a leaf as often as rows hold it. The distinct parts
are one aggregation, dealt out by ranges so that subtrees stay together, and written
once; a round is a pass over them that gives a row per part position, entry and task.
Only codebooks reach the driver: parts x entries x dimensions of a part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.llm.common import query, saved, table
from lakeloom.operators.joins import placed_anew

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components beyond this (scaled) are refused: sums of squares over a label must fit a long.
LARGEST = 1 << 27


def integers(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component; null where the vector or a component is null or not finite."""
    doubles = vector.cast("array<double>")
    usable = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(doubles, lambda x: F.floor(x * F.lit(float(scale)))))


def walked(leaves: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per leaf the nearest entry and the distance to it. ``leaves``: distinct parts in lexicographic order."""
    n, width = leaves.shape
    opens = np.zeros(n, bool)  # where a new node begins on this level
    opens[:1] = True
    held = np.zeros((1, len(entries)), np.int64)  # one row per node of the level above
    node = np.zeros(n, np.int64)
    for d in range(width):
        opens[1:] |= leaves[1:, d] != leaves[:-1, d]
        starts = np.flatnonzero(opens)
        held = held[node[starts]] + (leaves[starts, d, None] - entries[None, :, d]) ** 2
        node = np.cumsum(opens) - 1
    best = held.argmin(axis=1)
    return best[node], held[np.arange(len(held)), best][node]


def _flat(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _summed(books: np.ndarray):
    """A batch function: sorted leaves (pos, part, rows) to one row per position and entry: rows and sums."""
    parts, entries, width = books.shape

    def pass_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            pos, rows, leaves = batch.column("pos").to_numpy(), batch.column("rows").to_numpy(), _flat(batch.column("part"), width)
            for p in np.unique(pos):
                at = np.flatnonzero(pos == p)
                code, _ = walked(leaves[at], books[p])
                np.add.at(counts[p], code, rows[at])
                np.add.at(sums[p], code, leaves[at] * rows[at, None])
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(counts[p, e]), *(pa.array(sums[p, e, d]) for d in range(width))],
            names=["pos", "entry", "rows", *(f"d{d}" for d in range(width))])

    return pass_over


def _coded(books: np.ndarray):
    """A batch function: (key, label, vector) to (key, label, code, error), by a trie of the batch for each part."""
    parts, _, width = books.shape

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _flat(batch.column("vector"), parts * width).reshape(-1, parts, width)
            codes, error = np.zeros((len(vectors), parts), np.uint8), np.zeros(len(vectors), np.int64)
            for p in range(parts):
                order = np.lexsort(vectors[:, p, ::-1].T)
                codes[order, p], least = walked(vectors[order, p], books[p])
                error[order] += least
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error)],
                names=["key", "label", "code", "error"])

    return code


def trie(rows: DataFrame, parts: int, width: int) -> DataFrame:
    """Distinct parts with the number of rows that hold them, each partition a stretch of the sorted order."""
    cut = F.explode(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.struct(p.alias("pos"), F.slice("vector", p * width + 1, F.lit(width)).alias("part"))))
    leaves = rows.select(cut.alias("one")).select("one.*").groupBy("pos", "part").agg(F.count(F.lit(1)).alias("rows"))
    return leaves.repartitionByRange("pos", "part").sortWithinPartitions("pos", "part")


def learned(leaves: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """The codebooks after some rounds. ``leaves``: what ``trie`` gives, saved."""
    width = books.shape[2]
    sums = [f"d{d}" for d in range(width)]
    for _ in range(rounds):
        found = leaves.mapInArrow(_summed(books), f"pos int, entry int, rows long, {', '.join(f'{d} long' for d in sums)}")
        totals = found.groupBy("pos", "entry").agg(*(F.sum(c).alias(c) for c in ("rows", *sums)))
        books = books.copy()
        for r in totals.collect():  # parts x entries rows at most
            books[r.pos, r.entry] = np.array([r[d] for d in sums]) // r.rows
    return books


def compressed(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """Per usable row of ``vectors``: key, ``code`` (two hex digits a part), ``error``, ``label_error``, ``codebooks_sha256``.

    Defined results: rows whose vector is null, or holds a null or non-finite component,
    go, and so do rows whose vector isn't as long as that of the first row (by key, null
    keys last, then by vector); a first vector that can't be cut into ``parts`` is an
    error, and so is a component beyond ``LARGEST`` once scaled. Codebooks start from the
    first ``entries`` rows in that order, fewer if there are fewer; rows that repeat a key
    count each. Of equal distances the lower index wins. Null labels make one group. An
    empty table gives an empty result. Columns may have any name.
    """
    spark = vectors.sparkSession
    ints = vectors.select(vectors[f"`{key}`"].alias("key"), vectors[f"`{label}`"].alias("label"), integers(vectors[f"`{vector}`"], scale).alias("vector"))
    rows = saved(ints.where("vector is not null"), "vectors")
    kinds = dict(rows.dtypes)
    schema = f"`{key}` {kinds['key']}, code string, error long, label_error long, codebooks_sha256 string"
    order = [F.col("key").asc_nulls_last(), "vector"]
    start = rows.orderBy(*order).select("vector").limit(1).collect()
    if not start:
        return spark.createDataFrame([], schema)
    length = len(start[0].vector)
    if not length or length % parts:
        raise ValueError(f"a vector of {length} components can't be cut into {parts} parts")
    rows = rows.where(F.size("vector") == length)
    start = np.array([r.vector for r in rows.orderBy(*order).select("vector").limit(entries).collect()], np.int64)
    width = length // parts
    if rows.agg(F.max(F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector"))))).first()[0] > LARGEST:
        raise ArithmeticError(f"components beyond {LARGEST} after scaling")
    books = learned(saved(trie(rows, parts, width), "parts"), start.reshape(-1, parts, width).transpose(1, 0, 2).copy(), rounds)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()

    coded = saved(rows.mapInArrow(_coded(books), f"key {kinds['key']}, label {kinds['label']}, code string, error long"), "codes")
    none, some = F.col("label").isNull().alias("no_label"), F.col("label").alias("group")
    sums = coded.groupBy(none, some).agg(F.sum("error").alias("label_error"))
    sums = placed_anew(sums.withColumn("no_label", F.col("no_label").cast("int")), ["no_label"])
    return coded.join(sums, (F.col("label").isNull().cast("int") == F.col("no_label")) & F.col("label").eqNullSafe(F.col("group"))).select(
        F.col("key").alias(key), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql() -> str:
    """The same by plain SQL: one pair of common table expressions for each round."""
    nearest = """
        SELECT spot, p, part, e AS entry, d FROM (
            SELECT spot, p, part, e, d, row_number() OVER (PARTITION BY spot, p ORDER BY d, e) AS r FROM (
                SELECT spot, c.p, part, e, list_sum(list_transform(list_zip(part, entry), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
                FROM parts AS c JOIN book{k} AS b ON c.p = b.p)) WHERE r = 1"""
    text = f"""
        WITH kept AS (
            SELECT vec_id, label, row_number() OVER () AS spot, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS (
            SELECT spot, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS part FROM kept, range({PARTS}) AS t(p)),
        first AS (SELECT spot, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM kept ORDER BY e LIMIT {ENTRIES}),
        book0 AS (SELECT p, e, part AS entry FROM parts JOIN first USING (spot))"""
    for k in range(ROUNDS):
        text += f""",
        near{k} AS ({nearest.format(k=k)}),
        mean{k} AS (
            SELECT p, entry AS e, list(floor_mean ORDER BY i) AS entry FROM (
                SELECT p, entry, i, (sum(part[i]) - ((sum(part[i]) % count(*)) + count(*)) % count(*))::BIGINT // count(*) AS floor_mean
                FROM near{k}, range(1, 1 + (SELECT max(len(part)) FROM parts)) AS t(i) GROUP BY p, entry, i) GROUP BY p, entry),
        book{k + 1} AS (SELECT b.p, b.e, coalesce(m.entry, b.entry) AS entry FROM book{k} AS b LEFT JOIN mean{k} AS m ON b.p = m.p AND b.e = m.e)"""
    return text + f""",
        last AS ({nearest.format(k=ROUNDS)}),
        coded AS (SELECT spot, string_agg(printf('%02x', entry), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM last GROUP BY spot)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
            (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) FROM book{ROUNDS}) AS codebooks_sha256
        FROM kept JOIN coded USING (spot)"""


@query("op13_vector_codes", _sql())
def op13_vector_codes(spark, sf):
    return compressed(table(spark, sf, "embeddings"))
