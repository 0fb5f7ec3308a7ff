"""Benchmark decontamination by latent semantic retrieval, confirmed word by word.

Words are counted in hashed buckets over all documents, which gives their
inverse document frequencies. The vocabulary of the search is that of the items,
less the words that more than ``common`` of all documents hold; an item keeps its
``RAREST`` rarest words in any case. A randomised SVD of the TF-IDF rows of
passages (distributed: every power step is a pass over the passages in which
tasks sum their part of ``A'AQ``, and the parts are added block by block; the
driver only orthonormalises a table of fixed size) yields the latent basis. It is
fitted on the items and on every passage of every document, half the weight each.

Every document is then indexed whole, in windows on a grid of ``GRID`` words. A
window for items of n words spans ``n / GRID`` cells rounded up and one more, and
one begins at every cell with a word of the vocabulary, so wherever an item lies,
some window holds all of its vocabulary words. A window's cosine with an item,
times the ratio of their lengths, is the share of the item's latent vector found
in it. Those that reach ``cosine`` are candidates. So are, whatever
their cosine, words that share enough runs of ``RUN`` words with an item
(``anchored`` of its length) on one stretch, and the words around each place where an
item's answer stands without a gap, so that no change of an item's rare words hides
it. Candidates are compared with the item
as sequences of words (with as many words before the window as the item has): an
item has leaked if the longest common subsequence covers ``shared`` of it, or
``paraphrased`` of it and its answer (its last sentence, of three words at least)
is there without a gap.

The benchmark is the query set and goes against all rows in blocks of
``block_items`` items. Words are runs of anything but white space, A-Z in lower
case. Defined results: null or empty texts leak nothing, and null or empty items
are never found; several leaks of an item in a document give one row, the best;
repeated rows are one document if their keys are equal; empty tables give an
empty result; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lakeloom.llm import words as W
from lakeloom.llm.common import filled, query, saved, table, whole

BITS, RANK, GRID, PASSAGE, RAREST = 17, 64, 8, 32, 4
#: Rows of the latent table that are added up together.
ROWS = 128
#: Words of a run by which items are found as they stand; an answer has as many at least. Bits of the table that passes over other runs.
RUN, FLAGS = 3, 22
BUCKETS = 1 << BITS
FOUND = "item_id long, shared double, answer boolean, cosine double, first_word long, n_words long"


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to (bucket, documents it occurs in), for a partition; bucket -1 counts all documents."""
    counts, n = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for _, texts in W.slices(batch):
            w = W.split(texts, lower=True)
            owner = np.repeat(np.arange(len(texts)), np.diff(w.first))
            pairs = np.unique((owner << BITS) | _buckets(w.hashes()))
            counts += np.bincount(pairs & (BUCKETS - 1), minlength=BUCKETS)
            n += len(texts)
    met = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([[-1], met])), pa.array(np.concatenate([[n], counts[met]]))], names=["bucket", "documents"])


def inverse_frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Per bucket: the log of all documents over those it occurs in. All documents are counted."""
    rows = docs.select(filled(text).alias("text")).mapInArrow(_count, "bucket long, documents long")
    found = rows.groupBy("bucket").agg(F.sum("documents").alias("documents")).toArrow()  # at most BUCKETS + 1 rows
    counts = np.zeros(BUCKETS + 1)
    counts[found["bucket"].to_numpy()] = found["documents"].to_numpy()  # -1 is the last
    return np.log((1 + counts[-1]) / (1 + counts[:-1])).astype(np.float32)


def item_weights(items: list[str], idf: np.ndarray, common: float) -> np.ndarray:
    """Per bucket: the weight of its words, zero outside the vocabulary of the search."""
    w = W.split(items, lower=True)
    buckets = _buckets(w.hashes())
    weights = np.zeros(BUCKETS, np.float32)
    for a, b in zip(w.first[:-1], w.first[1:]):
        own = np.unique(buckets[a:b])
        own = own[np.argsort(-idf[own], kind="stable")]
        own = own[:max(RAREST, int((idf[own] >= -np.log(common)).sum()))]
        weights[own] = np.maximum(idf[own], 1e-3)
    return weights


def _passages(sent):
    """A batch function: texts to the vocabulary's words of every passage, as rows of the table; passages without any are left out."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = sent.value
        for batch in batches:
            for _, texts in W.slices(batch):
                w = W.split(texts, lower=True)
                rows = place[_buckets(w.hashes())]
                live = np.flatnonzero(rows >= 0)
                text_of = np.searchsorted(w.first, live, side="right") - 1
                before = np.concatenate([[0], np.cumsum(-(-np.diff(w.first) // PASSAGE))])
                passage = before[text_of] + (live - w.first[text_of]) // PASSAGE
                offsets = np.append(np.flatnonzero(np.diff(passage, prepend=-1)), len(live)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(rows[live].astype(np.int32)))], names=["rows"])

    return cut


def passages(texts: DataFrame, place: np.ndarray, text: str = "text") -> DataFrame:
    """The passages of all whole texts that hold a word of the vocabulary: ``rows``, their words' rows of the table. ``place``: as of ``latent_table``."""
    sent = texts.sparkSession.sparkContext.broadcast(place)
    return texts.select(filled(text).alias("text")).mapInArrow(_passages(sent), "rows array<int>")


def _power_step(sent):
    """A batch function: passages to the task's part of A'AQ, in blocks of ``ROWS`` rows. Rows stand for the vocabulary's buckets."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, basis = sent.value
        total = np.zeros(basis.shape)
        for batch in batches:
            lists = batch.column("rows")
            rows, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            offsets, each = offsets - offsets[0], np.sqrt(batch.column("weight").to_numpy()).astype(np.float32)
            for low in range(0, len(each), 4096):
                high = min(low + 4096, len(each))
                part, first = rows[offsets[low]:offsets[high]], offsets[low:high] - offsets[low]
                owner = np.repeat(np.arange(high - low), np.diff(offsets[low:high + 1]))
                weight = weights[part]
                weight *= (each[low:high] / (np.sqrt(np.add.reduceat(weight**2, first)) + 1e-9))[owner]
                image = np.add.reduceat(weight[:, None] * basis[part], first, axis=0)
                order = np.argsort(part, kind="stable")
                ids, at = np.unique(part[order], return_index=True)
                total[ids] += np.add.reduceat((weight[:, None] * image[owner])[order], at, axis=0)
        task = TaskContext.get().partitionId()
        blocks = [b for b in range(0, len(total), ROWS) if total[b:b + ROWS].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int32()), pa.array([task] * len(blocks), pa.int32()), pa.array([total[b:b + ROWS].tobytes() for b in blocks], pa.binary())],
            names=["block", "task", "part"])

    return step


def _summed(parts: pa.Table) -> pa.Table:
    """The parts of one block, added in the order of their tasks."""
    whole = sum(np.frombuffer(p.as_py()) for p in parts.sort_by("task")["part"])
    return pa.table({"block": pa.array([parts["block"][0].as_py()], pa.int32()), "part": pa.array([whole.tobytes()], pa.binary())})


def latent_table(docs: DataFrame, items: DataFrame, n_items: int, weights: np.ndarray, text: str, steps: int = 2, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(place of a bucket in the table or -1, table of the words' latent vectors, weight included)."""
    context = docs.sparkSession.sparkContext
    live = np.flatnonzero(weights)
    place = np.full(BUCKETS, -1, np.int32)
    place[live] = np.arange(len(live))
    corpus = saved(passages(docs, place, text), "passages")
    share = n_items / max(1, corpus.count())  # the corpus weighs as much as the items
    every = corpus.withColumn("weight", F.lit(float(share))).unionByName(saved(passages(items, place), "passages").withColumn("weight", F.lit(1.0)))
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(live), min(RANK, len(live)))))[0].astype(np.float32)
    for left in range(steps, -1, -1):
        sent = context.broadcast((weights[live], basis))
        parts = every.mapInArrow(_power_step(sent), "block int, task int, part binary")
        image = np.zeros(basis.shape)
        for row in parts.groupBy("block").applyInArrow(_summed, "block int, part binary").toArrow().to_pylist():  # the table once, whatever the tasks
            image[row["block"]:row["block"] + ROWS] = np.frombuffer(row["part"]).reshape(-1, basis.shape[1])
        if left:
            basis = np.linalg.qr(image)[0].astype(np.float32)
    _, turn = np.linalg.eigh(basis.T.astype(np.float64) @ image)
    return place, (weights[live, None] * (basis @ turn)).astype(np.float32)


def answer_of(text: str) -> list[str]:
    """The words of the last sentence, if there is one before it."""
    parts = [p for p in re.split(r"(?<=[.?!:])\s+|\n+", text.strip()) if p.split()]
    return parts[-1].split() if len(parts) > 1 else []


def longest_common(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, one row of the table per step as bits of a number."""
    at: dict[int, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        if m := at.get(x):
            met = row & m
            row = ((row + met) | (row - met)) & full
    return len(a) - row.bit_count()


class Items:
    """Benchmark items prepared for comparison."""

    def __init__(self, ids: list[int], texts: list[str], place: np.ndarray, table_: np.ndarray):
        w = W.split(texts, lower=True)
        hashes = w.hashes()
        self.ids = ids
        self.words = [hashes[a:b].tolist() for a, b in zip(w.first[:-1], w.first[1:])]
        answers = W.split([" ".join(answer_of(t)) for t in texts], lower=True)
        answer_hashes = answers.hashes()
        self.answers = [answer_hashes[a:b].tolist() for a, b in zip(answers.first[:-1], answers.first[1:])]
        # runs of words by their hash: the item, the run's place in it, and whether the item's answer begins there
        runs = _runs(hashes)
        item = np.searchsorted(w.first, np.arange(len(runs)), side="right") - 1
        inside = np.arange(len(runs)) + RUN <= w.first[item + 1]
        openings = [(i, int(_runs(np.array(a[:RUN], np.uint64))[0])) for i, a in enumerate(self.answers) if len(a) >= RUN]
        hashed = np.concatenate([runs[inside], np.array([h for _, h in openings], np.uint64)])
        self.run_item = np.concatenate([item[inside], np.array([i for i, _ in openings], np.int64)])
        self.run_place = np.concatenate([(np.arange(len(runs)) - w.first[item])[inside], np.full(len(openings), -1)])
        order = np.argsort(hashed, kind="stable")
        self.runs, self.run_item, self.run_place = hashed[order], self.run_item[order], self.run_place[order]
        self.any_run = np.zeros(1 << FLAGS, bool)
        self.any_run[self.runs >> np.uint64(64 - FLAGS)] = True
        self.sizes = np.diff(w.first)
        cells = -(-np.diff(w.first) // GRID) + 1
        table_ = np.vstack([table_, np.zeros((1, table_.shape[1]), np.float32)])
        vectors = np.stack([table_[place[_buckets(hashes[a:b])]].sum(axis=0) for a, b in zip(w.first[:-1], w.first[1:])])
        lengths = np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-9
        # a window's vector times these is its cosine with the item times the ratio of their lengths
        self.by_cells = {int(c): (np.flatnonzero(cells == c), np.ascontiguousarray((vectors / lengths**2)[cells == c].T), float(lengths[cells == c].min()))
                         for c in np.unique(cells)}


def _runs(hashes: np.ndarray) -> np.ndarray:
    """A hash of every ``RUN`` words in a row."""
    n = max(0, len(hashes) - RUN + 1)
    out = np.zeros(n, np.uint64)
    for j in range(RUN):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + n]
    return W.mixed(out)


def _anchored(items: Items, w: W.Words, hashes: np.ndarray, anchored: float) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, first word, last word) to compare: where an item's answer stands, and stretches with enough of an item's runs."""
    runs = _runs(hashes)
    at = np.flatnonzero(items.any_run[runs >> np.uint64(64 - FLAGS)])
    low, high = (np.searchsorted(items.runs, runs[at], side=side) for side in ("left", "right"))
    each = high - low
    at, place = np.repeat(at, each), np.repeat(low - np.concatenate([[0], np.cumsum(each)[:-1]]), each) + np.arange(each.sum())
    item, place = items.run_item[place], items.run_place[place]
    text = np.searchsorted(w.first, at, side="right") - 1
    for p, i, t in zip(*(x[place < 0].tolist() for x in (at, item, text))):
        answer, n = items.answers[i], len(items.words[i])
        if hashes[p:p + len(answer)].tolist() == answer:
            end = p + len(answer) + GRID
            yield t, i, end - 2 * (n + GRID), end
    begin, item, text = (x[place >= 0] for x in (at - place, item, text))  # where the item would begin
    sizes = items.sizes[item]
    for shift in (0, sizes // 2):  # stretches that overlap by half, so that one holds what belongs together
        bins = np.stack([text, item, (begin + shift) // sizes], axis=1)
        found, first, n = np.unique(bins, axis=0, return_index=True, return_counts=True)
        for (t, i, _), b, size in zip(*(x[n >= np.maximum(2, anchored * items.sizes[found[:, 1]])].tolist() for x in (found, begin[first], items.sizes[found[:, 1]]))):
            yield t, i, b - size // 2, b + size + size // 2 + GRID


def _holds(words: list[int], part: list[int]) -> bool:
    return any(words[i:i + len(part)] == part for i in range(len(words) - len(part) + 1) if words[i] == part[0])


def _finder(sent, key: str, cosine: float, shared: float, paraphrased: float, anchored: float):
    """A batch function: texts to the items found in them."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, table_, items = sent.value
        least = min(shared, paraphrased)
        for batch in batches:
            for part, texts in W.slices(batch, chars=1_000_000):
                w = W.split(texts, lower=True)
                hashes = w.hashes()
                out: list[tuple] = []

                def compare(text: int, item: int, low: int, high: int, near: float) -> None:
                    """Add what words ``low`` to ``high`` (moved inside the text) show of an item."""
                    first, last = int(w.first[text]), int(w.first[text + 1])
                    low, high = max(first, low), min(high, last)
                    words, here = items.words[item], hashes[low:high].tolist()
                    known = set(here)
                    if sum(x in known for x in words) < least * len(words):
                        return
                    share, answer = longest_common(words, here) / len(words), items.answers[item]
                    answered = len(answer) >= RUN and _holds(here, answer)
                    if share >= shared or share >= paraphrased and answered:
                        out.append((text, items.ids[item], share, answered, near, low - first, high - low))

                for text, item, low, high in _anchored(items, w, hashes, anchored):
                    compare(text, item, low, high, 0.0)
                rows = place[_buckets(hashes)]
                live = np.flatnonzero(rows >= 0)
                if len(live):
                    text_of = np.searchsorted(w.first, live, side="right") - 1
                    cells_before = np.concatenate([[0], np.cumsum(-(-np.diff(w.first) // GRID))])
                    cell = cells_before[text_of] + (live - w.first[text_of]) // GRID
                    begins = np.flatnonzero(np.diff(cell, prepend=-1))
                    cell, owner = cell[begins], text_of[begins]  # cells with a word of the vocabulary
                    starts = w.first[owner] + GRID * (cell - cells_before[owner])
                    sums = np.zeros((len(cell) + 1, table_.shape[1]), np.float32)
                    np.cumsum(np.add.reduceat(table_[rows[live]], begins, axis=0), axis=0, out=sums[1:])
                    for cells, (which, vectors, shortest) in items.by_cells.items():
                        stop = np.searchsorted(cell, np.minimum(cell + cells, cells_before[owner + 1]))
                        windows = sums[stop] - sums[:-1]
                        length = np.sqrt(np.einsum("ij,ij->i", windows, windows))
                        fit = np.flatnonzero(length >= cosine * shortest)  # a shorter vector can't have that share of any item
                        near = windows[fit] @ vectors
                        for c, i in zip(*np.nonzero(near >= cosine)):
                            begin = int(starts[fit[c]])
                            compare(int(owner[fit[c]]), int(which[i]), begin - len(items.words[which[i]]), begin + cells * GRID, float(near[c, i]))
                if out:
                    columns = list(zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(key).take(pa.array(columns[0], pa.int64())), *map(pa.array, columns[1:])],
                        names=[key, "item_id", "shared", "answer", "cosine", "first_word", "n_words"])

    return find


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", cosine: float = 0.45, shared: float = 0.8,
          paraphrased: float = 0.6, anchored: float = 0.15, common: float = 0.02, block_items: int = 20_000) -> DataFrame:
    """Per document and item found in it: key, item_id, shared (of the item), answer, cosine, first_word, n_words."""
    spark = docs.sparkSession
    items = saved(benchmark.select("item_id", filled("text").alias("text")).where(F.length(F.trim(F.translate("text", "\t\n\x0b\x0c\r", "     "))) > 0), "items")
    n_items = items.count()
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, {FOUND}"
    if not n_items or docs.isEmpty():
        return spark.createDataFrame([], schema)
    idf = inverse_frequencies(docs, text)
    blocks = -(-n_items // block_items)
    found = []
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        rows = block.orderBy("item_id", "text").toArrow()
        if not len(rows):
            continue
        texts = rows["text"].to_pylist()
        place, table_ = latent_table(docs, block.select("text"), len(rows), item_weights(texts, idf, common), text)
        sent = spark.sparkContext.broadcast((place, table_, Items(rows["item_id"].to_pylist(), texts, place, table_)))
        found.append(docs.select(key, filled(text).alias("text")).mapInArrow(_finder(sent, key, cosine, shared, paraphrased, anchored), schema))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    best = F.max(F.struct("shared", "answer", "cosine", (-F.col("first_word")).alias("before"), "n_words")).alias("best")
    return every.groupBy(key, "item_id").agg(best).select(
        key, "item_id", "best.shared", "best.answer", "best.cosine", (-F.col("best.before")).alias("first_word"), "best.n_words")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold an item, all columns as they came."""
    rows = whole(docs).withColumn("_number", F.xxhash64("_path", "_row"))
    texts = rows.select("_number", F.col(f"_all.`{text}`").alias("text"))
    gone = saved(leaks(texts, benchmark, "_number", "text", **options).select("_number").distinct(), "leaks")
    return rows.join(gone.hint("shuffle_hash"), "_number", "left_anti").select("_all.*")


@query("op9_benchmark_decontamination")
def op9_benchmark_decontamination(spark, sf):
    return leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
