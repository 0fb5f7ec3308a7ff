"""Quality classifier from supervised subword embeddings.

Every word, word pair and character trigram of a text (word edges count as a
character) is hashed to a row of a table of vectors; a pair is hashed by the
difference of its words, so that all pairs of equal words share a row. A text is
the average of its features' vectors; a linear layer and a softmax over the two labels follow. Both
are learned by stochastic gradient descent with a step per row that falls with
the gradients seen (numpy, in one task), from at most ``sample`` rows of each
label: those whose key has the smallest hash. Only the model, one number a feature, reaches the driver. The sample is weighted to the label
counts of all training rows. Scoring needs one number per feature, since the
average and the layer are linear, and runs over every whole text.

Defined results: a text without words scores by the bias alone; null texts are
empty; rows without a label, and labels without a document, train nothing; a
document with several labels takes their mean, rounded up; without training rows,
or with one label only, every score is that label's share (0.5 if there is none).
Null keys count as the empty string. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lakeloom.llm import words as W
from lakeloom.llm.common import fields, filled, query, saved, table, whole

BUCKET_BITS = 17


def remainder(key: str, n: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(n))


def _buckets(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Words, word pairs, trigrams: for each, the feature numbers of all texts and where each text's begin (and one end more)."""
    w = W.split(texts)
    hashes = w.hashes()
    pair = np.ones(max(0, len(hashes) - 1), bool)  # a word and the next, unless another text begins there
    pair[w.first[(w.first > 0) & (w.first < len(hashes))] - 1] = False
    pair = np.flatnonzero(pair)
    pairs = W.mixed(hashes[pair + 1] - hashes[pair] + np.uint64(1 << 62))
    codes = np.where(w.space, np.uint32(32), w.codes).astype(np.uint64)
    middle = np.flatnonzero(~w.space)  # any character that isn't white space has one on each side
    before = np.where(middle > 0, codes[middle - 1], np.uint64(32)) if len(codes) else codes
    after = codes[np.minimum(middle + 1, len(codes) - 1)]
    grams = W.mixed((before * np.uint64(0x200003) + codes[middle]) * np.uint64(0x200003) + after + np.uint64(1 << 63))
    return [(_buckets(hashes), w.first), (_buckets(pairs), np.searchsorted(pair, w.first)), (_buckets(grams), np.searchsorted(middle, w.at))]


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text) to (label, ids, counts): each text's distinct features."""
    for batch in batches:
        for part, texts in W.slices(batch):
            found = features(texts)
            bags = [np.unique(np.concatenate([ids[at[i]:at[i + 1]] for ids, at in found]), return_counts=True) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), pa.array([i.astype(np.int32) for i, _ in bags], pa.list_(pa.int32())),
                 pa.array([c.astype(np.int32) for _, c in bags], pa.list_(pa.int32()))], names=["label", "ids", "counts"])


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, weights: np.ndarray, dim: int = 8, steps: int = 1000,
        batch: int = 32, step: float = 0.1, seed: int = 5) -> tuple[np.ndarray, float]:
    """One number per feature, and the bias: a text's log-odds is the mean of its features' numbers plus the bias."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << BUCKET_BITS, dim)).astype(np.float32)
    layer, bias = rng.uniform(-1 / dim, 1 / dim, (dim, 2)).astype(np.float32), np.zeros(2, np.float32)
    vector_seen, layer_seen, bias_seen = np.full(len(vectors), 1e-8, np.float32), np.full((dim, 2), 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    done = 0
    while done < steps:
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            chosen = order[at:at + batch]
            done += 1
            ids = np.concatenate([bags[i][0] for i in chosen])
            share = np.concatenate([bags[i][1] / max(1, bags[i][1].sum()) for i in chosen]).astype(np.float32)
            owner = np.repeat(np.arange(len(chosen)), [len(bags[i][0]) for i in chosen])
            hidden = np.zeros((len(chosen), dim), np.float32)
            for d in range(dim):
                hidden[:, d] = np.bincount(owner, share * vectors[ids, d], len(chosen))
            logits = hidden @ layer + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(chosen)), labels[chosen]] -= 1
            error = p * weights[chosen][:, None] / len(chosen)
            to_hidden = error @ layer.T
            rows, back = np.unique(ids, return_inverse=True)
            change = np.empty((len(rows), dim), np.float32)
            for d in range(dim):
                change[:, d] = np.bincount(back, share * to_hidden[owner, d], len(rows))
            vector_seen[rows] += (change**2).mean(axis=1)
            vectors[rows] -= step * change / np.sqrt(vector_seen[rows])[:, None]
            for value, seen, slope in ((layer, layer_seen, hidden.T @ error), (bias, bias_seen, error.sum(axis=0))):
                seen += slope**2
                value -= step * slope / np.sqrt(seen)
    return vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0])


def _fitted(counts: dict[int, int], **options):
    """A batch function: all rows of ``_bags`` to one row, the model's numbers (as bytes) and its bias."""

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches)
        bags = [(i.values.to_numpy(), c.values.to_numpy()) for i, c in zip(rows["ids"], rows["counts"])]
        order = sorted(range(len(bags)), key=lambda i: (len(bags[i][0]), bags[i][0].tobytes(), bags[i][1].tobytes()))  # whatever order rows came in
        y = rows["label"].to_numpy().astype(int)[order]
        weight = {v: counts[v] / max(1, (y == v).sum()) for v in (0, 1)}
        weights = np.array([weight[v] for v in y])
        numbers, bias = fit([bags[i] for i in order], y, (weights / weights.mean()).astype(np.float32), **options)
        yield pa.RecordBatch.from_arrays([pa.array([numbers.astype(np.float32).tobytes()], pa.binary()), pa.array([bias])], names=["numbers", "bias"])

    return fitted


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = 2000,
          **options) -> tuple[np.ndarray, float]:
    """Learn from ``labels`` (key, label) of rows in ``docs``; at most ``sample`` rows of each label are read as text."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(
        (F.avg(label) >= 0.5).cast("int").alias("label"))
    known = saved(known.join(docs.select(key).distinct(), key), "labelled")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        share = np.clip(counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5, 1e-6, 1 - 1e-6)
        return np.zeros(1 << BUCKET_BITS, np.float32), float(np.log(share / (1 - share)))
    chosen = [known.where(F.col("label") == v).orderBy(F.xxhash64(key), key).limit(sample) for v in (0, 1)]
    chosen = F.broadcast(saved(chosen[0].unionByName(chosen[1]), "sample"))  # at most 2 * sample rows
    bags = docs.select(key, filled(text).alias("text")).join(chosen, key).select("label", "text").mapInArrow(
        _bags, "label int, ids array<int>, counts array<int>")
    model = bags.repartition(1).mapInArrow(_fitted(counts, **options), "numbers binary, bias double").first()
    return np.frombuffer(model["numbers"], np.float32), model["bias"]


def scores(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the chance of label 1, in place of the text. ``docs`` must have no column ``score``."""
    numbers, bias = model
    sent = docs.sparkSession.sparkContext.broadcast((numbers.astype(np.float32), bias))  # fixed size: 2 ** BUCKET_BITS

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, bias = sent.value
        for batch in batches:
            for part, texts in W.slices(batch, text):
                total, n = np.zeros(len(texts)), np.zeros(len(texts))
                for ids, at in features(texts):
                    sums = np.concatenate([[0.0], np.cumsum(numbers[ids], dtype=np.float64)])
                    total += sums[at[1:]] - sums[at[:-1]]
                    n += np.diff(at)
                odds = bias + total / np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([*map(part.column, others), pa.array(1 / (1 + np.exp(-odds)))], names=[*others, "score"])

    others = [c for c in docs.columns if c != text]
    return docs.mapInArrow(score, StructType([*(docs.schema[c] for c in others), StructField("score", DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", **options) -> DataFrame:
    """``docs`` without the rows scored below one half, all columns as they came."""
    rows = whole(docs)
    texts = rows.select("_path", "_row", F.coalesce(F.col(f"_all.`{text}`"), F.lit("")).alias("text"))
    scored = scores(texts, train(fields(rows, key, text), labels, key, text, label, **options))
    bad = saved(scored.where("score < 0.5").select("_path", "_row"), "rejected")
    return rows.join(bad.hint("shuffle_hash"), ["_path", "_row"], "left_anti").select("_all.*")


@query("op6_quality_classifier")
def op6_quality_classifier(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = train(docs, labels.where(remainder("doc_id", 3) != 1))
    scored = scores(docs.select("doc_id", filled().alias("text")), model)
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
