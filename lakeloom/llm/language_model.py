"""Scores of texts under a hashed maximum-entropy language model.

Tokens are the words of a text (A-Z in lower case) and one end. A token's chance
is factored by classes: ``P(class | history) * P(token | class)``. The end and the
most frequent words are classes of their own, any other word belongs to a class
by its last two characters. The class softmax has one weight per class for every
hashed feature of the history: the previous token, the pair of previous tokens,
the token before the previous one (a skip), and a bias. In a class the softmax
has a bias per token alone, whose best value is known: the token's share of the
class, after an absolute discount that goes to the class's unknown token. So the
chances of all known tokens and of each class's unknown one sum to one.

Everything is learned from all training rows. Counts come from one aggregation.
The class weights are trained in ``rounds``, each over another part of the rows:
every task starts from the common weights, makes a gradient step per block of
tokens, and gives its change; the changes are averaged by tokens on the
executors, by parts of the weight table and of at most ``FAN_IN`` tasks at a time.

Scoring takes counts of the ``FREQUENT`` most frequent words, at most, along to
the texts. Rarer words are looked up by a join on their hash, so the vocabulary
may be of any size. Words are told apart by 64-bit hashes.

Defined results: a null text is empty, an empty text is one end; null keys count
as the empty string where rows are split; repeated rows are rows; without
training rows every token has chance one under the base and the model is the
untrained one; an empty table gives an empty result; extra columns are not read.
Whole texts are used, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lakeloom.llm import words as W
from lakeloom.llm.common import filled, query, saved, table
from lakeloom.llm.quality import remainder

OWN, SUFFIXES = 15, 32  # classes of one word; classes by suffix
CLASSES = 1 + OWN + SUFFIXES
FEATURE_BITS = 14
ROWS = 1 + 3 * (1 << FEATURE_BITS)
FREQUENT = 1 << 18
END, START = np.uint64(1), np.uint64(2)
BLOCK = 16_384  # tokens of a gradient step
PART_ROWS = 4096  # rows of the weight table that are summed together
FAN_IN = 64  # tasks whose changes are summed in one place
CHANGES = "part long, task long, tokens double, change binary"


@dataclass
class Tokens:
    hashes: np.ndarray  # words and an end after each text
    classes: np.ndarray
    first: np.ndarray  # per text, and one more

    def features(self) -> np.ndarray:
        """Three rows of the weight table per token, within their third of it."""
        starts = self.first[:-1]
        one, two = np.roll(self.hashes, 1), np.roll(self.hashes, 2)
        one[starts] = two[starts] = START
        second = starts + 1
        two[second[second < self.first[1:]]] = START
        shift = np.uint64(64 - FEATURE_BITS)
        return np.stack([W.mixed(one + np.uint64(11)) >> shift, W.mixed(one * np.uint64(0x9E3779B97F4A7C15) + two) >> shift,
                         W.mixed(two + np.uint64(13)) >> shift]).astype(np.uint16)


def tokens(texts: list[str], own: np.ndarray) -> Tokens:
    """``own``: the hashes of the words that are classes, the most frequent first."""
    w = W.split(texts, lower=True)
    hashes = w.hashes()
    last = w.codes[w.ends - 1].astype(np.uint64)
    before = np.where(w.ends - w.starts > 1, w.codes[np.maximum(w.ends - 2, 0)], 0).astype(np.uint64)
    classes = (1 + OWN + W.mixed(before * np.uint64(0x200003) + last) % np.uint64(SUFFIXES)).astype(np.int64)
    for i, h in enumerate(own):
        classes[hashes == h] = 1 + i
    at = w.first[1:]
    return Tokens(np.insert(hashes, at, END), np.insert(classes, at, 0), w.first + np.arange(len(w.first)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to (hash, class by suffix, count) of their tokens, summed over about a partition."""
    held: list[tuple] = []
    size = 0

    def merged() -> tuple:
        hashes, classes, counts = (np.concatenate(x) for x in zip(*held))
        ids, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        return ids, classes[first], np.bincount(which, counts).astype(np.int64)

    def rows(ids: np.ndarray, classes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), pa.array(classes), pa.array(counts)], names=["hash", "class", "count"])

    none = np.empty(0, np.uint64)
    for batch in batches:
        for _, texts in W.slices(batch):
            t = tokens(texts, none)
            ids, first, counts = np.unique(t.hashes, return_index=True, return_counts=True)
            held.append((ids, t.classes[first], counts))
            size += len(ids)
            if size > 2_000_000:
                held = [merged()]
                size = len(held[0][0])
                if size > 1_000_000:
                    yield rows(*held[0])
                    held, size = [], 0
    if held:
        yield rows(*merged())


@dataclass
class Lookup:
    """Frequent words' numbers by hash, through a table of the first bits."""

    hashes: np.ndarray  # sorted
    bits: int = 18

    def __post_init__(self):
        edges = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.starts = np.append(np.searchsorted(self.hashes, edges), len(self.hashes)).astype(np.int32)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        out = np.full(len(wanted), -1, np.int32)
        if not len(self.hashes):
            return out
        high = (wanted >> np.uint64(64 - self.bits)).astype(np.int64)
        at, stop, left = self.starts[high], self.starts[high + 1], np.arange(len(wanted))
        while True:
            inside = at < stop
            at, stop, left = at[inside], stop[inside], left[inside]
            if not len(left):
                return out
            same = self.hashes[at] == wanted[left]
            out[left[same]] = at[same]
            at, stop, left = at[~same] + 1, stop[~same], left[~same]


@dataclass
class Model:
    n: int  # training tokens
    distinct: int
    own: np.ndarray
    lookup: Lookup
    counts: np.ndarray  # of the frequent words
    in_class: np.ndarray  # log10 chance of the frequent words in their class
    totals: list[float]  # per class: training tokens
    discounts: list[float]
    unknown: list[float]  # log10 chance of a class's unknown token
    weights: np.ndarray  # ROWS x CLASSES


def log_chances(weights: np.ndarray, features: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log chance of each token's class, chances of all classes) for a block."""
    third = 1 << FEATURE_BITS
    logits = weights[1 + features[0].astype(np.int32)]
    logits += weights[1 + third + features[1].astype(np.int32)]
    logits += weights[1 + 2 * third + features[2].astype(np.int32)]
    logits += weights[0]
    logits -= logits.max(axis=1, keepdims=True)
    chosen = logits[np.arange(len(classes)), classes].copy()
    np.exp(logits, out=logits)
    total = logits.sum(axis=1, keepdims=True)
    logits /= total
    return chosen - np.log(total[:, 0]), logits


def _trainer(sent, step: float):
    """A batch function: texts to the task's change of the weights, in parts of PART_ROWS rows."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, start = sent.value
        weights, seen, n = start.copy(), np.full(start.shape, 1.0, np.float32), 0
        for batch in batches:
            for _, texts in W.slices(batch):
                t = tokens(texts, own)
                features = t.features()
                for a in range(0, len(t.classes), BLOCK):
                    f, y = features[:, a:a + BLOCK], t.classes[a:a + BLOCK]
                    _, slope = log_chances(weights, f, y)
                    slope[np.arange(len(y)), y] -= 1
                    for i in range(3):
                        order = np.argsort(f[i], kind="stable")
                        ids = f[i][order]
                        first = np.flatnonzero(np.diff(ids, prepend=ids[0] ^ 1))
                        rows = 1 + (i << FEATURE_BITS) + ids[first].astype(np.int32)
                        change = np.add.reduceat(slope[order], first, axis=0)
                        total = seen[rows] + change * change
                        seen[rows] = total
                        weights[rows] -= step * change / np.sqrt(total)
                    change = slope.sum(axis=0)
                    seen[0] += change * change
                    weights[0] -= step * change / np.sqrt(seen[0])
                n += len(t.classes)
        if n:
            parts = range(0, ROWS, PART_ROWS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(parts)), pa.array([TaskContext.get().partitionId()] * len(parts)), pa.array([float(n)] * len(parts)),
                 pa.array([((weights - start)[p:p + PART_ROWS]).astype(np.float16).tobytes() for p in parts], pa.binary())],
                names=["part", "task", "tokens", "change"])

    return train


def _summed(group: pa.Table) -> pa.Table:
    """The token-weighted mean of a part's changes."""
    weights = group["tokens"].to_numpy()
    total = sum(w * np.frombuffer(c.as_py(), np.float16).astype(np.float64) for w, c in zip(weights, group["change"]))
    mean = (total / weights.sum()).astype(np.float16).tobytes()
    return pa.table({"part": group["part"][:1], "task": group["task"][:1], "tokens": [weights.sum()], "change": pa.array([mean], pa.binary())})


def averaged(changes: DataFrame, tasks: int) -> DataFrame:
    """One change per part, from those of ``tasks`` tasks, at most ``FAN_IN`` of them together in each step."""
    while True:
        changes = changes.withColumn("task", F.floor(F.col("task") / FAN_IN)).groupBy("part", "task").applyInArrow(_summed, CHANGES)
        tasks = -(-tasks // FAN_IN)
        if tasks <= 1:
            return changes


def counted(training: DataFrame, text: str = "text") -> DataFrame:
    """Per distinct token of the training rows: hash, class (by suffix; 0 for the end), count."""
    rows = training.select(filled(text).alias("text")).mapInArrow(_counted, "hash long, class long, count long")
    return saved(rows.groupBy("hash").agg(F.max("class").alias("class"), F.sum("count").alias("count")), "token-counts")


def train(training: DataFrame, counts: DataFrame, text: str = "text", rounds: int = 2, step: float = 0.15) -> Model:
    """Learn the model from the training rows and their counted tokens."""
    context = training.sparkSession.sparkContext
    # the counts' sizes in steps of a sixteenth of a doubling: the words from some step on are the frequent ones
    level = F.floor(F.log2("count") * 16)
    steps = sorted(((r["level"], r["n"]) for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    room, least = FREQUENT, None
    for at, n in steps:
        if n > room:
            break
        room, least = room - n, at
    frequent = counts.where(level >= least if least is not None else F.lit(False)).toArrow()  # at most FREQUENT rows
    hashes, classes, c = (frequent[x].to_numpy() for x in ("hash", "class", "count"))
    hashes = hashes.view(np.uint64)
    order = np.argsort(hashes)
    hashes, classes, c = hashes[order], classes[order].copy(), c[order]
    top = [i for i in np.lexsort((hashes, -c)) if hashes[i] != END][:OWN]
    own = hashes[top]
    classes[top] = 1 + np.arange(len(top))
    named = counts
    for i, h in enumerate(own.view(np.int64).tolist()):
        named = named.withColumn("class", F.when(F.col("hash") == h, 1 + i).otherwise(F.col("class")))
    stats = named.groupBy("class").agg(
        F.sum("count").alias("n"), F.count(F.lit(1)).alias("v"), F.count_if(F.col("count") == 1).alias("n1"), F.count_if(F.col("count") == 2).alias("n2")).collect()
    totals, discounts, unknown = np.zeros(CLASSES), np.zeros(CLASSES), np.zeros(CLASSES)
    for r in stats:
        k = r["class"]
        totals[k] = r["n"]
        if k > OWN:  # a class of one token has no unknown one
            discounts[k] = min(0.9, max(0.1, r["n1"] / max(1, r["n1"] + 2 * r["n2"])))
            unknown[k] = np.log10(discounts[k] * r["v"] / r["n"])
    n, distinct = int(totals.sum()), sum(r["v"] for r in stats)
    in_class = np.log10((c - discounts[classes]) / np.maximum(totals[classes], 1)) if len(c) else np.empty(0)
    weights = np.zeros((ROWS, CLASSES), np.float32)
    weights[0] = np.log((totals + 0.1) / (n + 0.1 * CLASSES))
    for turn in range(rounds if n else 0):
        sent = context.broadcast((own, weights))  # its size is fixed by the parameters
        part = training.where(F.pmod(F.xxhash64(filled(text)), F.lit(rounds)) == turn).select(filled(text).alias("text"))
        mean = averaged(part.mapInArrow(_trainer(sent, step), CHANGES), part.rdd.getNumPartitions()).toArrow()  # the weight table, once
        weights = weights.copy()
        for at, change in zip(mean["part"].to_pylist(), mean["change"]):
            rows = np.frombuffer(change.as_py(), np.float16).reshape(-1, CLASSES)
            weights[at:at + len(rows)] += rows
    return Model(n, distinct, own, Lookup(hashes), c, in_class, totals.tolist(), discounts.tolist(), unknown.tolist(), weights)


def _scorer(sent, keys: list[str]):
    """A batch function: texts to sums over their ends and frequent words, and what they hold of rarer ones."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = sent.value
        base_of = np.log10((m.counts + 0.1) / (m.n + 0.1 * (m.distinct + 1)))
        for batch in batches:
            for part, texts in W.slices(batch, "_text"):
                t = tokens(texts, m.own)
                features, logs = t.features(), np.empty(len(t.classes))
                for a in range(0, len(logs), BLOCK):
                    logs[a:a + BLOCK] = log_chances(m.weights, features[:, a:a + BLOCK], t.classes[a:a + BLOCK])[0]
                logs /= np.log(10)
                place = m.lookup(t.hashes)
                known = place >= 0
                base = np.zeros(len(logs))
                if len(m.counts):
                    logs += np.where(known, m.in_class[place], 0)
                    base = np.where(known, base_of[place], 0)
                starts = t.first[:-1]
                rest = np.flatnonzero(~known)
                owner = np.searchsorted(t.first, rest, side="right") - 1
                order = np.lexsort((t.hashes[rest], owner))
                rest, owner = rest[order], owner[order]
                new = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(t.hashes[rest], prepend=np.uint64(0)) != 0))
                times = np.diff(np.append(new, len(rest)))
                offsets = pa.array(np.searchsorted(owner[new], np.arange(len(texts) + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (t.hashes[rest][new].view(np.int64), t.classes[rest][new], times)]
                yield pa.RecordBatch.from_arrays(
                    [*map(part.column, keys), pa.array(np.diff(t.first)), pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                     pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(logs, starts)), *lists],
                    names=[*keys, "n_tokens", "known", "base", "logs", "hashes", "classes", "times"])

    return score


def score(docs: DataFrame, counts: DataFrame, model: Model, keys: tuple[str, ...], text: str = "text") -> DataFrame:
    """Columns ``keys``, n_tokens, n_known, train_tokens, base_score, score (log10) for every row."""
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), *keys, filled(text).alias("_text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.drop("_text").schema)
    sums = rows.mapInArrow(
        _scorer(spark.sparkContext.broadcast(model), ["_row", *keys]),
        f"{schema}, n_tokens long, known long, base double, logs double, hashes array<long>, classes array<long>, times array<long>")
    sums = saved(sums, "token-sums")
    rare = sums.select("_row", F.explode(F.arrays_zip("hashes", "classes", "times")).alias("t")).select("_row", "t.*")
    met = rare.join(counts.select(F.col("hash").alias("hashes"), "count"), "hashes", "left")
    c = F.coalesce("count", F.lit(0))

    def of_class(values: list[float]):
        return F.get(F.array(*map(F.lit, values)), F.col("classes"))

    base = F.log10((c + 0.1) / (model.n + 0.1 * (model.distinct + 1)))
    known = F.log10((c - of_class(model.discounts)) / of_class(model.totals))
    in_class = F.when(c > 0, known).otherwise(of_class(model.unknown))
    rest = met.select("_row", F.when(c > 0, F.col("times")).otherwise(0).alias("known"), (F.col("times") * base).alias("base"),
                      (F.col("times") * in_class).alias("logs"))
    rest = rest.groupBy("_row").agg(*(F.sum(x).alias(f"more_{x}") for x in ("known", "base", "logs")))

    def whole(x: str):
        return F.col(x) + F.coalesce(f"more_{x}", F.lit(0))

    return sums.join(rest, "_row", "left").select(
        *keys, "n_tokens", whole("known").alias("n_known"), F.lit(model.n).cast("long").alias("train_tokens"),
        whole("base").alias("base_score"), whole("logs").alias("score"))


@query("op4_lm_scoring")
def op4_lm_scoring(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", (remainder("doc_id", 10) == 0).alias("held_out"))
    training = docs.where("NOT held_out")
    counts = counted(training)
    return score(docs, counts, train(training, counts), ("doc_id", "held_out"))
