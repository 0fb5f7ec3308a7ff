"""Similarity join of texts by the Jaccard similarity of their word n-grams, exact at any bound.

A text is the set of the hashes (64 bits) of every ``size`` words in a row, A-Z in
lower case; fewer words make one shingle of them all, no words the empty set. Texts
with one set are one node. Two nodes link when ``of * shared >= part * all``. The
answer is exact but for two shingles, or two sets, that get one hash.

Every filter follows from the bound, so none loses a link:

* **Sampled prefixes** (``possible``). Under any total order, the first common shingles
  of a qualifying pair lie in both prefixes. Under the order of hashes this needs no
  counts: a node whose prefix shares too few keys with other nodes has no partner and
  goes, before any set is counted as a whole.
* **Rare-first prefixes** (``prefixes``). Shingles are ordered by the number of nodes
  that hold them, rarest first. One that no other node holds can't be shared, so it
  shortens the prefix and isn't indexed; a node with too many of these goes.
* **Length, positional and suffix filters** (``_may_link``), as the condition of the
  join on prefix shingles: sizes within the bound; enough shingles left from the
  matched position on; and a lower bound of what the sets don't share, from the
  parities of 256 hash classes. A node meets those of its own size class and the next.

Each pair is then verified once on the sets, with a node of many partners dealt out.
A group of near copies costs its size and not its pairs: first the nodes of a list are
compared with the one that has the fewest shingles of its own, which most copies are
closest to; then only nodes that were linked with different ones meet. Groups that
another index has found (``classes``) go first: their nodes are compared with one of
them, and those it links aren't compared with one another.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.llm import words as W
from lakeloom.llm.common import query, saved, table, whole
from lakeloom.llm.components import components
from lakeloom.operators.joins import placed_anew

SLOTS, CLASSES = 64, 256
#: One of so many shingles of a set prolongs its sampled prefix.
SAMPLED = 32
_SIGNS = [f"s{i}" for i in range(CLASSES // 64)]
_POWERS = np.random.default_rng(5).integers(1 << 63, size=16, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Per text: the sorted distinct hashes of its shingles; empty without words."""
    w = W.split(texts, lower=True)
    hashes = w.hashes()
    padded = np.concatenate([hashes, np.zeros(size - 1, np.uint64)])
    rolled = np.zeros(len(hashes), np.uint64)
    for j in range(size):
        rolled += padded[j:j + len(hashes)] * _POWERS[j]
    rolled = W.mixed(rolled)
    sets = []
    for a, b in zip(w.first[:-1], w.first[1:]):
        if b - a >= size:
            sets.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:
            short = np.append(hashes[a:b] * _POWERS[:b - a], np.uint64(b - a))
            sets.append(W.mixed(short.sum(dtype=np.uint64, keepdims=True)))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(arrays).view(np.int64)))


def _needed(n: int, part: int, of: int) -> int:
    """What a set of ``n`` shares at least with any partner."""
    return -(-part * n // of)


def _sketched(size: int, part: int, of: int):
    """A batch function: rows with a text to their node, its size and the sampled prefix of its set."""

    def prefix(s: np.ndarray) -> np.ndarray:
        return s[:len(s) - _needed(len(s), part, of) + max(1, len(s) // SAMPLED)]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for rows, texts in W.slices(batch, "_text"):
                sets = shingle_sets(texts, size)
                nodes = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in ("_path", "_row", "_key")), pa.array(nodes), pa.array([len(s) for s in sets], pa.int32()), _lists([prefix(s) for s in sets])],
                    names=["_path", "_row", "_key", "node", "n", "sample"])

    return sketch


def _whole_sets(size: int):
    """A batch function: node and text to node, size, set, and the parities of its hash classes."""

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in W.slices(batch, "_text"):
                sets = shingle_sets(texts, size)
                odd = np.array([np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=CLASSES) & 1 for s in sets], np.uint8)
                signs = np.packbits(odd, axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("node"), pa.array([len(s) for s in sets], pa.int32()), *(pa.array(np.ascontiguousarray(signs[:, i])) for i in range(len(_SIGNS))), _lists(sets)],
                    names=["node", "n", *_SIGNS, "shingles"])

    return sets_of


def possible(prints: DataFrame, part: int, of: int) -> DataFrame:
    """The nodes whose sampled prefixes share enough keys with those of other nodes."""
    entries = prints.select("node", "n", F.explode("sample").alias("shingle"))
    shared = entries.groupBy("shingle").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most")
    # a partner holds `needed` shingles at least, so its prefix is prolonged by so many
    needed = F.expr(f"({part}L * n + {of - 1}) div {of}")
    met = entries.join(placed_anew(shared.select("shingle"), ["shingle"]), "shingle", "left_semi")
    return met.groupBy("node", "n").agg(F.count_distinct("shingle").alias("met")).where(F.col("met") >= F.greatest(F.lit(1), F.floor(needed / SAMPLED))).select("node")


def prefixes(sets: DataFrame, part: int, of: int) -> DataFrame:
    """Index entries: shingle, node, n, ``left`` (shingles others hold too from this one on), ``alone`` (those none holds), signs, size class."""
    entries = sets.select("node", F.explode("shingles").alias("shingle"))
    held = entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("nodes")).where("nodes > 1")
    ordered = entries.join(placed_anew(held, ["shingle"]), "shingle").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("nodes", "shingle"))).alias("all"))
    sized = ordered.join(sets.select("node", "n", *_SIGNS), "node").withColumn("longest", F.expr(f"size(all) - cast(({part}L * n + {of - 1}) div {of} as int) + 1")).where("longest > 0")
    taken = sized.select("node", "n", *_SIGNS, F.size("all").alias("m"), F.posexplode(F.slice("all", F.lit(1), F.col("longest"))).alias("at", "one"))
    # a little wider than the bound, so that rounding can't part two sizes by two classes
    step = math.log(1 / max(part / of - 0.01, 0.01))
    return taken.select(
        F.col("one.shingle").alias("shingle"), "node", "n", (F.col("m") - F.col("at")).alias("left"), (F.col("n") - F.col("m")).alias("alone"),
        *_SIGNS, F.floor(F.log("n") / step).cast("int").alias("size_class"))


def _may_link(a: str, b: str, part: int, of: int) -> Column:
    """Length, positional and suffix filter on two entries of one shingle."""
    def col(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}").cast("long")

    both = col(a, "n") + col(b, "n")
    unlike = reduce(Column.__add__, (F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in _SIGNS))
    return (
        (of * F.least(col(a, "n"), col(b, "n")) >= part * F.greatest(col(a, "n"), col(b, "n")))
        & ((of + part) * F.least(col(a, "left"), col(b, "left")) >= part * both)
        & ((of + part) * unlike.cast("long") <= (of - part) * both))


def verified(pairs: DataFrame, sets: DataFrame, part: int, of: int) -> DataFrame:
    """The pairs (a, b) that link, all columns kept. A node with many partners is dealt out over ``SLOTS`` copies of its set."""
    columns = pairs.columns
    pairs = pairs.withColumn("slot", F.pmod(F.xxhash64("b"), F.lit(SLOTS)))
    heads = pairs.select("a", "slot").distinct().join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("ours")), "a")
    both = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("theirs")), "b").join(placed_anew(heads, ["a", "slot"]), ["a", "slot"])
    shared = F.size(F.array_intersect("ours", "theirs")).cast("long")
    return both.where(of * shared >= part * (F.size("ours") + F.size("theirs") - shared)).select(*columns)


def rooted(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` with the root of each node's component."""
    roots = components(links).withColumnRenamed("node", "linked")
    return nodes.join(roots, F.col("node") == F.col("linked"), "left").select(*nodes.columns, F.coalesce("root", "node").alias("root"))


def confirmed(classes: DataFrame, index: DataFrame, sets: DataFrame, part: int, of: int) -> DataFrame:
    """Links (a, b, ``alone`` of a) that hold between the nodes of a class (node, class) and the one with the fewest shingles of its own.

    A node that isn't in the index has no partner.
    """
    members = classes.join(index.select("node", "alone").distinct(), "node")
    centres = members.groupBy("class").agg(F.min(F.struct("alone", "node")).alias("c"))
    pairs = members.select("node", "class").join(placed_anew(centres, ["class"]), "class").where("node <> c.node")
    pairs = pairs.select(F.col("c.node").alias("a"), F.col("node").alias("b"), F.col("c.alone").alias("alone")).distinct()
    return saved(verified(pairs, sets, part, of), "confirmed")


def _centres(links: DataFrame) -> DataFrame:
    """Per linked node the best centre it is linked with."""
    return links.groupBy("b").agg(F.min(F.struct("alone", "a")).alias("best")).select(F.col("b").alias("node"), F.col("best.a").alias("centre"))


def _apart(pairs: DataFrame, named: DataFrame) -> DataFrame:
    """The pairs (a, b) whose nodes don't go by one centre."""
    columns = pairs.columns
    for end in ("a", "b"):
        pairs = pairs.join(named.select(F.col("node").alias(end), F.col("centre").alias(f"{end}_centre")), end, "left")
    return pairs.where("coalesce(a_centre, a) <> coalesce(b_centre, b)").select(*columns)


def links_of(index: DataFrame, sets: DataFrame, part: int, of: int, known: DataFrame | None = None) -> DataFrame:
    """Links (a, b) between nodes, enough for all components. ``index``: what ``prefixes`` gives, saved; ``known``: what ``confirmed`` gives."""
    entry = F.struct("alone", "node", "n", "left", *_SIGNS)
    centres = index.groupBy("shingle", "size_class").agg(F.min(entry).alias("c")).select("shingle", "size_class", "c.*")
    met = index.alias("b").join(
        placed_anew(centres, ["shingle", "size_class"]).alias("a"),
        (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.size_class") == F.col("b.size_class")) & (F.col("a.node") != F.col("b.node")) & _may_link("a", "b", part, of))
    first = met.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), F.col("a.alone").alias("alone")).distinct()
    first = saved(first if known is None else _apart(first, _centres(known)), "pairs")
    links = saved(verified(first, sets, part, of), "similar")
    if known is not None:
        first, links = first.unionByName(known), links.unionByName(known)

    # a node goes by the best centre it is linked with; parts of one component that go by two names only meet again
    parted = index.join(placed_anew(_centres(links), ["node"]), "node", "left").withColumn("name", F.coalesce("centre", "node")).drop("centre")
    torn = parted.groupBy("shingle").agg(F.min("name").alias("least"), F.max("name").alias("most")).where("least <> most").select("shingle")
    parted = saved(parted.join(placed_anew(torn, ["shingle"]), "shingle", "left_semi"), "parted")
    larger = parted.withColumn("size_class", F.explode(F.array(F.col("size_class"), F.col("size_class") - 1)))
    met = parted.alias("a").join(
        larger.alias("b"),
        (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.size_class") == F.col("b.size_class")) & (F.col("a.name") != F.col("b.name"))
        & (F.struct("a.n", "a.node") < F.struct("b.n", "b.node")) & _may_link("a", "b", part, of))
    # pairs keep the order of centres: the node with fewer shingles of its own first
    ahead = F.struct("a.alone", "a.node") < F.struct("b.alone", "b.node")
    pairs = met.select(F.when(ahead, F.col("a.node")).otherwise(F.col("b.node")).alias("a"), F.when(ahead, F.col("b.node")).otherwise(F.col("a.node")).alias("b")).distinct()
    pairs = saved(pairs.join(first, ["a", "b"], "left_anti"), "pairs")
    return saved(links.select("a", "b").unionByName(verified(pairs, sets, part, of)), "similar")


def similar_rows(rows: DataFrame, key: str, text: str, size: int, part: int, of: int, classes: DataFrame | None = None) -> DataFrame:
    """Per row that ``whole`` gave: place, ``_key``, ``n`` (size of its set), ``node`` and ``root``, the same for all rows of one component.

    Rows without words share the node of the empty set. ``classes`` (place, ``class``): groups of rows another
    index has found; what holds of them is taken, what they lack is found all the same.
    """
    texts = rows.select("_path", "_row", F.col(f"_all.`{key}`").alias("_key"), F.col(f"_all.`{text}`").alias("_text"))
    kind = texts.schema["_key"].dataType.simpleString()
    prints = saved(texts.mapInArrow(_sketched(size, part, of), f"_path string, _row long, _key {kind}, node long, n int, sample array<long>"), "sketches")
    places = prints.join(possible(prints, part, of), "node", "left_semi").groupBy("node").agg(F.min(F.struct("_path", "_row")).alias("at"))
    places = saved(places.select("node", "at._path", "at._row"), "places")
    held = rows.select("_path", "_row", F.col(f"_all.`{text}`").alias("_text")).join(places.hint("shuffle_hash"), ["_path", "_row"])
    signs = ", ".join(f"{s} long" for s in _SIGNS)
    sets = saved(held.select("node", "_text").mapInArrow(_whole_sets(size), f"node long, n int, {signs}, shingles array<long>"), "sets")
    index = saved(prefixes(sets, part, of), "prefixes")
    known = None
    if classes is not None:
        known = confirmed(prints.select("_path", "_row", "node").join(classes, ["_path", "_row"]).select("node", "class").distinct(), index, sets, part, of)
    return rooted(prints.select("_path", "_row", "_key", "node", "n"), links_of(index, sets, part, of, known))


def ngram_components(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, part: int = 85, of: int = 100) -> DataFrame:
    """Per row of ``docs``: its key, ``n_shingles`` and ``component_id``, the smallest key reachable by links.

    Texts link when ``of * shared >= part * all`` over their sets of ``size``-word shingles.
    Defined results: a null text is empty; a text without words has no shingles and is
    linked with nothing, so its component is its own key; rows that repeat a key or a text
    give a row each; a null key is never a component's name unless the component has no
    other; an empty table gives an empty result. Columns may have any name.
    """
    found = saved(similar_rows(whole(docs), key, text, size, part, of), "found")
    least = found.where("n > 0").groupBy("root").agg(F.min("_key").alias("component_id"))
    return found.join(placed_anew(least, ["root"]), "root", "left").select(
        F.col("_key").alias(key), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_key")).alias("component_id"))


@query("op11_ngram_jaccard")
def op11_ngram_jaccard(spark, sf):
    return ngram_components(table(spark, sf, "documents"))
