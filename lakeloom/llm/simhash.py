"""SimHash near-duplicates through an inverted index over byte positions.

A fingerprint is eight bytes. Two that differ in at most two bits share at least
six bytes at their positions. The index lists fingerprints under every set of
that many positions with the bytes found there (28 entries for each distinct
fingerprint), so exactly the pairs that reach the guaranteed number of shared
positional bytes meet. Under an entry only two bytes are free, which bounds its
list at 65,536 fingerprints however the data lies. The count filter thus lies in the
keys: whatever meets in a list shares the guaranteed bytes already, and the tally
of a pair's bytes, taken again there, removes none. Pairs are
verified bit by bit, and the list gives a spanning forest of its links, not all
of its pairs. Lists of one fingerprint are dropped before Python sees them.

Rows with one fingerprint form one class; links hold between classes, and
components come from star contraction in the shared folder.

Defined results: a null text is empty; a text without words has fingerprint
zero, which links like any other; the component id is the smallest key
reachable, nulls apart; repeated rows are rows of one class; an empty table gives
an empty result. Extra columns are not read. Whole texts are used.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from lakeloom.llm.common import WORD, ascii_lower, fields, filled, located, query, saved, table, whole
from lakeloom.llm.components import components

BYTES = 8
_words = re.compile(WORD).findall


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of a text that is in lower case already."""
    import xxhash

    words = _words(text)
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(" ".join(words), seed)
    digest = xxhash.xxh64_digest
    ones, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for start in range(0, n, 16384):  # bounded working memory, whatever the text's length
        part = words[start:start + 16384 + shingle - 1]
        hashes = b"".join([digest(s, seed) for s in map(" ".join, zip(*(part[i:] for i in range(shingle))))])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, BYTES), axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(text: Column, shingle: int) -> Column:
    """Fingerprints, their 64 bits read as a signed number."""

    @F.pandas_udf(LongType())
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return prints(text)


def index_entries(prints: DataFrame, bits: int) -> DataFrame:
    """(entry, fp) for every set of positions that a qualifying pair must share."""
    kept = max(BYTES - bits, 0)

    def entry(i: int, positions: tuple[int, ...]):
        mask = sum(0xFF << (8 * p) for p in positions)
        mask -= (1 << 64) if mask >> 63 else 0
        return F.struct(F.lit(i).alias("set"), F.col("fp").bitwiseAND(F.lit(mask)).alias("bytes"))

    sets = [entry(i, c) for i, c in enumerate(combinations(range(BYTES), kept))]
    return prints.select("fp", F.explode(F.array(*sets)).alias("entry")).select("entry.*", "fp")


def _forest(members: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest over the members of one list (distinct, at most 65,536)."""
    parent = np.arange(len(members))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    found = []
    by_byte = members.view(np.uint8).reshape(-1, BYTES)
    for i in range(len(members) - 1):
        shared = (by_byte[i + 1:] == by_byte[i]).sum(axis=1)
        near = np.flatnonzero(shared >= BYTES - bits) + i + 1
        near = near[np.bitwise_count(members[near] ^ members[i]) <= bits]
        for j in near:
            a, b = root(i), root(int(j))
            if a != b:
                parent[b] = a
                found.append((i, int(j)))
    return found


def linked(bits: int):
    """A batch function: lists of fingerprints to links (a, b) that hold."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("members")
            values, offsets = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), lists.offsets.to_numpy()
            offsets = offsets - offsets[0]
            pairs = [offsets[k] + np.array(f) for k in range(len(lists)) if (f := _forest(values[offsets[k]:offsets[k + 1]], bits))]
            ends = np.concatenate(pairs) if pairs else np.empty((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(values[ends[:, i]].view(np.int64)) for i in (0, 1)], names=["a", "b"])

    return link


def fingerprint_links(prints: DataFrame, bits: int = 2) -> DataFrame:
    """Links between distinct fingerprints ``fp`` that differ in at most ``bits`` bits, enough for all components."""
    lists = index_entries(prints, bits).groupBy("set", "bytes").agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1)
    return lists.select("members").mapInArrow(linked(bits), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = 2, shingle: int = 3) -> DataFrame:
    """Per row of ``docs``: key, ``fingerprint``, ``component_id`` and its place."""
    rows = saved(located(docs.select(key, text)).select("_path", "_row", key, fingerprints(ascii_lower(filled(text)), shingle).alias("fp")), "prints")
    classes = saved(rows.groupBy("fp").agg(F.min(key).alias("first")), "classes")
    roots = components(fingerprint_links(classes.select("fp"), bits))
    member = classes.join(roots, classes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = saved(member.join(least, "root").select("fp", "component_id"), "components")
    return rows.join(named, "fp").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "_path", "_row")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = 2) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest key, all columns as they came."""
    rows = whole(docs)
    found = saved(near_duplicates(fields(rows, key, text), key, text, bits), "found")
    order = F.struct(F.col(key).isNull().alias("no_id"), F.col(key), "_path", "_row")
    stays = saved(found.groupBy("component_id").agg(F.min(order).alias("first")).select("first._path", "first._row"), "stays")
    return rows.join(stays.hint("shuffle_hash"), ["_path", "_row"], "left_semi").select("_all.*")


@query("op5_simhash_dedup")
def op5_simhash_dedup(spark, sf):
    return near_duplicates(table(spark, sf, "documents")).drop("_path", "_row")
