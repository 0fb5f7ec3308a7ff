"""Token counts through a cache keyed by content and tokenizer.

The cache is a parquet folder of (content_digest, tokenizer_digest, n_tokens).
Content is the text's UTF-8 bytes (null: empty): a byte-level vocabulary has no
normalisation, and any other would change counts. A run looks up the distinct
digests, encodes one row for each that is missing, and appends those counts.

Two runs at once may append a digest twice, so the lookup takes distinct rows.
Empty text has zero tokens; an empty table gives an empty result; rows that
repeat a key are counted each; extra columns are not read. Texts are encoded
whole, in groups of a bounded number of bytes (a longer text is its own group).
Where the tokenizer cuts at spaces anyway (``splits_at_spaces``), the library is
given each piece between such cuts once, and a text's count is the sum of its pieces'.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeloom.llm.common import filled, located, query, saved, table
from lakeloom.session import scratch_dir

CACHE = "content_digest binary, tokenizer_digest string, n_tokens long"
#: Characters that are no white space under any reading; a text is cut between one and a space or line feed.
_VISIBLE = r"[!-~\u00a1-\u1600\u3001-\ud7ff]"
_pieces = re.compile(rf"(?<={_VISIBLE})(?=[ \n])").split
_inner = re.compile(rf"[ \n].*{_VISIBLE}", re.DOTALL).fullmatch


def tokenizer_digest(path: str) -> str:
    """Names a tokenizer's version: the digest of its file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _groups(texts: list[str], chars: int) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > chars:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def splits_at_spaces(path: str) -> bool:
    """Whether a tokenizer file cuts every text before a space or line feed that follows a visible character.

    A byte-level one without normaliser does: its pattern takes white space with what follows it, or with
    other white space. Added tokens must hold no white space and take none in around them.
    """
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    cut = file.get("pre_tokenizer") or {}
    plain = not file.get("normalizer") and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    return plain and not any(
        t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in file.get("added_tokens") or [])


class PieceCounts:
    """Counts of texts as sums over their pieces, each met piece counted by the library once (``most`` are kept).

    Pieces between two cuts are given to the library side by side, as they could stand in a text, and told apart by
    the offsets of their tokens; others one by one.
    """

    def __init__(self, tokenizer, most: int = 1_000_000, longest: int = 64, beside: int = 2000):
        self.tokenizer, self.most, self.longest, self.beside, self.known = tokenizer, most, longest, beside, {}

    def _counted(self, pieces: list[str]) -> Iterator[tuple[str, int]]:
        inner, outer = [], []
        for p in pieces:
            (inner if _inner(p) else outer).append(p)
        yield from zip(outer, map(len, self.tokenizer.encode_batch_fast(outer, add_special_tokens=False)))
        for i in range(0, len(inner), self.beside):
            row = inner[i:i + self.beside]
            ends = np.cumsum([len(p) for p in row])
            begins = np.array([begin for begin, _ in self.tokenizer.encode("".join(row), add_special_tokens=False).offsets])
            yield from zip(row, np.bincount(np.searchsorted(ends, begins, side="right"), minlength=len(row)).tolist())

    def __call__(self, texts: list[str]) -> list[int]:
        parts = [_pieces(t) for t in texts]
        met = dict(self._counted(list({p for part in parts for p in part if p not in self.known})))
        counts = [sum(self.known[p] if p in self.known else met[p] for p in part) for part in parts]
        if len(self.known) + len(met) > self.most:
            self.known.clear()
        self.known.update((p, n) for p, n in met.items() if len(p) <= self.longest)
        return counts


@cache
def _piece_counts(path: str, digest: str) -> PieceCounts:
    """Kept by a Python worker from task to task."""
    return PieceCounts(_loaded(path))


def _loaded(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def encoder(path: str, digest: str, group_chars: int):
    """A batch function: (content_digest, text) to rows of the cache."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if splits_at_spaces(path):
            count = _piece_counts(path, digest)
        else:
            tokenizer = _loaded(path)

            def count(texts: list[str]) -> list[int]:
                return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts = [n for a, b in _groups(texts, group_chars) for n in count(texts[a:b])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("content_digest"), pa.array([digest] * len(counts), pa.string()), pa.array(counts, pa.int64())],
                names=["content_digest", "tokenizer_digest", "n_tokens"])

    return encode


def token_counts(docs: DataFrame, cache: str, tokenizer: str, limit: int = 512, key: str = "doc_id", text: str = "text",
                 group_chars: int = 200_000) -> DataFrame:
    """Per row of ``docs``: key, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    ``cache`` is a folder executors share; it is made if it isn't there.
    ``tokenizer`` is the path of a tokenizer file, the same on every machine.
    """
    spark = docs.sparkSession
    digest = tokenizer_digest(tokenizer)
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)
    # a row's place as a number: rows that repeat a key and a text are told apart
    placed = located(docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))).withColumn("_spot", F.xxhash64("_path", "_row"))
    content = F.unhex(F.sha2(filled("_text"), 256)).alias("content_digest")
    rows = saved(placed.select("_key", content, F.octet_length(filled("_text")).cast("long").alias("n_bytes"), "_spot"), "contents")

    def stored() -> DataFrame:
        return spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer_digest") == digest).groupBy("content_digest").agg(
            F.max("n_tokens").alias("n_tokens"))

    # one row stands for each missing digest; the text itself moves once and is not sorted
    stand_ins = saved(
        rows.groupBy("content_digest").agg(F.min("_spot").alias("stand_in")).join(stored(), "content_digest", "left_anti"), "misses")
    if not stand_ins.isEmpty():
        wanted = placed.select(content, F.col("_spot").alias("stand_in"), filled("_text").alias("text"))
        missing = wanted.join(
            stand_ins.select(F.col("content_digest").alias("d"), F.col("stand_in").alias("s")).hint("shuffle_hash"),
            (F.col("content_digest") == F.col("d")) & (F.col("stand_in") == F.col("s")), "left_semi")
        missing.select("content_digest", "text").mapInArrow(encoder(tokenizer, digest, group_chars), CACHE).write.mode("append").parquet(cache)
    counted = rows.join(saved(stored(), "counts"), "content_digest")
    return counted.select(F.col("_key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


@query("op10_token_counts")
def op10_token_counts(spark, sf):
    import public_tokenizers

    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts(table(spark, sf, "documents"), scratch_dir(spark, "token-cache"), path)
