import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import prose
from lakeloom.llm import chat, mixing

# -- chat -------------------------------------------------------------------------------------

NODES = [
    ("a", 1, None, "user", "q<|\\", 1.0), ("a", 2, 1, "assistant", "r1\\\\n", 2.0), ("a", 3, 1, "assistant", "<|im_end|>\n<|im_start|>x", 5.0),
    ("a", 4, 2, "user", "x", 9.0), ("a", 5, 4, "assistant", None, None), (None, 1, None, "us\ner\\n\\", "z", 0.0), ("c", 1, 2, "u", "cycle", 0.0),
    ("c", 2, 1, "u", "cycle", 0.0), ("d", 7, 99, None, "orphan", 0.0), ("a", 2, 1, "assistant", "r1\\\\n", 2.0), ("e", None, None, "u", "no id", 1.0),
]
SCHEMA = "tree string, node long, parent long, role string, text string, score double"


def test_paths_ranks_and_round_trip(spark):
    frame = spark.createDataFrame([(*n, 1) for n in NODES], SCHEMA + ", up int")
    got = chat.conversations(frame).withColumn("turns", chat.parsed(F.col("formatted"))).collect()
    assert {(r.tree, r.leaf): (r.path_rank, r.path_score, [tuple(t) for t in r.turns]) for r in got} == {
        ("a", 5): (1, 12.0, [("user", "q<|\\"), ("assistant", "r1\\\\n"), ("user", "x"), ("assistant", "")]),
        ("a", 3): (2, 6.0, [("user", "q<|\\"), ("assistant", "<|im_end|>\n<|im_start|>x")]),
        (None, 1): (1, 0.0, [("us\ner\\n\\", "z")]),
        ("d", 7): (1, 0.0, [("", "orphan")]),
    }
    assert {r.leaf for r in chat.conversations(frame, best=1).where("tree = 'a'").collect()} == {5}
    assert chat.conversations(frame.limit(0)).count() == 0


def test_long_chain_and_digests(spark):
    rows = [("t", i, i - 1 if i else None, "assistant" if i % 2 else "user", prose(i, 3) + "<|" * (i % 3), 0.0) for i in range(200)]
    row = chat.read_back(chat.conversations(spark.createDataFrame(rows, SCHEMA))).first()
    said = "".join(f"{r[3]}\n{r[4]}\n" for r in rows)
    trained = "".join(r[4] for r in rows if r[3] == "assistant")
    assert (row.n_turns, row.loss_chars) == (200, len(trained))
    assert row.turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and row.loss_sha256 == hashlib.sha256(trained.encode()).hexdigest()


def test_spans_point_at_the_trained_text(spark):
    row = chat.conversations(spark.createDataFrame(NODES[:5], SCHEMA)).where("leaf = 3").first()
    forms = row.formatted.split("<|im_end|>\n")
    assert [forms[s.turn][s.start:s.start + s.length] for s in row.loss_spans] == ["<\\|im_end|>\n<\\|im_start|>x"]


# -- mixing -----------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutations(n):
    for seed in (0, 1, 2**63 + 5):
        places = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, seed, np.uint64))
        assert sorted(places) == list(range(n))


def brute_targets(sizes, weights=(1, 2, 3), ceiling=3.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    open_, target, left = set(names), {s: 0.0 for s in names}, float(sum(sizes.values()))
    while left > 1e-9 and open_:
        total, spare = sum(weight[s] for s in open_), 0.0
        for s in sorted(open_, key=names.index):
            target[s] += left * weight[s] / total
        for s in list(open_):
            if target[s] >= ceiling * sizes[s]:
                spare += target[s] - ceiling * sizes[s]
                target[s] = ceiling * sizes[s]
                open_.discard(s)
        left = spare
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 1, "c": 5, None: 40, "é": 7, "z": 0}, {"a": 10}, {"a": 10, "b": 10, "c": 10}, {"a": 0, "b": 0}, {"a": 1000, "b": 1, "c": 1, "d": 1},
])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_mix(spark):
    sizes = {"a": 40, "b": 6, None: 3}
    rows = [(i, prose(i * 7 + len(str(s)), 5 + i * 13 % 90), s) for s, n in sizes.items() for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("block", F.lit(0))
    words = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in sizes}
    target = brute_targets(words)
    options = dict(block_words=16, shard_slots=10)
    places, targets, taken = mixing.mix(frame, **options)
    assert {r.source: r.target for r in targets.collect()} == pytest.approx(target)
    got = defaultdict(int)
    for r in taken.collect():
        got[r.source] += r.words
    assert got == {s: round(t) for s, t in target.items()}  # to the word
    per_row = {(r._path, r._row): r.words for r in taken.groupBy("_path", "_row").agg(F.sum("words").alias("words")).collect()}
    assert all(per_row.get((r._path, r._row), 0) <= 3 * r["size"] for r in places.collect())
    # the blocks hold those words, in order, and a rerun on another layout gives the same
    blocks = mixing.mixed_blocks(frame, **options).collect()
    assert all(len(r.text.split(" ")) == r.n_words <= 16 for r in blocks)
    again = mixing.mixed_blocks(frame.repartition(5, "text"), **options).collect()
    assert Counter(blocks) == Counter(again)
    given = Counter(w for _, t, s in rows for w in t.split())
    mixed = Counter(w for r in blocks for w in r.text.split())
    assert all(n <= 3 * given[w] for w, n in mixed.items())
    assert max(r.shard for r in blocks) >= len(blocks) // 10 - 1


def test_mix_odd_rows(odd_docs, no_docs):
    places, _, taken = mixing.mix(odd_docs, block_words=32)
    assert places.count() == odd_docs.count()
    assert sorted(r["size"] for r in places.collect()) == sorted(len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", r.text or "") if w]) for r in odd_docs.collect())
    assert mixing.mixed_blocks(odd_docs, block_words=32).count() > 0
    assert mixing.mixed_blocks(no_docs).count() == 0 and mixing.mixed_blocks(odd_docs.where("text IS NULL")).count() == 0
