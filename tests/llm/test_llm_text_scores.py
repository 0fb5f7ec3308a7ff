import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import prose
from lakeloom.llm import language_model as lm, quality as q, token_counts as tc
from lakeloom.llm.quality import remainder

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


# -- language model ---------------------------------------------------------------------


def lm_rows(docs):
    docs = docs.select("doc_id", "text", (remainder("doc_id", 10) == 0).alias("held_out"))
    training = docs.where("NOT held_out")
    counts = lm.counted(training)
    return lm.score(docs, counts, lm.train(training, counts), ("doc_id", "held_out", "text")).collect()


@pytest.mark.parametrize("frequent", [1 << 18, 300])  # all words at hand, or most of them looked up by the join
def test_base_score_against_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    got = lm_rows(spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300"))
    counts = Counter()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        if not r.held_out:
            counts.update([*words(r.text), None])
    n, v = sum(counts.values()), len(counts)
    for r in got:
        ts = [*words(r.text), None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ts), sum(counts[t] > 0 for t in ts), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts), rel_tol=1e-9)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_model_chances_sum_to_one(spark):
    training = spark.createDataFrame([(i, prose(i, 50)) for i in range(20)], "doc_id long, text string")
    counts = lm.counted(training)
    model = lm.train(training, counts)
    vocabulary = sorted({w for i in range(20) for w in prose(i, 50).split()})
    history = "mu1 nu2"
    # P(w | history) for every known word and the end, from scores of texts one word longer
    texts = [(i, f"{history} {w}") for i, w in enumerate(vocabulary)]
    t = lm.tokens([x for _, x in texts], model.own)
    logs = lm.log_chances(model.weights, t.features(), t.classes)[0]
    place = model.lookup(t.hashes)
    assert (place >= 0).sum() >= len(texts) * 2  # the training words and ends are known
    third = t.first[:-1] + 2
    known = np.exp(logs[third]) * 10 ** model.in_class[place[third]]
    end = np.exp(lm.log_chances(model.weights, lm.tokens([history], model.own).features()[:, 2:], np.array([0]))[0])
    chances = lm.log_chances(model.weights, t.features()[:, [2]], t.classes[[2]])[1][0]
    unknown = sum(chances[k] * (10 ** model.unknown[k] if model.totals[k] else 1.0) for k in range(1 + lm.OWN, lm.CLASSES))
    unused = sum(chances[k] for k in range(1, 1 + lm.OWN) if not model.totals[k])
    assert math.isclose(known.sum() + end[0] + unknown + unused, 1, rel_tol=1e-4)


def test_lm_odd_rows(odd_docs, no_docs):
    got = lm_rows(odd_docs)
    assert len(got) == odd_docs.count()
    for r in got:
        assert r.n_tokens == len(words(r.text)) + 1 and math.isfinite(r.score) and r.score <= 1e-6 and math.isfinite(r.base_score)
    assert lm_rows(no_docs) == []
    assert all(math.isclose(r.base_score, 0, abs_tol=1e-12) and r.train_tokens == 0 for r in lm_rows(odd_docs.where("doc_id = 29")))


# -- quality ------------------------------------------------------------------------------


def test_quality_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = q.op6_quality_classifier(spark, SF)
    assert got.count() == 1000
    held = got.where("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert held[1] > 80 and held[0] > 0.97


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (7, 0), (10, 1), (99, 0), (None, 1), (3, None)], "doc_id long, quality int")
    model = q.train(odd_docs, labels)
    got = q.scores(odd_docs.select("doc_id", "text"), model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    kept = q.keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.where("doc_id = 1").count() == 1 and kept.where("doc_id = 7").count() == 0
    assert q.keep_good(no_docs, labels).count() == 0
    for none in (labels.limit(0), labels.where("doc_id = 10")):  # nothing or one label only to learn from
        assert q.keep_good(odd_docs, none).count() == odd_docs.count()


def test_quality_hears_of_repeated_words():
    (_, _), (pairs, at), _ = q.features(["la la la", "mu mu", "one two"])
    assert len(set(pairs[:at[2]].tolist())) == 1 and np.diff(at).tolist() == [2, 1, 1] and pairs[-1] != pairs[0]


# -- token counts ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = str(P.path("byte_bpe_50k.json"))
    return path, Tokenizer.from_file(path)


def test_pieces_are_counted_once_and_as_whole_texts(tokenizer):
    import random

    path, encoder = tokenizer
    r = random.Random(1)
    parts = ["a", "B", "é", "中", "1", "２", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "\u200b", "\x1c", "\x85", "'s", "'ll", "'", "<|endoftext|>", "!", "_", "😀", "e\u0301", "\r\n", " \n ", "\x00"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(40))) for _ in range(5000)] + ["word " * 5000]
    asked = []

    class Watched:
        def __getattr__(self, name):
            def call(texts, **options):
                asked.extend([texts] if isinstance(texts, str) else texts)
                return getattr(encoder, name)(texts, **options)
            return call

    assert tc.splits_at_spaces(path)
    count = tc.PieceCounts(Watched(), most=2000, beside=50)
    assert [n for i in range(0, len(texts), 500) for n in count(texts[i:i + 500])] == [len(e) for e in encoder.encode_batch_fast(texts, add_special_tokens=False)]
    assert sum(t.count("word") for t in asked) <= 2  # not 5,000 times


def test_token_counts_and_cache(spark, odd_docs, no_docs, tokenizer, tmp_path):
    path, encoder = tokenizer
    docs = odd_docs.unionByName(odd_docs.limit(1).withColumn("text", F.lit("a<|endoftext|>b  <|im_end|>")))
    cache = str(tmp_path / "cache")
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(encoder.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    for _ in range(2):
        got = tc.token_counts(docs, cache, path).collect()
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 512) for r in got)
        stored = spark.read.parquet(cache)  # the second run appended nothing
        assert stored.count() == stored.select("content_digest").distinct().count() == docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    # a stored count is used as it is; another tokenizer's isn't
    spark.read.parquet(cache).withColumn("n_tokens", F.lit(7).cast("long")).write.parquet(str(tmp_path / "sevens"))
    assert {r.n_tokens for r in tc.token_counts(docs, str(tmp_path / "sevens"), path).collect()} == {7}
    spark.read.parquet(cache).withColumn("tokenizer_digest", F.lit("other")).write.parquet(str(tmp_path / "other"))
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in tc.token_counts(docs, str(tmp_path / "other"), path).collect()) == want
    assert tc.token_counts(no_docs, cache, path).count() == 0


def test_equal_rows_are_encoded_once(spark, tokenizer, tmp_path):
    rows = [(1, "the same text")] * 50 + [(None, "no id")] * 30 + [(2, "another"), (3, "the same text"), (1, None), (1, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    cache = str(tmp_path / "cache")
    assert tc.token_counts(frame, cache, tokenizer[0] if isinstance(tokenizer, tuple) else str(tokenizer)).count() == len(rows)
    assert spark.read.parquet(cache).count() == 4
