import re
from collections import defaultdict

from pyspark.sql import functions as F

import corpus_pipeline as P
from conftest import prose
from conftest_words import groups_of
from lakeloom.llm import near_copies, ngram_join
from lakeloom.llm.common import located, table

SF = "/root/testdata/sf0.01"


def brute_set(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = tuple(re.findall(r"[^\x20\x09-\x0D]+", lower))
    return {w[i:i + 5] for i in range(len(w) - 4)} if len(w) >= 5 else {w}


def brute_kept(texts, similarity=0.8):
    """Smallest id of each group; ``texts``: id to text. Only pairs that share a shingle can be similar."""
    sets = {i: brute_set(t) for i, t in texts.items()}
    shared, holders = defaultdict(int), defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            for j in holders[s]:
                shared[j, i] += 1
            holders[s].append(i)
    near = {p for p, n in shared.items() if n / (len(sets[p[0]]) + len(sets[p[1]]) - n) >= similarity}
    group = groups_of(sorted(sets), lambda a, b: (a, b) in near)
    least = {}
    for i in sorted(sets):
        least.setdefault(group[i], i)
    return set(least.values()), near


def test_stage_keeps_one_of_each_group_of_given_documents(spark):
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want, near = brute_kept(texts)
    assert any(brute_set(texts[a]) != brute_set(texts[b]) for a, b in near)
    kept = P.near_dedup(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_stage_against_brute_force_around_the_bound(spark):
    texts = {}
    for g in range(40):  # copies with 0 to 3 words changed, chains whose ends are unlike, words cut at an end
        words = prose(g, 60 + 5 * g).split()
        for c in range(6):
            texts[len(texts)] = " ".join(words)
            if c % 2:
                words = words[: len(words) - 4]
            else:
                for at in range(7, len(words), len(words) // (1 + (g + c) % 4)):
                    words[at] = f"new{g}x{c}"
    texts |= {1000: None, 1001: "", 1002: " \n", 1003: "one two", 1004: "ONE\ttwo", 1005: "two one"}
    base = prose(500, 200).split()
    for c in range(300):  # a large group, each copy one word apart
        texts[2000 + c] = " ".join([*base[:c % 200], f"w{c}", *base[c % 200 + 1:]])
    want, near = brute_kept(texts)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("node", F.lit(1))
    assert {r.doc_id for r in P.near_dedup(spark, frame, SF).collect()} == want
    assert P.near_dedup(spark, frame.limit(0), SF).count() == 0



def test_fingerprint_index_comes_first(spark, monkeypatch):
    base, texts = prose(900, 2000).split(), {}
    for c in range(40):  # one word of two thousand apart
        texts[c] = " ".join([*base[:40 * c], f"w{c}", *base[40 * c + 1:]])
    texts |= {100 + c: " ".join([f"v{c}", *base[:400 + c]]) for c in range(5)}
    want, _ = brute_kept(texts)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    counted = []

    def spy(pairs, *args):
        links = plain(pairs, *args)
        counted.append((pairs.count(), links.count()))
        return links

    plain = ngram_join.verified
    monkeypatch.setattr(ngram_join, "verified", spy)
    assert {r.doc_id for r in P.near_dedup(spark, frame, SF).collect()} == want
    (tried, held), (rest, _), _ = counted
    assert tried >= held > 20 and rest < 20  # what the index brought together isn't tried again


def test_a_class_is_no_link(spark, monkeypatch):
    texts = {1: prose(1, 80), 2: prose(2, 80), 3: prose(1, 80) + " end", 4: prose(2, 80) + " end"}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    monkeypatch.setattr(near_copies, "near_duplicates", lambda docs, *args: located(docs).withColumn("component_id", F.lit(1)))
    assert {r.doc_id for r in P.near_dedup(spark, frame, SF).collect()} == {1, 2}
