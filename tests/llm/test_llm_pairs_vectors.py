"""N-gram Jaccard join, hard negatives and part codes against brute force."""

import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import prose
from conftest_words import groups_of
from lakeloom.llm import hard_negatives as H, ngram_join as N, part_codes as C
from lakeloom.llm.common import table

SF = "/root/testdata/sf0.001"


def brute_set(text, size):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = tuple(re.findall(r"[^\x20\x09-\x0D]+", lower))
    return {w[i:i + size] for i in range(len(w) - size + 1)} if len(w) >= size else ({w} if w else set())


def brute_components(texts, size=4, part=85, of=100):
    sets = {i: brute_set(t, size) for i, t in texts.items()}
    shared, holders = defaultdict(int), defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            for j in holders[s]:
                shared[j, i] += 1
            holders[s].append(i)
    near = {(a, b) for (a, b), n in shared.items() if of * n >= part * (len(sets[a]) + len(sets[b]) - n)}
    group = groups_of(sorted(sets), lambda a, b: (a, b) in near)
    least = {}
    for i in sorted(sets):
        least.setdefault(group[i], i)
    return {(i, len(sets[i]), least[group[i]]) for i in sets}


def found(df):
    return {tuple(r) for r in df.collect()}


def test_given_documents_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    assert found(N.op11_ngram_jaccard(spark, SF)) == brute_components({r.doc_id: r.text for r in docs.collect()})


@pytest.mark.parametrize("size, part, of", [(4, 85, 100), (2, 1, 2), (3, 1, 1)])
def test_join_around_the_bound(spark, size, part, of):
    texts = {}
    for g in range(30):  # copies with words changed or cut, chains whose ends are unlike
        words = prose(g, 20 + 9 * g).split()
        for c in range(6):
            texts[len(texts)] = " ".join(words)
            if c % 2:
                words = words[: len(words) - 2]
            else:
                for at in range(3, len(words), max(1, len(words) // (1 + (g + c) % 4))):
                    words[at] = f"new{g}x{c}"
    base, r = prose(500, 150).split(), random.Random(1)
    for c in range(250):  # a large group in which some copies are close to the first only, and some to none
        words = list(base)
        for at in r.sample(range(150), c % 9):
            words[at] = f"w{c}x{at}"
        texts[2000 + c] = " ".join(words)
    for c in range(120):  # a passage that many share, below the bound
        texts[4000 + c] = " ".join(base[:60]) + " " + prose(9000 + c, 60)
    rows = list(texts.items())
    r.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(N.ngram_components(frame, size=size, part=part, of=of)) == brute_components(texts, size, part, of)


def test_join_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.n_shingles, r.component_id) for r in N.ngram_components(odd_docs).collect()]
    assert len(rows) == odd_docs.count()
    by_id = defaultdict(set)
    for i, n, c in rows:
        by_id[i].add((n, c))
    assert by_id[1] == by_id[2] == by_id[3] == {(57, 1)}
    assert by_id[4] == {(0, 4)} and by_id[5] == {(0, 5)} and by_id[6] == {(0, 6)}
    assert by_id[None] == {(0, None), (37, None)}
    assert {c for _, c in by_id[8]} == {7} and by_id[10] == {(1, 10)} and by_id[11] == {(1, 10)}
    assert N.ngram_components(no_docs).count() == 0


# -- hard negatives -----------------------------------------------------------


def brute_negatives(rows, is_anchor):
    """rows: (id, label, vector of ints); a place of their own tells rows of one id apart."""
    out = []
    order = lambda x: (-x[0], x[1])
    for place, (i, label, v) in enumerate(rows):
        if not is_anchor(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m) for at, (j, m, w) in enumerate(rows) if at != place]
        for score, p, _ in sorted((x for x in scored if x[2] == label), key=order)[:5]:
            fits = sorted((x for x in scored if x[2] != label and 50 * score <= 100 * x[0] <= 95 * score), key=order)[:3]
            out += [(i, p, k + 1, x[1], score, x[0]) for k, x in enumerate(fits)]
    return sorted(out)


def ints(v, scale):
    return [math.floor(scale * float(x)) for x in v]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_hard_negatives_against_brute_force(spark, block):
    r = np.random.default_rng(2)
    around = r.normal(size=(6, 8))
    data = []
    for i in range(400):
        v = (around[i % 6] + 0.3 * r.normal(size=8)) * r.uniform(0.2, 2)
        data.append((i, [float(x) for x in np.float32(v)], int(r.integers(3))))
    data += [(1000 + i, data[7][1], 1) for i in range(120)]  # one vector many times: ties by id
    data += [(2000, [0.0] * 8, 1), (2001, None, 1), (2002, [1.0, None, *[0.0] * 6], 1), (2003, [float("nan")] * 8, 1), (2004, [float("inf")] * 8, 1), (2005, data[3][1], None),
             (2006, [1.0] * 7, 0), (None, data[5][1], 1)]
    kept = [(i, m, ints(v, 256)) for i, v, m in data if usable(v) and m is not None and i is not None and len(v) == 8]
    frame = spark.createDataFrame([(*d, 1, 2.0) for d in data], "vec_id long, embedding array<float>, label int, score int, spot double").repartition(5)
    got = H.hard_negatives(frame, F.col("id") % 10 == 0, block=block)
    want = brute_negatives(sorted(kept, key=lambda x: x[0]), lambda i: i % 10 == 0)
    assert sorted(map(tuple, got.collect())) == want and want
    assert H.hard_negatives(frame.limit(0), F.col("id") % 10 == 0).count() == 0
    assert H.hard_negatives(frame, F.col("id") == -1).count() == 0


def test_repeated_rows_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (1, [0.8, 0.1], 1), (1, [0.8, 0.1], 1)]
    got = H.hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), F.col("id") == 0)
    one = (0, 0, 1, 1, 65536, 204 * 256)
    assert sorted(map(tuple, got.collect())) == sorted([one, one, (*one[:2], 2, *one[3:]), (*one[:2], 2, *one[3:])])


def test_a_walk_ends_before_its_list():
    r = np.random.default_rng(3)
    anchors = np.round(1000 * (np.array([1, 0, 0, 0]) + 0.01 * r.normal(size=(5, 4)))).astype(np.int64)
    items = np.round(1000 * r.normal(size=(5000, 4))).astype(np.int64)
    cluster = H.Cluster(np.arange(5), anchors, H.centres_of(anchors, 1)[0])
    best, scored = H.Best(5, 3), []

    def seen(members, columns, scores):
        scored.append(scores.size)
        best.offer(members, scores, np.ones(scores.shape, bool), columns, columns)

    cluster.walk(items, seen, lambda members: best.least[members])
    exact = anchors @ items.T
    assert all(sorted(exact[i])[-3:] == sorted(best.rows[best.rows[:, 0] == i, 1]) for i in range(5))
    assert sum(scored) < 5 * 5000 / 4


# -- part codes -----------------------------------------------------------------


def brute_codes(rows, parts, entries, rounds, scale=4096):
    """rows: (id, label, vector), in the order codebooks start from."""
    cut = [[ints(v, scale)[p * len(v) // parts:(p + 1) * len(v) // parts] for p in range(parts)] for _, _, v in rows]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            at = [near(c[p], book)[1] for c in cut]
            for e in range(len(book)):
                if own := [c[p] for c, i in zip(cut, at) if i == e]:
                    book[e] = [sum(col) // len(own) for col in zip(*own)]
    last = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    total = defaultdict(int)
    for (_, label, _), found_parts in zip(rows, last):
        total[label] += sum(d for d, _ in found_parts)
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted((i, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), total[m], digest) for (i, m, _), f in zip(rows, last))


@pytest.mark.parametrize("parts, entries, rounds", [(8, 16, 6), (2, 5, 3), (4, 40, 0)])
def test_part_codes_against_brute_force(spark, parts, entries, rounds):
    r = np.random.default_rng(4)
    data = [(int(i), [float(x) for x in np.round(r.normal(size=16), 2)], [0, 1, 2, None][int(i) % 4]) for i in r.permutation(120)]
    data += [(500 + i, data[9][1], 3) for i in range(60)] + [(3, data[1][1], 1)]
    odd = [(900, None, 1), (901, [None, *[0.0] * 15], 1), (902, [float("nan"), *[0.0] * 15], 1), (903, [float("-inf"), *[0.0] * 15], 1), (904, [1.0] * 8, 1)]
    frame = spark.createDataFrame([(*d, 1, "x") for d in data + odd], "vec_id long, embedding array<double>, label int, rows int, part string").repartition(6)
    want = brute_codes([(i, m, v) for i, v, m in sorted(data, key=lambda d: (d[0], ints(d[1], 4096)))], parts, entries, rounds)
    assert sorted(map(tuple, C.compressed(frame, parts=parts, entries=entries, rounds=rounds).collect())) == want


def test_part_codes_of_few_rows_and_of_none(spark):
    frame = spark.createDataFrame([(None, [0.5, 0.25], None), (2, [0.1, -0.2], None)], "vec_id long, embedding array<double>, label int")
    got = C.compressed(frame, parts=2).collect()
    assert {(r.vec_id, r.code, r.error, r.label_error) for r in got} == {(None, "0101", 0, 0), (2, "0000", 0, 0)}
    assert C.compressed(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        C.compressed(frame, parts=3)
    with pytest.raises(ArithmeticError):
        C.compressed(spark.createDataFrame([(1, [1e9, 0.0], 1)], frame.schema), parts=2)


def test_trie_gives_the_nearest_entry():
    r = np.random.default_rng(5)
    leaves = np.unique(r.integers(-3, 4, size=(500, 5)), axis=0)
    entries = r.integers(-3, 4, size=(7, 5))
    code, least = C.walked(leaves, entries)
    exact = ((leaves[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (code == exact.argmin(axis=1)).all() and (least == exact.min(axis=1)).all()
