import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from conftest_words import groups_of
from lakeloom.llm.components import components
from lakeloom.llm.exact_dedup import drop_copies, exact_groups
from lakeloom.llm.simhash import fingerprint_links, keep_one, near_duplicates

SPACE = re.compile(r"[\x20\x09-\x0D]+")


@pytest.mark.parametrize("digest_chars", [64, 1])  # one hex digit: every digest is met by unlike texts
def test_exact_groups(odd_docs, digest_chars):
    given = odd_docs.select("doc_id", "text").collect()
    groups = {}
    for r in given:
        groups.setdefault(SPACE.sub(" ", r.text or ""), []).append(r.doc_id)
    got = exact_groups(odd_docs, digest_chars=digest_chars).collect()
    assert len(got) == len(given)
    sizes = sorted((r.group_size, -1 if r.keep_id is None else r.keep_id) for r in got if r.kept)
    want = sorted((len(ids), min((i for i in ids if i is not None), default=-1)) for ids in groups.values())
    assert sizes == want  # one row of each group stays, the one with the smallest id


def test_drop_copies_keeps_columns_and_one_row(odd_docs, no_docs):
    kept = drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [SPACE.sub(" ", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({SPACE.sub(" ", r.text or "") for r in odd_docs.collect()})
    assert drop_copies(no_docs).count() == 0 and exact_groups(no_docs).count() == 0


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_against_brute_force(odd_docs, no_docs):
    given = [(r.doc_id, brute_fingerprint(r.text)) for r in odd_docs.collect()]
    got = near_duplicates(odd_docs).collect()
    assert sorted((r.doc_id or -1, r.fingerprint) for r in got) == sorted((i or -1, f"{f:016x}") for i, f in given)
    prints = sorted({f for _, f in given})
    want = groups_of(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {f: min((i for i, g in given if want[g] == want[f] and i is not None), default=None) for f in prints}
    assert all(r.component_id == least[int(r.fingerprint, 16)] for r in got)
    kept = keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == len(set(want.values()))
    assert near_duplicates(no_docs).count() == 0 and keep_one(no_docs).count() == 0


@pytest.mark.parametrize("bits", [0, 2, 3])
def test_links_reach_all_that_brute_force_reaches(spark, bits):
    r = random.Random(bits)
    prints = {r.getrandbits(64) for _ in range(60)}
    for p in list(prints)[:40]:  # chains, balls, and pairs just too far apart
        for _ in range(6):
            prints.add(p := p ^ sum(1 << b for b in r.sample(range(64), r.randint(1, bits + 1))))
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    found = {r.node & (1 << 64) - 1: r.root for r in components(fingerprint_links(frame, bits)).collect()}
    want = groups_of(sorted(prints), lambda a, b: (a ^ b).bit_count() <= bits)
    for a in prints:
        for b in prints:
            assert (found.get(a, a) == found.get(b, b)) == (want[a] == want[b])


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5)]
    random.Random(3).shuffle(chain)
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1200)}


def test_state_settings_are_put_back(spark, odd_docs):
    name = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
    before = spark.conf.get(name, None)
    exact_groups(odd_docs.where(F.col("doc_id") < 4)).count()
    assert spark.conf.get(name, None) == before
