import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import prose
from lakeloom.llm import decontamination as dc, extraction as ex, licenses as li
from lakeloom.llm.dom import read

SF = "/root/testdata/sf0.01"

# -- licenses ---------------------------------------------------------------------------------


def license_words(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return [w for w in t.translate({ord(c): " " for c in li.CUT}).split(" ") if w]


def brute_licenses(texts, templates, contained=0.8):
    found = {}
    for key, text in texts:
        words = license_words(text)
        for name, wording in templates.items():
            w = license_words(wording)
            n = min(li.SHINGLE, len(w))
            length, own = len(w) - n + 1, {" ".join(w[i:i + n]) for i in range(len(w) - n + 1)}
            here = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
            margin = max(2, math.ceil(length / 4))
            best = max((len(own & set(here[max(0, s - margin):s + length + margin])) / len(own) for s in range(len(here))), default=0)
            if best >= contained:
                found[key, name] = best
    return found


def test_licenses_against_brute_force(spark):
    long = li.TEMPLATES["mit-header"]
    words = long.split()
    texts = [
        (1, "// " + long.replace("of charge,", "of charge,\n// ")), (2, prose(1, 400) + "\n" + long.upper() + " " + prose(2, 300)),
        (3, " ".join(words[:5] + ["other"] + words[6:])), (4, " ".join(words[: len(words) // 2])), (5, None), (6, ""), (7, "Released under the MIT License"),
        (8, "released under the mit licence"), (9, "All rights reserved."), (10, (prose(3, 50) + " Licensed under CC BY-NC 4.0. ") * 3),
    ]
    templates = {**li.TEMPLATES, "rights": "All rights reserved."}
    frame = spark.createDataFrame(texts, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("length", F.lit("x"))
    got = {(r.doc_id, r.template): r.containment for r in li.find_licenses(frame.unionByName(frame.limit(2)), templates).collect()}
    assert got == pytest.approx(brute_licenses(texts, templates))
    assert {t for _, t in got} >= {"mit", "mit-header", "cc-by-nc-4.0", "rights"} and not {k for k in got if k[0] == 4 and k[1] == "mit-header"}
    assert li.find_licenses(frame.limit(0)).count() == 0


def test_license_query_against_brute_force(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    marked = [t for t in texts if "icense" in (t[1] or "")]
    got = {(r.doc_id, r.template): r.containment for r in li.op2_license_scan(spark, "/root/testdata/sf0.001").collect()}
    assert got == pytest.approx(brute_licenses(marked, li.TEMPLATES))


# -- decontamination ----------------------------------------------------------------------------


def test_longest_common_subsequence():
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            old = 0
            for j, y in enumerate(b, 1):
                old, row[j] = row[j], old + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    import random

    r = random.Random(1)
    for _ in range(300):
        a, b = ([r.randrange(6) for _ in range(r.randrange(1, 80))] for _ in range(2))
        assert dc.longest_common(a, b) == plain(a, b)


def test_latent_basis_is_fitted_on_every_passage(spark):
    # more documents, and more passages in one, than any sample of the index once took
    texts = [prose(i, 40 + i % 50) for i in range(1100)] + [prose(5000, 3000), None, "", "none of them"]
    weights = dc.item_weights([prose(9000 + i, 12) for i in range(40)], np.ones(dc.BUCKETS, np.float32), 1e-9)
    place = np.where(weights > 0, np.cumsum(weights > 0) - 1, -1).astype(np.int32)
    bucket = {w: int(dc._buckets(dc.W.split([w], lower=True).hashes())[0]) for t in texts for w in (t or "").lower().split()}
    cut = [(t or "").lower().split()[a:a + dc.PASSAGE] for t in texts for a in range(0, len((t or "").split()), dc.PASSAGE)]
    want = sorted(rows for p in cut if (rows := [int(place[bucket[w]]) for w in p if place[bucket[w]] >= 0]))
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    assert sorted(r.rows for r in dc.passages(frame, place).collect()) == want
    items = spark.createDataFrame([(prose(9000 + i, 12),) for i in range(40)], "text string")
    where, table = dc.latent_table(frame, items, 40, weights, "text")
    assert (where == place).all() and table.shape == (int((weights > 0).sum()), dc.RANK)


def leak_cases():
    items = [(i, prose(100 + i, 16 + i * 3)) for i in range(15)] + [(20, prose(200, 30) + ". The answer: " + prose(201, 5) + "."), (21, None), (22, " "), (23, "one")]
    docs, want = [], set()
    for i, text in items[:15]:
        words = text.split()
        docs += [(i, prose(300 + i, 37 + i) + "\n" + text.upper() + "  " + prose(400 + i, 500)), (100 + i, text)]
        want |= {(i, i), (100 + i, i)}
        words[3::8] = ["changed"] * len(words[3::8])  # about an eighth
        docs.append((200 + i, prose(500 + i, 11) + " " + " ".join(words) + " " + prose(600 + i, 60)))
        want.add((200 + i, i))
        docs.append((300 + i, prose(700 + i, 200)))
    words = items[15][1].split()
    words[1:30:3] = ["other"] * len(words[1:30:3])  # a third, but the answer is there
    docs += [(50, prose(800, 40) + " " + " ".join(words)), (51, None), (52, ""), (None, items[4][1])]
    return items, docs, want | {(50, 20), (None, 4)}


def test_leaks(spark):
    items, docs, want = leak_cases()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_words", F.lit(1)).withColumn("_number", F.lit(2))
    got = dc.leaks(frame.unionByName(frame.limit(3)), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.item_id != 23} == want and len(got) == len({(r.doc_id, r.item_id) for r in got})
    blocks = dc.leaks(frame, benchmark, block_items=7).collect()
    assert {(r.doc_id, r.item_id) for r in blocks} == {(r.doc_id, r.item_id) for r in got}
    kept = dc.drop_leaks(frame, benchmark)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {300 + i for i in range(15)} | {51, 52}
    assert dc.leaks(frame.limit(0), benchmark).count() == 0 and dc.leaks(frame, benchmark.limit(0)).count() == 0
    assert dc.drop_leaks(frame, benchmark.limit(0)).count() == frame.count()


def altered(words, at):
    return [f"zz{i}q" if i in at else w for i, w in enumerate(words)]


@pytest.mark.parametrize("rarest", [False, True])
def test_recall_of_altered_items(spark, rarest):
    """Both rules, on all items: words replaced at random, and the rarest ones as a paraphrase does."""
    import random

    r = random.Random(4)
    items, docs = dc.table(spark, SF, "benchmark"), dc.table(spark, SF, "documents").select("doc_id", "text")
    idf = dc.inverse_frequencies(docs)
    hosts, rows, want = [x.text for x in docs.where("length(text) between 1500 and 3000").collect()], [], set()
    for item, text in items.collect():
        words, answer = text.split(), dc.answer_of(text)
        rare = dict(zip(words, idf[dc._buckets(dc.W.split([text], lower=True).hashes())]))
        for part, keep in ((0.18, 0), (0.38, len(answer) if len(answer) >= 3 else len(words))):
            body = list(range(len(words) - keep))
            n = min(len(body), int(part * len(words)))
            at = sorted(body, key=lambda i: -rare[words[i]])[:n] if rarest else r.sample(body, n)
            host, new = r.choice(hosts).split(), altered(words, set(at))
            cut = r.randrange(len(host))
            ids = {w: i for i, w in enumerate({*words, *new})}
            share = dc.longest_common([ids[w] for w in words], [ids[w] for w in new]) / len(words)
            if n and (share >= 0.8 or keep and keep < len(words) and share >= 0.6):
                rows.append((10**9 + len(rows), " ".join([*host[:cut], *new, *host[cut:]])))
                want.add((rows[-1][0], item))
    frame = spark.createDataFrame(rows, "doc_id long, text string").unionByName(docs)
    got = {(x.doc_id, x.item_id) for x in dc.leaks(frame, items).collect()}
    assert len(want) > 50 and len(want & got) >= 0.98 * len(want)


def test_recall_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 350").collect()
    items = [(r.item_id, r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = set()
    for r in docs:
        words = (r.text or "").lower().split()
        known = set(words)
        for i, item in items:
            if sum(w in known for w in item) >= 0.8 * len(item):
                span = 2 * len(item)
                if any(dc.longest_common(item, words[s:s + span]) >= 0.8 * len(item) for s in range(0, len(words), 4)):
                    want.add((r.doc_id, i))
    got = {(r.doc_id, r.item_id) for r in dc.op9_benchmark_decontamination(spark, SF).where("doc_id < 350").collect()}
    assert len(want & got) >= 0.9 * len(want) and want


# -- HTML -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def trees():
    return ex.model()


def test_main_text_without_the_rest(trees):
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
      <nav><ul><li><a href=/>Home</a></li><li><a href=/b>More</a></li></ul></nav><div class="cookie-notice"><p>We use cookies, you know.</p></div>
      <main><article><h1>Title &eacute;&#8212;x &amp;amp;</h1><p>First   para
      of text, with several words in it.<p>Second <b>bold</b><br>line &lt;p&gt;.<ul><li>One item<li>Two item</ul><div class="ad">Buy this now.</div>
      <script>var a="</p>";</script><blockquote>Said by some.</blockquote></article>
      <section id="comments"><h3>Comments</h3><div class="comment"><p>I really like this article, it is great and so on.</p></div></section></main>
      <aside class="sidebar"><p>Side text that goes on for a while.</p></aside><form><p>Subscribe here</p><input><button>Go</button></form>
      <footer>&copy; Someone</footer></body></html>"""
    assert ex.extract([html], trees) == [
        "Title é—x &amp;\nFirst para of text, with several words in it.\nSecond bold line <p>.\nOne item\nTwo item\nSaid by some."]


def test_odd_html(trees):
    assert ex.extract(["", "   ", "plain <words", "<p>a", "<!-- <p>x</p>", "<p>a<b>b</p>c</b><td>d", "<script>x", "</div></p>" * 50, "<a " + "x" * 100_000], trees)[:3] == ["", "", "plain"]
    deep = "<div>" * 3000 + "deep text" + "</div>" * 3000
    assert ex.extract([deep], trees) in (["deep text"], [""])


def test_nothing_is_kept_below_a_dropped_node(trees):
    import numpy as np

    r = np.random.default_rng(1)
    for seed in range(30):
        page, _ = ex._marked(seed)
        kept = ex.decode(page, r.normal(size=len(page.tags)) * 3)
        assert all(kept[p] for k, p in zip(kept[1:], page.parents[1:]) if k)


def test_learned_layouts_it_has_not_seen(trees):
    right = 0
    for seed in range(50_000, 50_200):
        page, holds = ex._marked(seed)
        holds[0] = True
        right += ex.kept_text(page, ex.decode(page, trees.log_odds(ex.features(page)))) == ex.kept_text(page, holds)
    assert right >= 170


def test_reader_makes_the_tree():
    page = read("<body><p>a<p>b<ul><li>c<li>d</ul><table><tr><td>e<td>f</table>")
    assert page.tags[1:] == ["body", "p", "p", "ul", "li", "li", "table", "tr", "td", "td"]
    assert [t for _, _, t, _ in page.runs] == list("abcdef") and len({b for b, *_ in page.runs}) == 6


def test_pages_query(spark):
    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = ex.op1_html_extraction(spark, sf).collect()
    assert {r.page_id for r in got} == set(pages) and all(r.n_chars == len(r.text) and r.url == pages[r.page_id].url for r in got)
    rows = spark.createDataFrame([(1, "u", None, 5), (1, "u", "<p>some text here, with words.</p>", 5)], "page_id long, url string, html string, text int")
    assert [(r.text, r.n_chars) for r in ex.main_text(rows, ("page_id", "url")).orderBy("n_chars").collect()] == [("", 0), ("some text here, with words.", 27)]
    assert ex.main_text(rows.limit(0), ("page_id", "url")).count() == 0
