"""Main text of HTML pages: boosted trees over DOM nodes, decoded from the root down.

Every block of a page, and every other element with a class, id or role, is a
node. Its features are the density of its subtree (text, links, words and marks
per element), tokens of its attributes and of those above it, depth, place, and
how it compares with its siblings. Trees give the log-odds that a node holds main
text. Decoding maximises the summed log-likelihood over all ways to keep nodes in
which nothing is kept below a dropped node, so an article's advert can go, but no
part of a dropped sidebar can come back.

The trees are learned in numpy, on the driver, from generated layouts (see
``layouts``); a page's table plays no part in that, and the training set doesn't
grow with the input.

Kept text: character references decoded, white space inside a block to one space
(any character that Unicode counts as such), trimmed, empty blocks left out,
blocks in page order joined by a line feed. Text inside scripts, styles, form
fields, buttons, frames and the head is never text of the page.

Defined results: null html is empty; no html, or none with text, gives an empty
string and no characters; repeated rows are extracted each; an empty table gives
an empty result; extra columns are left out. Texts of any length are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeloom.llm import boosting
from lakeloom.llm.common import query, table
from lakeloom.llm.dom import Page, read
from lakeloom.llm.layouts import NAMES, Maker

KINDS = {
    k: i for i, ks in enumerate([
        ["article"], ["main"], ["section"], ["div"], ["p"], ["h1"], ["h2", "h3", "h4", "h5", "h6"], ["ul", "ol", "dl", "menu"], ["li", "dt", "dd"],
        ["nav"], ["aside"], ["header", "hgroup"], ["footer"], ["form", "fieldset", "search", "legend"], ["table", "tbody", "thead", "tfoot"],
        ["tr", "td", "th", "caption"], ["blockquote", "pre"], ["figure", "figcaption"], ["details", "summary", "dialog", "address"], ["body", "html", "center"],
    ]) for k in ks
}
OTHER_KIND = max(KINDS.values()) + 1
PARTS = [p for p in NAMES if p != "plain"]
#: Which parts a token speaks for; a compound name speaks with each of its parts.
TOKENS: dict[str, int] = {}
for _i, _p in enumerate(PARTS):
    for _name in NAMES[_p]:
        for _t in _name.split("-"):
            if _t not in ("post", "page", "site", "list", "area", "top", "right", "text", "body", "main", "content", "buttons", "links", "slot", "meta") or _p == "main":
                TOKENS[_t] = TOKENS.get(_t, 0) | 1 << _i
TOKENS |= {t + "s": m for t, m in list(TOKENS.items()) if not t.endswith("s") and t + "s" not in TOKENS}
HIDDEN = 1 << len(PARTS)
TOKENS["hidden"] = HIDDEN
LANDMARKS = [KINDS[k] for k in ("article", "main", "nav", "aside", "header", "footer", "form")]
_marks = re.compile(r"[.!?,;:]")


def features(page: Page) -> np.ndarray:
    """A row per node."""
    n = len(page.tags)
    kind = np.array([KINDS.get(t, OTHER_KIND) for t in page.tags])
    parent = np.array(page.parents)
    own = [0] * n
    for i, tokens in enumerate(page.tokens):
        for t in tokens:
            own[i] |= TOKENS.get(t, 0)
    # everything that is passed down from above
    depth, above_tokens, above_kinds = [0] * n, [0] * n, [0] * n
    for i in range(1, n):
        p = page.parents[i]
        depth[i] = depth[p] + 1
        above_tokens[i] = above_tokens[p] | own[p]
        above_kinds[i] = above_kinds[p] | 1 << int(kind[p])
    # everything that is summed from below
    chars, linked, words, marks, blocks = (np.zeros(n) for _ in range(5))
    for _, node, text, link in page.runs:
        size = len(text)
        chars[node] += size
        linked[node] += size * link
        words[node] += text.count(" ") + 1 if size > 1 else 0
        marks[node] += len(_marks.findall(text))
        blocks[node] += 1
    ends, here = np.array(page.ends), np.arange(n)

    def below(x: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(x)])
        return sums[ends] - sums[here]

    all_chars, all_linked, all_words, all_marks = below(chars), below(linked), below(words), below(marks)
    nodes, ps, lis = ends - here, below(kind == KINDS["p"]), below(kind == KINDS["li"])
    up = np.maximum(parent, 0)
    children = np.bincount(up[1:], minlength=n) if n > 1 else np.zeros(n)
    sibling_chars = np.bincount(up[1:], all_chars[1:], n) if n > 1 else np.zeros(n)
    same = up * 64 + kind
    _, which, alike = np.unique(same, return_inverse=True, return_counts=True)
    nth = np.zeros(n)
    seen: dict[int, int] = {}
    for i in range(1, n):
        p = page.parents[i]
        nth[i] = seen[p] = seen.get(p, -1) + 1
    total = max(1.0, all_chars[0])
    started = np.cumsum(chars) - chars
    own, above_tokens, above_kinds = np.array(own), np.array(above_tokens), np.array(above_kinds)
    columns = [
        kind, kind[up], depth, np.log1p(chars), np.log1p(all_chars), all_linked / np.maximum(1, all_chars), linked / np.maximum(1, chars),
        all_chars / nodes, all_words / nodes, all_marks / np.maximum(1, all_words), all_chars / total, chars / total, started / total,
        np.log1p(nodes), np.log1p(ps), np.log1p(lis), ps / nodes, children, children[up], nth / np.maximum(1, children[up]), alike[which],
        all_chars / np.maximum(1, sibling_chars[up]), sibling_chars[up] / np.maximum(1, children[up]), all_chars[up] / total,
        all_linked[up] / np.maximum(1, all_chars[up]), here / n,
    ]
    columns += [(own >> i) & 1 for i in range(len(PARTS) + 1)] + [(above_tokens >> i) & 1 for i in range(len(PARTS) + 1)]
    columns += [(above_kinds >> k) & 1 for k in LANDMARKS]
    return np.stack(columns, axis=1).astype(np.float32)


def decode(page: Page, log_odds: np.ndarray) -> np.ndarray:
    """Which nodes are kept: the likeliest choice in which a dropped node keeps nothing below it."""
    n = len(page.tags)
    keep, drop = -np.logaddexp(0, -log_odds), -np.logaddexp(0, log_odds)
    gain_below = np.zeros(n)  # of the best choice below a kept node, over dropping all of it
    gain = np.zeros(n)
    for i in range(n - 1, 0, -1):
        gain[i] = keep[i] - drop[i] + gain_below[i]
        if gain[i] > 0:
            gain_below[page.parents[i]] += gain[i]
    kept = np.zeros(n, bool)
    kept[0] = True
    for i in range(1, n):
        kept[i] = kept[page.parents[i]] and gain[i] > 0
    return kept


def kept_text(page: Page, kept: np.ndarray) -> str:
    blocks, last = [], None
    for block, node, text, _ in page.runs:
        if kept[node]:
            if block != last:
                blocks.append([])
                last = block
            blocks[-1].append(text)
    return "\n".join(t for b in blocks if (t := " ".join("".join(b).split())))


def _marked(seed: int) -> tuple[Page, np.ndarray]:
    """A generated page and which of its nodes hold main text."""
    html = Maker(seed).page()
    bare = read(html.replace(" data-main", ""))
    marks = iter(re.findall(r"<([a-z][a-z0-9]*)([^>]*)>", re.sub(r"<script>.*?</script>", "", html)))
    # the reader makes its nodes in the order of the start tags
    holds = np.zeros(len(bare.tags), bool)
    i = 0
    for tag, attributes in marks:
        if i + 1 < len(bare.tags) and bare.tags[i + 1] == tag:
            i += 1
            holds[i] = " data-main" in attributes
    for i in range(len(holds) - 1, 0, -1):
        holds[bare.parents[i]] |= holds[i]
    return bare, holds


@cache
def model(layouts: int = 3000, seed: int = 1) -> boosting.Trees:
    """The trees, learned from ``layouts`` generated pages."""
    rows = [(features(p), y) for p, y in map(_marked, range(seed * 1_000_003, seed * 1_000_003 + layouts))]
    x, y = np.concatenate([f[1:] for f, _ in rows]), np.concatenate([h[1:] for _, h in rows]).astype(float)
    # links in long menus are many and easy; a page counts by its parts, not by its length
    weights = np.concatenate([np.full(len(h) - 1, 1 / np.sqrt(len(h))) for _, h in rows])
    return boosting.fit(x, y, weights / weights.mean())


def extract(htmls: list[str], trees: boosting.Trees) -> list[str]:
    pages = [read(h) for h in htmls]
    if not pages:
        return []
    odds = trees.log_odds(np.concatenate([features(p) for p in pages]))
    at = np.cumsum([0, *(len(p.tags) for p in pages)])
    return [kept_text(p, decode(p, odds[at[i]:at[i + 1]])) for i, p in enumerate(pages)]


def main_text(pages: DataFrame, keep: tuple[str, ...], html: str = "html", batch_chars: int = 2_000_000) -> DataFrame:
    """Columns ``keep`` of ``pages``, then ``text`` and ``n_chars``."""
    trees = pages.sparkSession.sparkContext.broadcast(model())  # its size depends on the number of trees alone

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            htmls = ["" if h is None else h for h in batch.column(html).to_pylist()]
            texts, start, size = [], 0, 0
            for i, h in enumerate([*htmls, None]):
                if h is None or size and size + len(h) > batch_chars:
                    texts += extract(htmls[start:i], trees.value)
                    start, size = i, 0
                size += len(h or "")
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, keep), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*keep, "text", "n_chars"])

    schema = pages.select(*keep, F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return pages.select(*keep, html).mapInArrow(run, schema)


@query("op1_html_extraction")
def op1_html_extraction(spark, sf):
    return main_text(table(spark, sf, "pages"), ("page_id", "url"))
