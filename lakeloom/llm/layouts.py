"""Generated page layouts with known main text: the training set of the extractor.

No table holds pages with their main text marked, so the trees learn from pages
whose parts are known because they were put together here: an article in one of
many wrappings, and around and inside it the parts a reader would not call the
article. Words are random; only structure, attributes and lengths vary.
"""

from __future__ import annotations

import random

#: Names that sites give to the parts, by part.
NAMES = {
    "main": "article content main post entry story body text post-content entry-content article-body main-content story-body post-body hentry prose blog-post page-content single".split(),
    "nav": "nav navbar navigation menu main-menu breadcrumb breadcrumbs topnav subnav pagination pager toc tabs site-nav".split(),
    "header": "header masthead site-header page-header topbar branding logo top tagline".split(),
    "footer": "footer site-footer copyright colophon page-footer bottom legal footer-widgets".split(),
    "side": "sidebar side aside widget rail related recommended trending popular teaser-list more-stories right-column secondary".split(),
    "ad": "ad ads advert advertisement adsense sponsored sponsor promo promotion banner ad-slot google-ad commercial".split(),
    "notice": "cookie cookie-banner consent gdpr notice alert popup modal overlay newsletter subscribe signup paywall disclaimer cookie-notice message toast".split(),
    "form": "form search-form login register contact-form search subscribe-form".split(),
    "comments": "comments comment-list discussion responses replies disqus comments-area reader-comments respond feedback".split(),
    "share": "share social sharing share-buttons social-links follow tools post-meta-share".split(),
    "plain": "container wrapper row page site inner col layout grid box section block outer wrap".split(),
}
LETTERS = "abcdefghijklmnopqrstuvwxyz"


class Maker:
    """Writes one page; ``data-main`` marks the elements that hold main text (the reader of marks takes them out)."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.obscure = self.r.random() < 0.2  # class names that say nothing

    def words(self, low: int, high: int) -> str:
        r = self.r
        n = min(r.randint(low, high), r.randint(low, high))
        words = ["".join(r.choices(LETTERS, k=r.randint(1, 9))) for _ in range(n)]
        for i in range(n):
            if r.random() < 0.08 or i == n - 1 and r.random() < 0.9:
                words[i] += r.choice([".", ".", ".", ",", "?", "!"])
        return " ".join(words).capitalize()

    def named(self, part: str) -> str:
        r = self.r
        if self.obscure and part != "ad" or r.random() < 0.05:
            return f' class="{"".join(r.choices(LETTERS, k=6))}"' if r.random() < 0.7 else ""
        name = r.choice(NAMES[part])
        if r.random() < 0.25:
            name = r.choice(["site-", "js-", "c-", "l-", "post-", "page-"]) + name if part != "main" else name + r.choice(["-wrap", "-inner", ""])
        return f' {r.choice(["class", "class", "class", "id"])}="{name}"'

    def links(self, low: int, high: int) -> str:
        r = self.r
        items = [f'<a href="/{i}">{self.words(1, 4).rstrip(".,?!")}</a>' for i in range(r.randint(low, high))]
        if r.random() < 0.75:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return r.choice([" | ", " ", "<br>", " &middot; "]).join(items)

    def put(self, part: str, tags: list[str], inside: str) -> str:
        tag = self.r.choice(tags)
        bare = tag in ("nav", "aside", "footer", "header", "form") and self.r.random() < 0.5
        return f"<{tag}{'' if bare else self.named(part)}>{inside}</{tag}>"

    def inline(self, text: str) -> str:
        r, words = self.r, text.split(" ")
        for _ in range(r.choice([0, 0, 0, 1, 2])):
            i = r.randrange(len(words))
            words[i] = r.choice(["<a href='/x'>%s</a>", "<b>%s</b>", "<em>%s</em>", "<span>%s</span>", "%s<br>", "<i>%s</i>"]) % words[i]
        return " ".join(words)

    def clutter(self) -> str:
        """A part that is not main text, as found inside or beside an article."""
        r = self.r
        kind = r.choice(["ad", "ad", "share", "side", "notice", "form", "script", "hidden"])
        if kind == "ad":
            return self.put("ad", ["div", "div", "aside", "section", "p"], r.choice([self.words(2, 30), self.words(2, 12), self.links(1, 2)]))
        if kind == "share":
            return self.put("share", ["div", "ul"], self.links(2, 6))
        if kind == "side":
            return self.put("side", ["aside", "div", "section"], f"<h3>{self.words(1, 4)}</h3>" + r.choice([self.links(2, 7), f"<p>{self.words(5, 50)}</p>"]))
        if kind == "notice":
            inside = r.choice([self.words(4, 40), f"<p>{self.words(4, 40)}</p>", f"<h4>{self.words(1, 4)}</h4><p>{self.words(3, 20)}</p><button>{self.words(1, 2)}</button>"])
            return self.put("notice", ["div", "div", "section", "aside"], inside)
        if kind == "form":
            return self.form()
        if kind == "hidden":
            return f'<div {r.choice(["hidden", "style=display:none", "aria-hidden=true"])}><p>{self.words(3, 30)}</p></div>'
        return "<script>var a='<p>x</p>';</script>"

    def form(self) -> str:
        r = self.r
        fields = "".join(r.choice(["<label>%s</label><input type=text>", "<p>%s</p>", "<div>%s <input></div>", "<select><option>%s</option></select>"]) % self.words(1, 6)
                         for _ in range(r.randint(1, 4)))
        return f"<form{self.named('form')}>{r.choice(['', f'<h3>{self.words(1, 4)}</h3>', f'<p>{self.words(3, 20)}</p>'])}{fields}<button>{self.words(1, 2)}</button></form>"

    def paragraph(self) -> str:
        r = self.r
        long = r.choice([(1, 3), (3, 20), (10, 60), (20, 120), (60, 200)])
        return f"<p data-main>{self.inline(self.words(*long))}</p>"

    def article(self) -> str:
        r = self.r
        parts = []
        if r.random() < 0.85:
            heading = f"<{(h := r.choice(['h1', 'h1', 'h2']))} data-main>{self.words(2, 12)}</{h}>"
            parts.append(heading if r.random() < 0.8 else f"<header>{heading}</header>")
        style = r.random()
        for _ in range(r.choice([1, 2, 4, 8, 14])):
            x = r.random()
            if style < 0.12:  # never closed elements
                parts.append(f"<p data-main>{self.words(3, 60)}" if x < 0.5 else f"<p data-main><b>{self.words(3, 60)}<br>")
            elif style < 0.2:  # blocks that are no paragraphs
                parts.append(f"<div data-main>{self.inline(self.words(5, 100))}</div>")
            elif x < 0.74:
                parts.append(self.paragraph())
            elif x < 0.81:
                parts.append(f"<{(h := r.choice(['h2', 'h3', 'h4']))} data-main>{self.words(1, 8)}</{h}>")
            elif x < 0.87:
                tag = r.choice(["ul", "ol"])
                parts.append(f"<{tag}>" + "".join(f"<li data-main>{self.inline(self.words(1, 25))}</li>" for _ in range(r.randint(2, 8))) + f"</{tag}>")
            elif x < 0.91:
                parts.append(f"<blockquote data-main>{self.words(5, 60)}</blockquote>" if r.random() < 0.5 else f"<blockquote><p data-main>{self.words(5, 60)}</p></blockquote>")
            elif x < 0.94:
                parts.append(f"<pre data-main>{self.words(3, 40)}</pre>")
            elif x < 0.97:
                parts.append("<table>" + "".join("<tr>" + "".join(f"<td data-main>{self.words(1, 6)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(2, 5))) + "</table>")
            else:
                parts.append(f"<figure><img src=x><figcaption data-main>{self.words(3, 20)}</figcaption></figure>")
        for _ in range(r.choice([0, 0, 0, 1, 2])):
            parts.insert(r.randint(min(1, len(parts)), len(parts)), self.clutter())
        if r.random() < 0.08:
            parts.insert(min(1, len(parts)), self.put("nav", ["nav", "nav", "div"], self.links(2, 6)))
        if r.random() < 0.12:
            parts.append(self.put("footer", ["footer", "footer", "div"], r.choice([self.links(1, 5), self.words(2, 20), f"<p>{self.words(2, 20)}</p>"])))
        if r.random() < 0.12:
            parts.append(self.comments())
        inside = "".join(parts)
        for _ in range(r.choice([0, 0, 1, 2])):
            inside = f"<div{self.named(r.choice(['main', 'plain']))}>{inside}</div>"
        tag = r.choice(["article", "article", "article", "main", "div", "div", "section"])
        bare = tag in ("article", "main") and r.random() < 0.6
        inside = f"<{tag}{'' if bare else self.named('main')}>{inside}</{tag}>"
        return f"<main>{inside}</main>" if tag == "article" and r.random() < 0.3 else inside

    def comments(self) -> str:
        r = self.r
        tag, each = r.choice([("ul", "li"), ("ol", "li"), ("div", "div"), ("section", "div"), ("section", "article"), ("div", "p")])
        body = "".join(
            f"<{each}{r.choice(['', ' class=comment', ' class=comment-body', ' class=reply'])}>"
            + (self.words(2, 60) if each == "p" else f"{r.choice(['', f'<b>{self.words(1, 2)}</b>'])}<p>{self.words(2, 80)}</p>") + f"</{each}>"
            for _ in range(r.randint(1, 7)))
        inside = f"<{tag}>{body}</{tag}>" if r.random() < 0.4 else body
        return self.put("comments", [tag if tag != "ol" else "div"], f"{r.choice(['', f'<h3>{self.words(1, 3)}</h3>'])}{inside}{self.form() if r.random() < 0.3 else ''}")

    def page(self) -> str:
        r = self.r
        before, after = [], []
        if r.random() < 0.5:
            inside = r.choice([f"<h1>{self.words(1, 4)}</h1>", f"<div>{self.words(1, 6)}</div>", f"<p>{self.words(1, 12)}</p>", self.words(1, 12), f"<a href=/>{self.words(1, 3)}</a>"])
            before.append(self.put("header", ["header", "div", "header"], inside + (f"<nav>{self.links(3, 8)}</nav>" if r.random() < 0.4 else "")))
        if r.random() < 0.8:
            before.append(self.put("nav", ["nav", "nav", "div"], self.links(3, 9)))
        for _ in range(r.choice([0, 1, 1, 2, 3])):
            (before if r.random() < 0.5 else after).append(self.clutter())
        if r.random() < 0.4:
            side = "".join(f"<div{self.named('side')}><h3>{self.words(1, 4)}</h3>{r.choice([self.links(3, 8), f'<p>{self.words(5, 60)}</p>', self.words(5, 40)])}</div>" for _ in range(r.randint(1, 3)))
            (before if r.random() < 0.3 else after).append(self.put("side", ["aside", "aside", "div"], r.choice([side, f"<p>{self.words(5, 80)}</p>", self.words(4, 40)])))
        if r.random() < 0.4:
            after.insert(0, self.comments())
        if r.random() < 0.85:
            inside = r.choice([f"&copy; {self.words(1, 30)}", f"<p>{self.words(2, 50)}</p>", self.links(2, 8), f"<div>{self.links(2, 5)}</div><p>&copy; {self.words(1, 20)}</p>", self.words(1, 30)])
            after.append(self.put("footer", ["footer", "footer", "footer", "div"], inside))
        inside = self.article()
        for _ in range(r.choice([0, 0, 1, 2])):  # wrappers take in some of what stands next to the article
            if before and r.random() < 0.5:
                inside = before.pop() + inside
            if after and r.random() < 0.5:
                inside += after.pop(0)
            inside = f"<div{self.named('plain')}>{inside}</div>"
        whole = "".join(before) + inside + "".join(after)
        if r.random() < 0.03:
            whole = f"<form>{whole}</form>"
        return f"<html><head><title>{self.words(2, 8)}</title><style>p{{}}</style></head><body>{whole}</body></html>"
