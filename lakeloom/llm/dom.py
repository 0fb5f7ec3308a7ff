"""A forgiving reader of HTML into the nodes and text runs that extraction needs."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

#: Elements that begin and end a block of text.
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3"
    " h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section summary table caption tbody td tfoot th thead tr ul".split())
#: Elements whose content is never text of the page.
SILENT = frozenset(
    "head script style noscript template iframe object embed applet svg math canvas audio video map select option textarea button input datalist"
    " title noframes noembed".split())
RAW = frozenset("script style textarea title iframe noscript noembed noframes xmp".split())
VOID = frozenset("area base br col embed frame hr img input keygen link meta param source track wbr".split())
#: Start tags that end an open element of these names, up to the given borders.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th", "caption"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption"), ("table",)),
    "tfoot": (("thead", "tbody", "tr", "td", "th"), ("table",)), "thead": (("caption",), ("table",)),
    "option": (("option",), ("select", "datalist")), "body": (("head",), ("html",)), "button": (("button",), ("table", "html")),
}
#: What may stand in a head. Anything else, text included, ends a head whose end tag was left out.
IN_HEAD = frozenset("html head title base link meta style script noscript template basefont bgsound".split())
#: Blocks that stand in a list of choices; any other ends the list.
IN_SELECT = frozenset("option optgroup hr".split())
P_BORDERS = ("table", "td", "th", "caption", "button", "object", "html")
CLOSES_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "html", "body", "legend"}

_token = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)", re.S)
_attribute = re.compile(r"(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|\Z)", re.I)
_part = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


@dataclass
class Page:
    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    tokens: list[tuple[str, ...]] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)  # first node after the subtree
    #: (block number, node, text, characters inside links); equal block numbers make one block
    runs: list[tuple[int, int, str, bool]] = field(default_factory=list)


def attribute_tokens(attributes: str) -> tuple[str, ...]:
    """The parts of class, id and role, in lower case; ``hidden`` where the element isn't shown."""
    found = []
    for name, a, b, c in _attribute.findall(attributes):
        value, name = a or b or c, name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            found.append("hidden")
        elif name in ("class", "id", "role", "itemprop"):
            found.extend(p.lower() for p in _part.findall(value))
    return tuple(found)


def read(html: str) -> Page:
    """The nodes of a page in document order: blocks, and other elements with attributes that say what they are."""
    page = Page([""], [-1], [()], [0])
    stack: list[tuple[str, int]] = [("", 0)]  # element, the node it belongs to
    silent = links = block = 0
    at, size = 0, len(html)

    def pop(to: int) -> None:
        nonlocal silent, links, block
        for name, node in stack[to:]:
            silent -= name in SILENT
            links -= name == "a"
            block += name in BLOCKS
            if node != stack[to - 1][1]:
                page.ends[node] = len(page.tags)
        del stack[to:]

    def close(names: tuple[str, ...], borders: tuple[str, ...]) -> None:
        """End the outermost of ``names`` that lies inside the nearest border."""
        last = 0
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in borders:
                break
            if stack[i][0] in names:
                last = i
        if last:
            pop(last)

    unended: set[str] = set()  # silent elements without an end tag
    last_end: dict[str, int] = {}  # per silent element, where its last end tag stands

    def has_end(name: str, after: int) -> bool:
        if name not in last_end:
            last_end[name] = max((m.start() for m in re.finditer(f"</{re.escape(name)}(?=[\\s/>])", html, re.I)), default=-1)
        return last_end[name] >= after

    def text(raw: str) -> None:
        if stack[-1][0] == "head" and not raw.isspace():
            close(("head",), ())
        if not silent and raw and not raw.isspace():
            page.runs.append((block, stack[-1][1], unescape(raw) if "&" in raw else raw, links > 0))
        elif not silent and raw and page.runs:
            page.runs.append((block, stack[-1][1], " ", False))

    while m := _token.search(html, at):  # from where the last one ended: raw content is passed over and never read as markup
        if m.start() > at:
            text(html[at:m.start()])
        at = m.end()
        slash, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if slash:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    pop(i)
                    break
            if name in BLOCKS:
                block += 1
            continue
        if name in CLOSES_P:
            close(("p",), P_BORDERS)
        if name in ENDS:
            close(*ENDS[name])
        if name not in IN_HEAD and stack[-1][0] == "head":
            close(("head",), ())
        if name in BLOCKS and name not in IN_SELECT:
            close(("select", "datalist", *unended), ("html",))
        if name in SILENT and name not in RAW and name not in BLOCKS and name != "head" and not has_end(name, at):
            unended.add(name)  # its content ends with its parent or at the next block
        if name == "br" or name == "hr":
            if name == "hr":
                block += 1
            elif not silent:
                page.runs.append((block, stack[-1][1], " ", False))
        if name in VOID or attributes.endswith("/") and name not in BLOCKS and name not in RAW:
            continue
        tokens = attribute_tokens(attributes) if attributes else ()
        node = stack[-1][1]
        if name in BLOCKS or tokens and name not in SILENT:
            page.tags.append(name)
            page.parents.append(node)
            page.tokens.append(tokens)
            page.ends.append(0)
            node = len(page.tags) - 1
        if name in BLOCKS:
            block += 1
        silent += name in SILENT
        links += name == "a"
        stack.append((name, node))
        if name in RAW:  # its content is no markup
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(html, at)
            at = end.start() if end else size
    if at < size:
        text(html[at:])
    pop(1)
    page.ends[0] = len(page.tags)
    return page
