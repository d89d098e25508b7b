"""Main text of HTML pages by tree scoring.

A page becomes a tree of its block elements; inline elements only add to the block that they are in,
whose link characters are counted apart. What is never part of an article (scripts, menus, footers,
forms, hidden parts, and elements whose class, id or role names such a part) leaves the tree with all
below it. Then

* every block of text gets points for its length and its commas, and passes them on: its container
  gets them whole, the next one half, those above a share that falls with the distance;
* a container's points are discounted by its link density, and shifted by what its tag and its names say;
* the best container is kept, or the article element around it, and of its siblings those with enough
  points of their own, and paragraphs, headings and elements of its kind that read like text.

The text is that of the kept elements in page order: references decoded, white space inside a block
one space, blocks joined by one line feed.

How it runs: pages are parsed where they are read, one at a time, in Arrow batches; nothing is
shuffled, and a lost executor costs its own rows only. Memory is one page and its tree.

Defined cases: null or empty html has an empty text; a page without markup is one block; a page where
nothing gets points has what is left of it as its text; tags that are never closed end with the
element around them, and a page may end anywhere, even inside a tag or a comment, which is then
dropped; rows that repeat are extracted each; an empty table gives no rows. Only the named columns
are read, and kept columns may have any name.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from veracity.llm.common import map_arrow

_TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+)))?""")
_NAME = re.compile("[A-Za-z]+")

# Elements of HTML by their part in a page.
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
          "sub", "sup", "time", "tt", "u", "var"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
DROPPED = {"nav", "header", "footer", "aside", "form", "button", "select", "option", "datalist", "fieldset", "dialog",
           "menu", "noscript", "template", "object", "applet", "svg", "math", "canvas", "audio", "video", "head"}
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert",
                 "menu", "menubar", "form", "toolbar"}
#: Words of a class or id that name a part outside the article.
DROPPED_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
                 "banner", "cookie", "cookies", "consent", "gdpr", "notice", "sidebar", "comment", "comments", "disqus",
                 "replies", "respond", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer",
                 "header", "masthead", "share", "sharing", "social", "related", "newsletter", "subscribe", "signup",
                 "popup", "modal", "overlay", "pagination", "pager", "skip", "login", "toolbar", "widget"}
GOOD_NAMES = {"article", "body", "content", "entry", "main", "page", "post", "story", "text"}
#: Elements that end at the start of another of the same set, inside the nearest of the boundaries.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
TAG_POINTS = {"article": 10, "main": 5, "div": 5, "section": 3, "pre": 3, "td": 3, "blockquote": 3,
              "ul": -3, "ol": -3, "dl": -3, "li": -3, "dd": -3, "dt": -3, "address": -3, "th": -5}
#: Points for a block: one, one a comma, and one per so many characters up to so many.
CHARS_A_POINT, MOST_LENGTH_POINTS = 100, 3
#: Containers that a block's points reach.
LEVELS = 6
#: Share of the best container's points from which a sibling stays, and the least.
SIBLING_SHARE, SIBLING_LEAST = 0.2, 10
NAME_POINTS = 25


class _Node:
    __slots__ = ("tag", "parent", "parts", "dropped", "named", "good", "points", "chars", "linked")

    def __init__(self, tag: str, parent: _Node | None, dropped: bool = False, named: bool = False, good: bool = False):
        self.tag, self.parent, self.dropped, self.named, self.good = tag, parent, dropped, named, good
        self.parts: list = []                       # child nodes and blocks (text, link characters) in page order
        self.points, self.chars, self.linked = 0.0, 0, 0


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(raw)}


def _judged(tag: str, raw: str, inside_article: bool) -> tuple[bool, bool, bool]:
    """(is outside the article, only its names say so, is named like an article) of a start tag."""
    if tag in DROPPED and not (tag == "header" and inside_article):
        return True, False, False
    if "=" not in raw and "hidden" not in raw:
        return False, False, False
    at = _attributes(raw)
    if "hidden" in at or at.get("aria-hidden") == "true" or at.get("role", "").lower() in DROPPED_ROLES:
        return True, False, False
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", at.get("style", "")):
        return True, False, False
    whole = f"{at.get('class', '')} {at.get('id', '')}".lower().split()
    if tag in ("html", "body", "main", "article"):  # a part of a name speaks of what is inside
        out = tag == "article" and any(w in DROPPED_NAMES for w in whole)
        return out, False, False
    words = {w for name in whole for w in _NAME.findall(name)}
    out = not words.isdisjoint(DROPPED_NAMES)
    return out, out, not words.isdisjoint(GOOD_NAMES)


def page_tree(page: str) -> list[_Node]:
    """The block elements in page order, the root first, with their texts."""
    root = at = _Node("html", None)
    nodes, opened = [root], Counter()               # and how many elements of a tag are open
    text: list[str] = []
    links, link_from = 0, None                      # link characters of the block, node of the open link
    mute, muted = "", 0                             # an inline part that is none of the article, and its depth
    dropped = 0                                     # open elements that are none of it

    def flush():
        nonlocal links
        if text:
            block = " ".join(unescape("".join(text)).split())
            text.clear()
            if block:
                at.parts.append((block, min(links, len(block))))
        links = 0

    def close(until: _Node):
        """Leave all elements up to and with ``until``."""
        nonlocal at, link_from, muted, dropped
        flush()
        node, muted = at, 0
        while True:
            if node is link_from:
                link_from = None
            opened[node.tag] -= 1
            dropped -= node.dropped
            if node is until:
                break
            node = node.parent
        at = until.parent or root

    def nearest(names: set[str], bounds: set[str]) -> _Node | None:
        node = at if any(opened[n] for n in names) else root
        while node is not root and node.tag not in bounds:
            if node.tag in names:
                return node
            node = node.parent
        return None

    def put(chars: str):
        nonlocal links
        if chars and not muted:
            text.append(chars)
            if link_from is not None:
                links += len(unescape(chars))

    pos, size = 0, len(page)
    while pos < size:
        m = _TAG.search(page, pos)
        if m is None:
            put(page[pos:])
            break
        put(page[pos:m.start()])
        pos = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                link_from = None
            elif tag in INLINE:
                muted -= bool(muted) and tag == mute
            elif tag not in VOID:
                node = nearest({tag}, set())
                if node is not None:
                    close(node)
                elif tag == "p":
                    flush()
            elif tag == "br":
                put(" ")
            continue
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, pos)
            pos = end.start() if end else size
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            else:
                put(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                link_from = at if "href" in m[3] else None
            elif muted:
                muted += tag == mute
            elif m[3] and _judged(tag, m[3], True)[0]:
                mute, muted = tag, 1
            continue
        if tag in ("html", "body"):
            flush()
            continue
        flush()
        if tag in CLOSES:
            names, bounds = CLOSES[tag]
            while (node := nearest(names, bounds)) is not None:
                close(node)
        elif (node := nearest({"p"} | HEADINGS if tag in HEADINGS else {"p"}, {"td", "th", "button", "object"})) is not None:
            close(node)
        node = _Node(tag, at, *_judged(tag, m[3], opened["article"] > 0))
        nodes.append(node)
        at.parts.append(node)
        if dropped and tag in ("article", "main") and not node.dropped:
            around, up = [], at                     # names of a wrapper that speak of another part in it
            while up is not None:
                if up.dropped:
                    around.append(up)
                up = up.parent
            if all(n.named for n in around):
                dropped = 0
                for n in around:
                    n.dropped = False
        opened[tag] += 1
        dropped += node.dropped
        at = node
    flush()
    return nodes


def _kept_blocks(top: _Node) -> list[tuple[_Node, str, int]]:
    """(container, text, link characters) of all blocks in page order, without dropped elements."""
    out, stack = [], [(top, iter(top.parts))]
    while stack:
        node, parts = stack[-1]
        for part in parts:
            if isinstance(part, tuple):
                out.append((node, *part))
            elif not part.dropped:
                stack.append((part, iter(part.parts)))
                break
        else:
            stack.pop()
    return out


def _paragraph(node: _Node) -> bool:
    return node.tag in ("p", "pre", "blockquote") or node.tag in HEADINGS


def main_text(page: str) -> str:
    """The article of an HTML page as blocks joined by line feeds."""
    nodes = page_tree(page)
    blocks = _kept_blocks(nodes[0])
    holders = []
    for node, text, linked in blocks:
        points = (1 + text.count(",") + min(len(text) // CHARS_A_POINT, MOST_LENGTH_POINTS)) * (1 - linked / len(text))
        holder = node.parent if _paragraph(node) and node.parent else node
        up, level = holder, 0
        while up is not None and level < LEVELS:
            if not up.points:
                holders.append(up)
            up.points += points if level == 0 else points / 2 if level == 1 else points / (3 * level)
            up, level = up.parent, level + 1
        node.chars += len(text)
        node.linked += linked
    for node in reversed(nodes):
        if node.parent is not None and not node.dropped:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
    if not holders:
        return "\n".join(t for _, t, _ in blocks)

    def score(n: _Node) -> float:
        own = n.points + TAG_POINTS.get(n.tag, 0) + NAME_POINTS * n.good
        return own * (1 - n.linked / n.chars) if n.chars else 0.0

    best = max(holders, key=score)
    up = best
    while up is not None:                           # the article element around it, where there is one
        if up.tag == "article":
            best = up
        up = up.parent
    kept = {id(best)}
    if best.parent is not None:
        least = max(SIBLING_LEAST, SIBLING_SHARE * score(best))
        for part in best.parent.parts:
            if isinstance(part, tuple) or part.dropped or part is best:
                continue
            text = [t for n, t, _ in _kept_blocks(part)]
            density = part.linked / part.chars if part.chars else 0.0
            like = _paragraph(part) or part.tag == best.tag != "article"
            reads = like and density < 0.25 and (part.chars > 80 or part.tag in HEADINGS or (
                not part.linked and bool(text) and text[-1][-1] in ".!?"))
            if reads or (part.points and score(part) >= least):
                kept.add(id(part))
    out, state = [], {}
    for node, text, _ in blocks:
        path, up = [], node
        while up is not None and id(up) not in state and id(up) not in kept:
            path.append(id(up))
            up = up.parent
        inside = up is not None and (id(up) in kept or state[id(up)])
        state.update(dict.fromkeys(path, inside))
        if inside:
            out.append(text)
    return "\n".join(out)


def extract_main_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"),
                      text_col: str = "text", step_bytes: int = 1 << 22) -> DataFrame:
    """``keep`` columns and ``text_col``, the main text of every row's whole page."""
    names = [f"k{k}" for k in range(len(keep))]     # kept names may clash with the result's
    rows = pages.select(*[F.col(c).alias(k) for c, k in zip(keep, names)], F.col(html_col).cast("string").alias("html"))
    schema = StructType([*(rows.schema[k] for k in range(len(keep))), StructField("main", StringType())])

    def run(batches):
        for b in batches:
            done, size, lo = [], 0, 0
            for v in b.column(len(keep)):
                done.append(main_text(v.as_py() or ""))
                size += len(done[-1])
                if size >= step_bytes:
                    yield _batch(b, lo, done)
                    lo, done, size = lo + len(done), [], 0
            if done:
                yield _batch(b, lo, done)

    def _batch(b, lo, done):
        kept = [b.column(k).slice(lo, len(done)) for k in range(len(keep))]
        return pa.RecordBatch.from_arrays([*kept, pa.array(done, pa.string())], [*names, "main"])

    return map_arrow(rows, run, schema).toDF(*keep, text_col)
