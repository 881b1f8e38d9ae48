"""Main text of web pages: flat text blocks classified by a decision tree.

A page becomes a flat list of text blocks, cut at block-level tags. Each block has its word count and link density,
those of its neighbours, and where it stands (inside an article, inside something named as furniture, a heading).
A decision tree grown from ``BLOCKS``, a small labelled table, says which blocks are main text. Those are joined in
page order. Nothing is cut. Tags are read in one pass that never goes back, whatever the markup. Two or more like elements
side by side that each name an author or offer a reply are readers' posts, whatever their container is called. A name such as "sidebar" on what surrounds an article doesn't make the article furniture,
nor does what a name says is elsewhere ("has-sidebar"). A name that says more than that ("share-price") is a hint that
words and link density decide on.

A null or empty page has an empty text. Pages are independent of each other, so repeated rows give repeated
results. Broken markup is read to its end: a tag left open ends with its parent, and what is not a tag is text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm._common import table
from foliograph.llm.trees import Node, grow, share_of

#: Elements whose contents are not text.
HIDDEN = {"script", "style", "noscript", "template", "head", "svg", "iframe", "object", "annotation", "select", "textarea", "button", "canvas", "audio", "video", "datalist"}
RAW = {"script", "style", "textarea", "title"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q",
    "math", "mfrac", "mi", "mn", "mo", "mover", "mrow", "mspace", "msqrt", "mstyle", "msub", "msubsup", "msup", "mtext", "munder", "munderover", "semantics",
    "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Elements that one of the same kind, or its parent's end, closes.
LOOSE = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
FURNITURE = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
MAIN = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words in class, id or role that name furniture; the words of a name are told apart by hyphens, underscores, case.
NAMED = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent",
    "contentinfo", "cookie", "cookies", "discussion", "discussions", "disqus", "footer", "form", "gdpr", "header", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter",
    "notice", "overlay", "pagination", "popup", "promo", "promoted", "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signup", "social",
    "sponsor", "sponsored", "subscribe", "tags", "toolbar", "widget",
}

#: Words that go with those of ``NAMED`` and leave their meaning as it is.
NEUTRAL = {
    "accept", "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "card", "col", "column", "container", "content", "global", "group", "head", "holder",
    "icon", "icons", "info", "inner", "item", "items", "js", "left", "link", "law", "links", "list", "main", "message", "policy", "thread", "threads", "outer", "page", "panel", "post", "posts", "primary", "right", "row", "secondary", "section",
    "site", "slot", "small", "text", "title", "top", "unit", "us", "wrap", "wrapper",
}
#: Of these, what has articles of its own (comments, teasers, adverts), so that an article inside is no main text.
OWN = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "comment", "comments", "disqus", "promo", "promoted", "related", "replies", "respond", "sponsor", "sponsored",
}
#: A name that also stands for parts of articles: it only says something outside of them.
OUTSIDE = {"discussion", "discussions"}
#: Words in class, rel or itemprop of what signs a reader's post.
SIGNED = {"author", "avatar", "commenter", "reply", "user", "username", "vcard"}
#: Elements that can be a post, and how far above its signature a post's element can be.
POSTS, ABOVE = {"li", "article", "div", "section", "blockquote", "dd", "tr"}, 5
LEGAL = re.compile(r"(?:©|\(c\)|copyright\b)", re.I)
#: What follows these in a name is said to be elsewhere on the page, or not there.
ELSEWHERE = {"has", "with", "without", "no"}

#: What can begin markup; tags are then read by ``attributes_end``.
MARK = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(/?)([A-Za-z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
PART = re.compile(r"""[>]|=\s*["']""")
NAME_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    furniture: float  # 1 if its place says so, 0.5 if a name only hints at it
    main: bool
    heading: bool

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


def compound(word: str) -> list[str]:
    """A word of ``NAMED`` and one that goes with it, written together ("commentlist"), else the word itself."""
    if word not in NAMED:
        for k in range(len(word) - 1, 1, -1):
            if word[:k] in NAMED and word[k:] in NAMED | NEUTRAL:
                return [word[:k], word[k:]]
    return [word]


def named_words(attributes: dict[str, str], *names: str) -> list[list[str]]:
    """The words of each name in the given attributes, up to one of ``ELSEWHERE``."""
    out = []
    for found in names:
        for token in attributes.get(found, "").split():
            words = [x for w in NAME_WORDS.findall(token) for x in compound(w.lower())]
            out.append(words[: next((k for k, w in enumerate(words) if w in ELSEWHERE), len(words))])
    return out


def attributes_of(raw: str) -> dict[str, str]:
    """Attributes by their names in lower case; of several of one name the first counts."""
    out: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(raw) if raw.strip() else ():
        out.setdefault(name.lower(), html.unescape(value[1:-1] if value[:1] in "\"'" and value[-1:] == value[:1] and len(value) > 1 else value))
    return out


class _Tags:
    """Finds the ends of tags; remembers that a quote has no partner further on, so that no text is searched twice."""

    def __init__(self, page: str):
        self.page, self.gone = page, {'"': len(page), "'": len(page)}

    def attributes_end(self, at: int) -> int:
        """Where the ``>`` of the tag is whose attributes begin at ``at``; the page's end if there is none."""
        page, size = self.page, len(self.page)
        while True:
            found = PART.search(page, at)
            if not found:
                return size
            quote = found[0][-1]
            if quote == ">":
                return found.start()
            at = found.end()
            if at < self.gone[quote]:  # an opening quote without a partner is a plain character
                end = page.find(quote, at)
                if end < 0:
                    self.gone[quote] = at
                else:
                    at = end + 1


class _Open:
    """Where the reader stands: the open elements and what they mean for text."""

    def __init__(self) -> None:
        #: (name, hidden, furniture, main, heading, link, number)
        self.stack: list[tuple[str, bool, float, bool, bool, bool, int]] = [("", False, 0.0, False, False, False, 0)]
        #: Why each open element is furniture: "" (it isn't), "hint", "layout" (a mere name), "header" (of an article) or "firm".
        self.why: list[str] = [""]
        #: Places in the stack of each name, and of the parts of a page.
        self.places: dict[str, list[int]] = {}
        self.parts: list[int] = []
        self.number = 0
        #: number of an element -> (its parent's number, its name); of those that may be posts and are signed.
        self.signed: dict[int, tuple[int, str]] = {}

    def push(self, name: str, attributes: dict[str, str]) -> None:
        _, hidden, _, main, heading, link, _ = self.stack[-1]
        words = named_words(attributes, "class", "id", "role") if attributes else []
        if attributes:
            style = attributes.get("style", "")
            hidden |= "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or "display" in style.lower() and bool(re.search(r"display\s*:\s*none", style, re.I))
            self.sign(words, attributes)
        why = self.why[-1]
        if name in MAIN:
            if why in ("layout", "hint"):
                why = ""
            if any(w and w[0] in OWN for w in words):  # of an article's own names only what it is first of all counts
                why = "firm"
        elif name == "header" and main and not why:
            why = "header"
        elif name in HEADINGS and why == "header":
            why = ""
        elif name not in ("html", "body"):  # what names the whole page names no part of it
            plain = {x for w in words if set(w) <= NAMED | NEUTRAL for x in w} & NAMED
            if main:
                plain -= OUTSIDE
            if name in FURNITURE or plain & (OWN | OUTSIDE):
                why = "firm"
            elif plain and why != "firm":
                why = "firm" if main else "layout"
            elif not why and any(set(w) & (NAMED - OUTSIDE) for w in words):
                why = "hint"
        inside = main or name in MAIN
        self.number += 1
        self.places.setdefault(name, []).append(len(self.stack))
        if name in MAIN or name in FURNITURE:
            self.parts.append(len(self.stack))
        self.stack.append((name, hidden or name in HIDDEN, {"": 0.0, "hint": 0.5}.get(why, 1.0), inside, heading or name in HEADINGS, link or name == "a", self.number))
        self.why.append(why)

    def sign(self, words: list[list[str]], attributes: dict[str, str]) -> None:
        """If an element signs a post, note the elements around it that may be that post."""
        if any(set(w) & SIGNED for w in words) or {*attributes.get("rel", "").lower().split(), *attributes.get("itemprop", "").lower().split()} & SIGNED:
            for k in range(len(self.stack) - 1, max(0, len(self.stack) - 1 - ABOVE), -1):
                if self.stack[k][0] in POSTS:
                    self.signed[self.stack[k][6]] = (self.stack[k - 1][6], self.stack[k][0])

    def posts(self) -> set[int]:
        """Numbers of the elements that are readers' posts: signed, with another such one beside them."""
        beside = Counter(self.signed.values())
        return {n for n, where in self.signed.items() if beside[where] > 1}

    def drop(self) -> None:
        name = self.stack.pop()[0]
        self.why.pop()
        self.places[name].pop()
        if self.parts and self.parts[-1] == len(self.stack):
            self.parts.pop()

    def pop(self, name: str) -> bool:
        open_at = self.places.get(name)
        if not open_at:
            return False
        if name in INLINE | LOOSE and self.parts and self.parts[-1] > open_at[-1]:
            return False  # a stray end tag doesn't end the part of the page that it stands in
        at = open_at[-1]
        while len(self.stack) > at:
            self.drop()
        return True


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page, white space and character references resolved."""
    out: list[Block] = []
    around: list[tuple[int, ...]] = []  # the numbers of the elements right above each block
    open_, tags = _Open(), _Tags(page)
    held: list[str] = []
    linked: list[str] = []

    def end() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            _, _, furniture, main, heading, _, _ = open_.stack[-1]
            n = len(text.split())
            if not main and LEGAL.match(text):
                furniture = 1.0
            out.append(Block(text, n, min(n, len(html.unescape(" ".join(linked)).split())), furniture, main, heading))
            around.append(tuple(x[6] for x in open_.stack[-2 * ABOVE :]))
        held.clear()
        linked.clear()

    def put(text: str) -> None:
        if text and not open_.stack[-1][1]:
            held.append(text)
            if open_.stack[-1][5]:
                linked.append(text)

    def until(mark: str, at: int) -> tuple[int, int]:
        """(end of what stands before ``mark``, where to go on), both the page's end if it isn't there."""
        found = page.find(mark, at)
        return (size, size) if found < 0 else (found, found + len(mark))

    at = 0
    size = len(page)
    while at < size:
        found = MARK.search(page, at)
        if not found:
            put(page[at:])
            break
        put(page[at : found.start()])
        name = (found[2] or "").lower()
        if not name:
            last, at = until({"<!--": "-->", "<![CDATA[": "]]>"}.get(found[0], ">"), found.end())
            if found[0] == "<![CDATA[":
                put(html.escape(page[found.end() : last]))
            continue
        last = tags.attributes_end(found.end())
        raw, at = page[found.end() : last], last + 1
        if name == "br":
            put(" ")
            continue
        inline = name in INLINE
        if not inline:
            end()
        if found[1]:
            open_.pop(name)
            continue
        if name in LOOSE and any(x[0] == name for x in open_.stack[-4:]) and open_.stack[-1][0] in LOOSE | INLINE:
            open_.pop(name)
        elif name in LOOSE | HEADINGS | {"div", "ul", "ol", "table", "section"} and open_.stack[-1][0] in INLINE - {"a"}:
            while open_.stack[-1][0] in INLINE:  # inline markup left open ends at the next block
                open_.drop()
            if open_.stack[-1][0] == "p":
                open_.drop()
        if name in VOID or raw.endswith("/") and name not in RAW | HIDDEN:
            if raw:
                attributes = attributes_of(raw)
                open_.sign(named_words(attributes, "class"), attributes)
            continue
        open_.push(name, attributes_of(raw) if raw else {})
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(page, at)
            body = page[at : close.start()] if close else page[at:]
            if name == "textarea":
                put(body)
            at = tags.attributes_end(close.end()) + 1 if close else size
            open_.pop(name)
    end()
    posts = open_.posts()
    if posts:
        for block, above in zip(out, around):
            if not posts.isdisjoint(above):
                block.furniture = 1.0
    return out


FEATURES = ["words", "density", "words_before", "density_before", "words_after", "density_after", "furniture", "main", "heading", "article_on_page"]


def features(found: list[Block]) -> np.ndarray:
    """One row per block: its numbers, its neighbours' and its place."""
    if not found:
        return np.zeros((0, len(FEATURES)))
    n = np.array([b.words for b in found], float)
    d = np.array([b.density for b in found])
    before = lambda v: np.r_[0.0, v[:-1]]
    after = lambda v: np.r_[v[1:], 0.0]
    place = np.array([[b.furniture, b.main, b.heading] for b in found], float)
    article = np.full(len(found), float(any(b.main and b.furniture < 1 for b in found)))
    return np.c_[n, d, before(n), before(d), after(n), after(d), place, article]


#: Labelled blocks: features in the order of FEATURES, then 1 for main text. Written by hand from the usual make-up of
#: pages: with and without an article element, with menus, adverts, notices, comments and forms around and inside it.
BLOCKS = [
    # words, density, before, density, after, density, furniture, main, heading, article on page, label
    (6, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 1, 0), (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 1, 0), (1, 1.0, 1, 1.0, 9, 0.0, 1, 0, 0, 1, 0),
    (9, 0.0, 1, 1.0, 8, 0.0, 1, 0, 0, 1, 0), (30, 0.0, 1, 1.0, 8, 0.0, 1, 0, 0, 1, 0), (12, 0.1, 2, 1.0, 4, 0.0, 1, 0, 0, 1, 0),
    (8, 0.0, 9, 0.0, 40, 0.0, 0, 1, 1, 1, 1), (8, 0.0, 1, 1.0, 40, 0.0, 0, 1, 1, 1, 1), (4, 0.0, 30, 0.0, 60, 0.0, 0, 1, 1, 1, 1),
    (40, 0.0, 8, 0.0, 70, 0.02, 0, 1, 0, 1, 1), (70, 0.02, 40, 0.0, 3, 0.0, 0, 1, 0, 1, 1), (3, 0.0, 70, 0.02, 55, 0.0, 0, 1, 0, 1, 1),
    (1, 0.0, 55, 0.0, 9, 0.0, 0, 1, 0, 1, 1), (1, 0.0, 1, 0.0, 1, 0.0, 0, 1, 0, 1, 1), (2, 0.0, 8, 0.0, 0, 0.0, 0, 1, 0, 1, 1),
    (400, 0.01, 8, 0.0, 12, 0.0, 0, 1, 0, 1, 1), (25, 0.3, 30, 0.0, 30, 0.0, 0, 1, 0, 1, 1), (6, 1.0, 30, 0.0, 30, 0.0, 0, 1, 0, 1, 1),
    (9, 0.0, 55, 0.0, 0, 0.0, 1, 0, 0, 1, 0), (9, 0.2, 2, 0.0, 0, 0.0, 1, 0, 0, 1, 0), (60, 0.0, 9, 0.0, 0, 0.0, 1, 0, 0, 1, 0),
    (14, 0.0, 60, 0.0, 33, 0.0, 1, 1, 0, 1, 0), (35, 0.0, 14, 0.0, 20, 0.0, 1, 1, 0, 1, 0), (5, 0.6, 60, 0.0, 40, 0.0, 1, 1, 0, 1, 0),
    (4, 1.0, 4, 1.0, 40, 0.0, 1, 1, 0, 1, 0), (3, 0.0, 40, 0.0, 14, 0.0, 1, 1, 1, 1, 0), (90, 0.0, 3, 0.0, 4, 1.0, 1, 1, 0, 1, 0),
    (12, 0.0, 55, 0.0, 30, 0.0, 0, 0, 0, 1, 0), (45, 0.0, 12, 0.0, 50, 0.0, 0, 0, 0, 1, 0), (3, 0.0, 20, 0.0, 4, 1.0, 0, 0, 1, 1, 0),
    (5, 1.0, 3, 0.0, 5, 1.0, 0, 0, 0, 1, 0), (2, 0.0, 0, 0.0, 8, 0.0, 0, 0, 0, 1, 0), (7, 0.0, 0, 0.0, 8, 0.0, 0, 0, 1, 1, 0),
    (7, 0.0, 2, 1.0, 60, 0.0, 0, 0, 1, 0, 1), (6, 0.0, 70, 0.0, 60, 0.0, 0, 0, 1, 0, 1), (60, 0.0, 7, 0.0, 80, 0.01, 0, 0, 0, 0, 1),
    (80, 0.01, 60, 0.0, 14, 0.0, 0, 0, 0, 0, 1), (14, 0.0, 80, 0.01, 30, 0.0, 0, 0, 0, 0, 1), (9, 0.0, 30, 0.0, 25, 0.0, 0, 0, 0, 0, 1),
    (30, 0.05, 14, 0.0, 3, 0.0, 0, 0, 0, 0, 1), (3, 0.0, 30, 0.0, 40, 0.0, 0, 0, 0, 0, 1), (25, 0.2, 30, 0.0, 40, 0.0, 0, 0, 0, 0, 1),
    (4, 0.0, 12, 0.0, 15, 0.0, 0, 0, 0, 0, 1), (1, 0.0, 20, 0.0, 25, 0.0, 0, 0, 0, 0, 1), (12, 0.0, 3, 0.0, 0, 0.0, 0, 0, 0, 0, 1),
    (2, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (5, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (30, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (2, 0.0, 0, 0.0, 3, 0.0, 0, 0, 0, 0, 1),
    (3, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0, 0), (2, 1.0, 3, 1.0, 2, 1.0, 0, 0, 0, 0, 0), (2, 1.0, 2, 1.0, 7, 0.0, 0, 0, 0, 0, 0),
    (5, 0.8, 40, 0.0, 4, 1.0, 0, 0, 0, 0, 0), (4, 1.0, 5, 0.8, 4, 1.0, 0, 0, 0, 0, 0), (12, 0.75, 30, 0.0, 0, 0.0, 0, 0, 0, 0, 0),
    (6, 0.67, 5, 1.0, 3, 1.0, 0, 0, 0, 0, 0), (3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 1, 0, 0), (2, 0.0, 4, 1.0, 4, 1.0, 0, 0, 0, 0, 0),
    (9, 0.0, 2, 1.0, 0, 0.0, 1, 0, 0, 0, 0), (40, 0.0, 2, 1.0, 7, 0.0, 1, 0, 0, 0, 0), (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0, 0), (15, 0.1, 60, 0.0, 9, 0.0, 1, 0, 1, 0, 0),
]


#: More labelled blocks, by rule: main text stays main text whatever its neighbours' words and link density; a block of
#: links is main text inside an article only; what a name merely hints at goes by its words and links.
for _before in ((0, 0.0), (2, 0.0), (2, 1.0), (20, 0.0), (20, 1.0)):
    for _after in ((0, 0.0), (2, 0.0), (2, 1.0), (6, 0.2), (9, 0.0), (9, 0.3), (9, 1.0), (40, 0.0)):
        _around = (*_before, *_after)
        for _n in (1, 4, 12, 40, 150):
            BLOCKS += [(_n, 0.0, *_around, 0, 1, _h, 1, 1) for _h in (0, 1)]  # in an article
            BLOCKS += [(_n, 1.0, *_around, 0, 1, 0, 1, 1), (_n, 0.3, *_around, 0, 1, 0, 1, 1)]
            BLOCKS += [(_n, 0.0, *_around, 1, _m, 0, 1, 0) for _m in (0, 1)]  # in a menu, notice or the like
            BLOCKS += [(_n, 0.0, *_around, 0, 0, 0, 1, 0)]  # beside the article
            BLOCKS += [(_n, 0.0, *_around, 0.5, 1, 0, 1, 1), (_n, 1.0, *_around, 0.5, 1, 0, 1, 0)]
            BLOCKS += [(_n, 1.0, *_around, 0, 0, 0, 0, 0), (_n, 0.0, *_around, 1, 0, 0, 0, 0)]  # links, furniture, without an article
            if _n >= 12:
                BLOCKS += [(_n, 0.0, *_around, 0, 0, 0, 0, 1), (_n, 0.2, *_around, 0, 0, 0, 0, 1)]
                BLOCKS += [(_n, 0.0, *_around, 0.5, 0, 0, 0, 1), (_n, 0.8, *_around, 0.5, 0, 0, 0, 0)]
            elif _before[1] == _after[1] == 1.0:
                BLOCKS += [(_n, 0.0, *_around, 0, 0, 0, 0, 0), (_n, 0.0, *_around, 0.5, 0, 0, 0, 0)]
            elif _before[1] == 0.0 or 0 < _after[1] < 0.5:
                BLOCKS += [(_n, 0.0, *_around, 0, 0, 0, 0, 1)]


@lru_cache(1)
def tree() -> Node:
    t = np.array(BLOCKS, float)
    return grow(t[:, :-1], t[:, -1], np.ones(len(t)), depth=8, least=1)


def main_blocks(page: str | None) -> list[str]:
    """The blocks of main text of a page, in page order."""
    found = blocks(page or "")
    keep = share_of(tree(), features(found)) > 0.5
    return [b.text for b, k in zip(found, keep) if k]


def extract(pages: DataFrame, *columns: str, page: str = "html") -> DataFrame:
    """(*columns, text, n_chars) of every page."""
    slim = pages.select(*columns, F.col(page).cast("string").alias("_page"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n\n".join(main_blocks(p)) for p in batch.column(batch.num_columns - 1).to_pylist()]
            added = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], [*columns, "text", "n_chars"])

    kinds = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in columns)
    return slim.mapInArrow(run, f"{kinds}, text string, n_chars long")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), "page_id", "url")
